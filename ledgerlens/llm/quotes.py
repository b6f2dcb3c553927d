"""Chat formatting by quotation linking: messages without their quotes, in reply order.

Quote levels are the ``>`` marks before a line. Lines of one level that follow each other form a
passage. Quoted passages, whole and by paragraph, are normalised, hashed and joined to the earliest
message of the conversation that wrote them at level 0; the message quoted most at the lowest level
is the one replied to. On request passages are hashed by line too, and the longest unit counts. Threads follow from reply links by pointer doubling. DataFrame functions
only; no group is gathered: the original of a passage is a minimum, combined before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.url_rules import LOWER, UPPER
from ledgerlens.session import materialise

_PASSAGE, _LEVEL = "\x1e", "\x1f"  # marks of the parsed form, taken out of texts first
_QUOTE = r"\A(?:[ \t]?>)+"
_ATTRIBUTION = r"(?:\A|\n)[^\n]*\bwrote:\s*\z"
_ANY_QUOTE = r"(?:\A|[\r\n])[ \t]?>"


def _lines(text: Column) -> Column:
    """(level, content) of each line."""
    prefix = lambda line: F.regexp_extract(line, _QUOTE, 0)
    return F.transform(
        F.split(F.translate(text, _PASSAGE + _LEVEL, ""), r"\r\n|\n|\r", -1),
        lambda line: F.struct(
            F.length(F.regexp_replace(prefix(line), "[^>]", "")).alias("level"),
            F.regexp_replace(F.substr(line, F.length(prefix(line)) + 1), r"\A[ \t]", "").alias("content"),
        ),
    )


def _passages(lines: Column) -> Column:
    """(level, body) of each run of lines of one level, linear in the text."""
    marked = F.transform(
        lines,
        lambda x, i: F.concat(
            F.when((i > 0) & (F.get(lines, i - 1)["level"] == x["level"]), "\n").otherwise(
                F.concat(F.lit(_PASSAGE), x["level"].cast("string"), F.lit(_LEVEL))
            ),
            x["content"],
        ),
    )
    parts = F.filter(F.split(F.array_join(marked, ""), _PASSAGE, -1), lambda p: p != "")
    return F.transform(
        parts,
        lambda p: F.struct(
            F.substring_index(p, _LEVEL, 1).cast("int").alias("level"),
            F.substring_index(p, _LEVEL, -1).alias("body"),
        ),
    )


def _unquoted(text: Column) -> Column:
    """Own text of a message without any quote: what ``parse`` makes of it, without its steps."""
    body = F.regexp_replace(F.regexp_replace(F.translate(text, _PASSAGE + _LEVEL, ""), r"\r\n|\r", "\n"), r"(\A|\n)[ \t]", "$1")
    return F.regexp_replace(body, r"\A\s+|\s+\z", "")


def _normal(body: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(body, UPPER, LOWER), r"\s+", " "))


def _units(body: Column) -> Column:
    """Hashes of the normalised passage and of its paragraphs."""
    parts = F.array_append(F.split(body, r"\n[ \t]*\n", -1), body)
    return F.transform(
        F.array_distinct(F.filter(F.transform(parts, _normal), lambda u: u != "")), lambda u: F.sha2(u, 256)
    )


_WHOLE, _PARAGRAPH, _LINE = 2, 1, 0


def _graded_units(body: Column) -> Column:
    """(whole, paragraph, grade, unit, size) of the normalised passage, its paragraphs and their
    lines: hashes, and the characters of the unit. What equals a longer unit is left out."""
    digest = lambda u: F.sha2(u, 256)
    whole = _normal(body)

    def unit(paragraph: Column, grade: int, text: Column) -> Column:
        fields = digest(whole), digest(paragraph), F.lit(grade), digest(text), F.length(text)
        names = ("whole", "paragraph", "grade", "unit", "size")
        return F.struct(*(f.alias(n) for f, n in zip(fields, names, strict=True)))

    def parts(paragraph: Column) -> Column:
        as_one = _normal(paragraph)
        lines = F.filter(F.transform(F.split(paragraph, "\n", -1), _normal), lambda x: (x != "") & (x != as_one))
        return F.concat(
            F.filter(F.array(unit(as_one, _PARAGRAPH, as_one)), lambda _: (as_one != "") & (as_one != whole)),
            F.transform(F.array_distinct(lines), lambda x: unit(as_one, _LINE, x)),
        )

    inner = F.flatten(F.transform(F.split(body, r"\n[ \t]*\n", -1), parts))
    return F.when(whole != "", F.concat(F.array(unit(whole, _WHOLE, whole)), inner))


def parse(messages: DataFrame, text: str = "text", by_line: bool = False) -> DataFrame:
    """Adds ``passages`` (level, body) and ``own``: the level-0 text, without the line that names
    the author of a quote that follows it. ``by_line`` takes such lines from quotes, too."""
    lines = messages.withColumn("__lines", _lines(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    found = lines.withColumn("passages", _passages(F.col("__lines"))).drop("__lines")
    following = lambda i: F.coalesce(F.get("passages", i + 1)["level"], F.lit(0))
    clean = F.transform(
        "passages",
        lambda p, i: F.struct(
            p["level"].alias("level"),
            F.when(((p["level"] == 0) | F.lit(by_line)) & (following(i) > p["level"]), F.regexp_replace(p["body"], _ATTRIBUTION, "")).otherwise(p["body"]).alias("body"),
        ),
    )
    found = found.withColumn("passages", clean)
    own = F.transform(F.filter("passages", lambda p: p["level"] == 0), lambda p: F.regexp_replace(p["body"], r"\A\s+|\s+\z", ""))
    return found.withColumn("own", F.array_join(F.filter(own, lambda b: b != ""), "\n\n"))


def reply_links(parsed: DataFrame) -> DataFrame:
    """(conv, turn, reply_to, n_linked) of the messages whose quotes lead to an earlier message."""
    units = parsed.where("conv is not null and turn is not null").select(
        "conv", "turn", F.explode("passages").alias("p")
    ).select("conv", "turn", F.col("p.level").alias("level"), F.explode(_units(F.col("p.body"))).alias("unit"))
    original = units.where("level = 0").groupBy("conv", "unit").agg(F.min("turn").alias("source"))
    quoted = units.where("level > 0").distinct()
    hits = quoted.join(original, ["conv", "unit"]).where("source < turn")
    best = hits.groupBy("conv", "turn", "level", "source").agg(F.count(F.lit(1)).alias("n"))
    return best.groupBy("conv", "turn").agg(
        F.min(F.struct("level", -F.col("n"), -F.col("source"), "source"))["source"].alias("reply_to"),
        F.sum("n").alias("n_linked"),
    )


def line_links(parsed: DataFrame) -> DataFrame:
    """Like ``reply_links``, with lines as units: of a quoted passage the longest units that were
    written earlier count, and the message with most of their characters is replied to."""
    units = parsed.where("conv is not null and turn is not null").select("conv", "turn", F.explode("passages").alias("p"))
    units = units.select("conv", "turn", F.col("p.level").alias("level"), F.explode(_graded_units(F.col("p.body"))).alias("u"))
    units = units.select("conv", "turn", "level", "u.*")
    original = units.where("level = 0").groupBy("conv", "unit").agg(F.min("turn").alias("source"))
    hits = materialise(units.where("level > 0").distinct().join(original, ["conv", "unit"]).where("source < turn"))
    passage = ["conv", "turn", "level", "whole"]
    found = hits.where(f"grade = {_WHOLE}")
    smaller = hits.where(f"grade < {_WHOLE}").join(found.select(*passage), passage, "left_anti")
    paragraphs = smaller.where(f"grade = {_PARAGRAPH}")
    lines = smaller.where(f"grade = {_LINE}").join(paragraphs.select(*passage, "paragraph"), [*passage, "paragraph"], "left_anti")
    columns = ["conv", "turn", "level", "unit", "size", "source"]
    # A unit that stands in several places of a message counts once.
    counted = found.select(*columns).unionByName(paragraphs.select(*columns)).unionByName(lines.select(*columns)).distinct()
    best = counted.groupBy("conv", "turn", "level", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    return best.groupBy("conv", "turn").agg(
        F.min(F.struct("level", -F.col("size"), -F.col("source"), "source"))["source"].alias("reply_to"),
        F.sum("n").alias("n_linked"),
    )


def threads(links: DataFrame) -> DataFrame:
    """(conv, turn, thread, depth): the turn that starts each linked message's thread, and how many
    replies lead to it. Each round doubles how far a message looks."""
    now = materialise(links.select("conv", "turn", F.col("reply_to").alias("up"), F.lit(1).cast("long").alias("far")))
    while True:
        above = now.select("conv", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("far").alias("more"))
        step = materialise(now.join(above, ["conv", "up"], "left"))
        if step.where("next is not null").isEmpty():
            return now.select("conv", "turn", F.col("up").alias("thread"), F.col("far").alias("depth"))
        now = step.select("conv", "turn", F.coalesce("next", "up").alias("up"), (F.col("far") + F.coalesce("more", F.lit(0))).alias("far"))


def link_quotes(
    messages: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    by_line: bool = False,
) -> DataFrame:
    """One row per message row: ``conv_id``, ``turn``, ``role``, ``text`` (own words only),
    ``reply_to`` (turn, or null), ``thread`` (turn its thread starts with), ``depth`` (replies on
    the way), ``n_quoted`` (quoted passages), ``n_linked`` (quoted units found in earlier messages)
    and ``formatted`` (role header and text), ordered by conversation, thread, depth and turn, so
    that a message follows the one it replies to. Quoted units are passages and paragraphs;
    ``by_line``, as in the registered query, adds the lines of paragraphs, of which the longest unit
    that matches counts, and drops attribution lines inside quotes before a deeper one.

    A null text is empty; a message without links starts its own thread; quotes of later or
    unknown messages link nothing but are taken out all the same. Messages without conversation or
    turn have no links. Repeated rows each appear with the links of their turn; rows that share a
    turn but differ in text are linked together. Other columns are not read."""
    source = messages.select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text"),
    )
    words = F.coalesce("text", F.lit(""))
    quoting = F.translate(words, _PASSAGE + _LEVEL, "").rlike(_ANY_QUOTE)
    # Only conversations that hold a quote can hold a link, so only their passages are hashed.
    asked = source.where(quoting).select("conv").distinct()
    parsed = parse(source.join(asked, "conv", "left_semi"), by_line=by_line)
    links = materialise(line_links(parsed) if by_line else reply_links(parsed))
    placed = materialise(links.join(threads(links), ["conv", "turn"]))
    own = parse(source.where(quoting), by_line=by_line).select(
        "conv", "turn", "role", F.col("own").alias("text"),
        F.size(F.filter("passages", lambda p: p["level"] > 0)).cast("long").alias("n_quoted"),
    )
    plain = source.where(~quoting).select(
        "conv", "turn", "role", _unquoted(words).alias("text"), F.lit(0).cast("long").alias("n_quoted")
    )
    own = own.unionByName(plain)
    return (
        own.join(placed, ["conv", "turn"], "left")
        .select(
            F.col("conv").alias("conv_id"),
            "turn",
            "role",
            "text",
            "reply_to",
            F.coalesce("thread", "turn").alias("thread"),
            F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
            "n_quoted",
            F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"),
            F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("text")).alias("formatted"),
        )
        .orderBy("conv_id", "thread", "depth", "turn")
    )
