from __future__ import annotations

import random

import duckdb
import pytest

from ledgerlens.llm import quotes
from ledgerlens.llm.queries import ORACLES
from tests.compare import difference

ROWS = [
    (1, 0, "user", "Hello there.\n\nHow are you?"),
    (1, 1, "assistant", "On Monday user wrote:\n> Hello there.\n>\n> How are you?\n\nFine."),
    (1, 2, "user", "> > Hello there.\n> Fine.\nGood to hear"),
    (1, 3, "assistant", ">How   are YOU?\nyes\r\n>> Fine.\r\nno"),
    (1, 4, "user", None),
    (1, 4, "user", None),
    (1, 5, "user", "> never said\n> by anyone\nbut answered"),
    (2, 0, "user", "> Hello there."),
    (2, 1, "assistant", "He wrote:\nno quote follows"),
    (None, None, None, "> x\ny"),
    (3, 0, "user", "later"),
    (3, 1, "user", "> even later\nx"),
    (3, 2, "user", "even later"),
]


def test_links_and_order(spark):
    frame = spark.createDataFrame([(*r, "taken") for r in ROWS], "conv_id long, turn long, role string, text string, thread string")
    out = quotes.link_quotes(frame)
    got = [(r["conv_id"], r["turn"], r["text"], r["reply_to"], r["thread"], r["depth"], r["n_quoted"]) for r in out.collect()]
    assert got == [
        (None, None, "y", None, None, 0, 1),
        (1, 0, "Hello there.\n\nHow are you?", None, 0, 0, 0),
        (1, 1, "Fine.", 0, 0, 1, 1),
        (1, 3, "yes\n\nno", 0, 0, 1, 2),
        (1, 2, "Good to hear", 1, 0, 2, 2),
        (1, 4, "", None, 4, 0, 0),
        (1, 4, "", None, 4, 0, 0),
        (1, 5, "but answered", None, 5, 0, 1),
        (2, 0, "", None, 0, 0, 1),
        (2, 1, "He wrote:\nno quote follows", None, 1, 0, 0),
        (3, 0, "later", None, 0, 0, 0),
        (3, 1, "x", None, 1, 0, 1),
        (3, 2, "even later", None, 2, 0, 0),
    ]
    assert quotes.link_quotes(frame.limit(0)).collect() == []


def _chatter(seed: int) -> list[tuple]:
    """Messages that quote earlier ones whole, in part, at several levels, or wrongly."""
    rng = random.Random(seed)
    rows = []
    for conv in range(6):
        said: list[str] = []
        for turn in range(12):
            parts = []
            for _ in range(rng.randint(0, 3)):
                source = rng.choice(said) if said and rng.random() < 0.8 else f"never said {rng.randint(0, 9)}"
                mark = rng.choice(["> ", ">", "> > ", ">> ", " >"])
                lines = source.split("\n")
                lines = lines[: rng.randint(1, len(lines))]
                parts += rng.choice([[], ["Some One wrote:"], ["wrote: no end"]])
                parts += [mark + (x.upper() if rng.random() < 0.3 else x) for x in lines]
                parts += rng.choice([[], [""], ["In between", "", "and more"]])
            parts += [f"message {rng.randint(0, 20)} of {conv}", "", f"paragraph {rng.randint(0, 5)}"][: rng.randint(0, 3)]
            said.append("\n".join(x for x in parts if not x.lstrip().startswith(">")))
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), rng.choice(["\n", "\r\n"]).join(parts)))
    return rows


@pytest.mark.parametrize("rows", [ROWS, _chatter(1), _chatter(2), _chatter(3)], ids=["rows", "1", "2", "3"])
def test_matches_sql(spark, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = quotes.link_quotes(frame, by_line=True)
    assert found.where("n_linked > 0").count() > 0
    assert difference(found, con, ORACLES["op4_quotation_links"]) == ""


def test_long_threads(spark):
    """Each message quotes the one before it."""
    rows = [(1, 0, "user", "message 0")] + [(1, i, "user", f"> message {i - 1}\nmessage {i}") for i in range(1, 40)]
    got = quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert [(r["turn"], r["reply_to"], r["thread"], r["depth"]) for r in got] == [(i, i - 1 if i else None, 0, i) for i in range(40)]


def test_many_lines(spark):
    text = "\n".join(("> " * (i % 3)) + f"line {i}" for i in range(20_000))
    parsed = quotes.parse(spark.createDataFrame([(text,)], "text string")).first()
    assert len(parsed["passages"]) == 20_000 and parsed["own"].startswith("line 0\n\nline 3")


@pytest.mark.parametrize("table", ["conversations"])
def test_plan_has_no_python(spark, small, table):
    df = quotes.link_quotes(spark.read.parquet(f"{small}/{table}.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def _links(spark, rows, **options):
    frame = spark.createDataFrame([(1, i, "user", t) for i, t in enumerate(rows)], "conv_id long, turn long, role string, text string")
    got = quotes.link_quotes(frame, **options).collect()
    return [(r["reply_to"], r["n_linked"]) for r in sorted(got, key=lambda r: r["turn"])]


def test_quotes_of_lines(spark):
    interleaved = ["line A\nline B", "> line A\nyes\n> line B\nno"]
    assert _links(spark, interleaved, by_line=True) == [(None, 0), (0, 2)]
    # The whole passage is one unit; its lines, which another message wrote earlier, do not count.
    assert _links(spark, ["a\n\nb", "a\nb", "> a\n> b"], by_line=True) == [(None, 0), (None, 0), (0, 1)]
    assert _links(spark, ["one", "two", "one\ntwo\nthree", "x\n> one\n> two\n> three"], by_line=True)[3] == (2, 1)
    # Most characters, not most units.
    assert _links(spark, ["ok", "a long line of text\nand more", "> ok\n> a long line of text"], by_line=True)[2] == (1, 2)


def test_attributions_inside_quotes(spark):
    rows = ["A text\nA more", "A wrote:\n> A text\nB text", "B wrote:\n> B text\n> A wrote:\n>> A text\nC text"]
    assert _links(spark, rows, by_line=True) == [(None, 0), (0, 1), (1, 2)]


def test_long_attributions(spark):
    rows = ["Hello", "On " + "a very long day " * 40 + "someone wrote:\n> Hello\nHi"]
    frame = spark.createDataFrame([(1, i, "user", t) for i, t in enumerate(rows)], "conv_id long, turn long, role string, text string")
    assert sorted(r["text"] for r in quotes.link_quotes(frame).collect()) == ["Hello", "Hi"]


def test_messages_without_quotes_are_read_as_parsed(spark):
    texts = [None, "", " a\n b\r\n\tc\r d \n\n", "x >y\n - > z", "\x1ea\x1f", "wrote:\n", "\n\n wrote:"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "turn long, text string")
    parsed = {r["turn"]: r["own"] for r in quotes.parse(frame).collect()}
    whole = frame.selectExpr("turn AS conv_id", "turn", "'u' AS role", "text")
    assert {r["turn"]: r["text"] for r in quotes.link_quotes(whole).collect()} == parsed


def test_by_line_without_quotes_is_the_same(spark, small):
    messages = spark.read.parquet(f"{small}/conversations.parquet")
    lines = quotes.link_quotes(messages, by_line=True)
    assert lines.exceptAll(quotes.link_quotes(messages)).isEmpty()
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
