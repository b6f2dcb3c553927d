"""Queries of the training-data operators, whole tables each, and their SQL statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import hnsw, langid, license_scan, lm, pii, ranked, repeats, sentencepiece, turns, url_rules
from ledgerlens.llm.decontaminate import decontaminate
from ledgerlens.llm.minhash import near_duplicates
from ledgerlens.llm.quotes import link_quotes
from ledgerlens.llm.url_rules import judge

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query
def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark words in each document."""
    docs, benchmark = (_table(spark, folder, t) for t in ("documents", "benchmark"))
    found = decontaminate(docs, benchmark, keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLES["op8_decontaminate"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, (len(w) - n + 2)::BIGINT)) AS i FROM sized)),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, (len(w) - n + 2)::BIGINT)) AS i
        FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, g.n, item_id FROM grams g JOIN windows x ON g.n = x.n AND g.phrase = x.phrase),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places p ON d.doc_id = p.doc_id LEFT JOIN items t ON d.doc_id = t.doc_id
"""


@query
def op6_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, fitting rule and verdict of each page."""
    judged = judge(_table(spark, folder, "pages"), keep=["page_id"])
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _any(words: str) -> str:
    return "|".join(words.split())


_WORDS = " ".join([*url_rules.HOST_WORDS.values(), url_rules.DRUGS])
_PHARMACY = rf"({_any(url_rules.SELLERS)})-({_any(url_rules.DRUGS)})-pharmacy"
ORACLES["op6_url_rules"] = rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN position('://' IN coalesce(url, '')) > 0
    THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS h,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^?#]*')) + 1), '^\?[^#]*') AS query FROM cut),
named AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path,
    translate(path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || '/' AS segments,
    translate(query, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS query FROM parts),
judged AS (
  SELECT *, '.' || host AS sub, CASE
    WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM named)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN regexp_matches(host, '(^|[.-])spam(-[^.]*)?\.|(^|[.-])(cheap|buy|online)-pills[.-]|(^|[.-])casino[.-]|(^|[.])ads[.-]|(^|[.-])adult[.-]|(^|[.-])bets[.-]')
    OR regexp_matches(host, '(^|[.-])({_any(_WORDS)}|{_PHARMACY})[.-]')
    OR regexp_matches(segments, '/({_any(" ".join(url_rules.PATH_WORDS.values()))})/')
    OR regexp_matches(query, '[?&;]({_any(" ".join(url_rules.QUERY_KEYS.values()))})=')
  THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""


@query
def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of each document; a quarter of the documents teaches nothing."""
    docs = _table(spark, folder, "documents")
    profiles = langid.learn(docs.where(~langid.held_out()))
    found = langid.identify(docs, profiles, keep=["doc_id"])
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@query
def op1_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate group of each document."""
    return near_duplicates(_table(spark, folder, "documents"))


ORACLES["op1_near_duplicates"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2)::BIGINT)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * common >= 85 * (x.n + y.n - common)),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON reached.other = links.a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN sizes s ON d.doc_id = s.doc_id
JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) r ON d.doc_id = r.doc_id
"""


@query
def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in each document."""
    docs = _table(spark, folder, "documents")
    return pii.find(docs, pii.fit(docs), keep=["doc_id"])


@query
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and covered licence templates of each document."""
    found = license_scan.scan(_table(spark, folder, "documents"), keep=["doc_id"])
    return found.drop("license_spans")


@query
def op9_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """Ten nearest vectors of every hundredth vector."""
    rows = _table(spark, folder, "embeddings")
    return hnsw.nearest(rows, rows.where("vec_id % 100 = 0"))


@query
def op5_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Log-probability of each document; a fifth of the documents teaches nothing, and a tenth of
    the others sets the mixture weights."""
    draw = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return lm.lm_scores(_table(spark, folder, "documents"), draw % 5 == 1, F.floor(draw / 5) % 10 == 0)


@query
def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Piece ids of each document, and whether decoding gives the text back."""
    vocabulary = sentencepiece.load_vocabulary()
    # The text goes to the encoder only; its digest is what the decoded text is held against.
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    docs = _table(spark, folder, "documents").withColumn("digest", digest)
    encoded = sentencepiece.encode(docs, vocabulary, keep=["doc_id", "digest"])
    return sentencepiece.decode(encoded, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.sha2("decoded", 256) == F.col("digest")).alias("round_trip"),
    )


@query
def op4_quotation_links(spark: SparkSession, folder: str) -> DataFrame:
    """Messages without quotes, in reply order."""
    return link_quotes(_table(spark, folder, "conversations"), by_line=True)


ORACLES["op4_quotation_links"] = r"""
WITH RECURSIVE
messages AS (
  SELECT row_number() OVER () AS id, conv_id, turn, role,
    translate(coalesce(text, ''), chr(30) || chr(31), '') AS t FROM conversations),
raw AS (
  SELECT id, unnest(string_split_regex(t, '\r\n|\n|\r')) AS line,
    generate_subscripts(string_split_regex(t, '\r\n|\n|\r'), 1) AS i FROM messages),
lines AS (
  SELECT id, i, length(regexp_replace(regexp_extract(line, '\A(?:[ \t]?>)+'), '[^>]', '', 'g')) AS level,
    regexp_replace(substr(line, length(regexp_extract(line, '\A(?:[ \t]?>)+')) + 1), '\A[ \t]', '') AS content
  FROM raw),
runs AS (
  SELECT *, sum(new::INT) OVER (PARTITION BY id ORDER BY i) AS run
  FROM (SELECT *, level IS DISTINCT FROM lag(level) OVER (PARTITION BY id ORDER BY i) AS new FROM lines)),
bodies AS (
  SELECT id, run, min(level) AS level, string_agg(content, chr(10) ORDER BY i) AS body FROM runs GROUP BY id, run),
passages AS (
  SELECT id, run, level, CASE WHEN lead(level, 1, 0) OVER (PARTITION BY id ORDER BY run) > level
    THEN regexp_replace(body, '(?:\A|\n)[^\n]*\bwrote:\s*\z', '') ELSE body END AS body FROM bodies),
own AS (
  SELECT id, string_agg(b, chr(10) || chr(10) ORDER BY run) AS text
  FROM (SELECT id, run, regexp_replace(body, '\A\s+|\s+\z', '', 'g') AS b FROM passages WHERE level = 0)
  WHERE b <> '' GROUP BY id),
paragraphs AS (
  SELECT id, level, body, unnest(string_split_regex(body, '\n[ \t]*\n')) AS part FROM passages),
parts AS (
  SELECT id, level, body AS whole, body AS paragraph, body AS unit, 2 AS grade FROM passages
  UNION ALL SELECT id, level, body, part, part, 1 FROM paragraphs
  UNION ALL SELECT id, level, body, part, unnest(string_split(part, chr(10))), 0 FROM paragraphs),
placed AS (
  SELECT DISTINCT conv_id, turn, level, columns(['whole', 'paragraph', 'unit']), grade
  FROM (SELECT id, level, grade, trim(regexp_replace(translate(columns(['whole', 'paragraph', 'unit']),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '\s+', ' ', 'g'), ' ') FROM parts) JOIN messages USING (id)
  WHERE unit <> '' AND conv_id IS NOT NULL AND turn IS NOT NULL
    AND (grade = 2 OR grade = 1 AND unit <> whole OR grade = 0 AND unit <> paragraph)),
original AS (SELECT conv_id, unit, min(turn) AS source FROM placed WHERE level = 0 GROUP BY ALL),
matched AS (
  SELECT q.*, source, max(grade) OVER (PARTITION BY q.conv_id, turn, level, whole) AS most,
    max(grade) OVER (PARTITION BY q.conv_id, turn, level, whole, paragraph) AS here
  FROM placed q JOIN original o ON q.conv_id = o.conv_id AND q.unit = o.unit WHERE level > 0 AND source < turn),
hits AS (
  SELECT conv_id, turn, level, source, count(*) AS n, sum(length(unit)) AS size FROM (
    SELECT DISTINCT conv_id, turn, level, source, unit FROM matched WHERE grade = 2 OR most < 2 AND grade = here)
  GROUP BY ALL),
links AS (
  SELECT conv_id, turn, first(source ORDER BY level, size DESC, source DESC) AS reply_to, sum(n)::BIGINT AS n_linked
  FROM hits GROUP BY ALL),
walk(conv_id, turn, up, depth) AS (
  SELECT conv_id, turn, reply_to, 1::BIGINT FROM links
  UNION ALL SELECT w.conv_id, w.turn, l.reply_to, w.depth + 1
  FROM walk w JOIN links l ON w.conv_id = l.conv_id AND w.up = l.turn),
roots AS (SELECT conv_id, turn, arg_max(up, depth) AS thread, max(depth) AS depth FROM walk GROUP BY ALL),
quoted AS (SELECT id, count_if(level > 0)::BIGINT AS n_quoted FROM passages GROUP BY id)
SELECT m.conv_id, m.turn, role, coalesce(o.text, '') AS text, reply_to, coalesce(thread, m.turn) AS thread,
  coalesce(depth, 0)::BIGINT AS depth, n_quoted, coalesce(n_linked, 0)::BIGINT AS n_linked,
  '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(o.text, '') AS formatted
FROM messages m LEFT JOIN own o ON m.id = o.id JOIN quoted q ON m.id = q.id
LEFT JOIN links l ON m.conv_id = l.conv_id AND m.turn = l.turn
LEFT JOIN roots r ON m.conv_id = r.conv_id AND m.turn = r.turn
"""


@query
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and cheapest repair of each damaged conversation."""
    return turns.repair_digests(turns.damaged(_table(spark, folder, "conversations")), here="here")


def _repair_sql() -> str:
    """One recursive step per row; a state is (cost, audit, lines), so the least one is wanted."""

    def to(x: str, cost: str, letter: str, line: str) -> str:
        return f"{{'c': {x}.c + {cost}, 'l': {x}.l || '{letter}', 't': {x}.t || {line}}}"

    def drop(x: str) -> str:
        return to(x, "4", "D", "''")

    def stay(x: str, role: str) -> str:
        """Kept where the initial is the role's, else out of reach."""
        return to(x, f"CASE WHEN ok AND i = '{role}' THEN more ELSE 1000000000 END", "K", "o.role || ':' || o.text || chr(10)")

    def become(x: str, name: str) -> str:
        return to(x, "CASE WHEN ok THEN 3 + more ELSE 1000000000 END", "R", f"'{name}:' || o.text || chr(10)")

    def put(x: str, name: str) -> str:
        return to(x, "3", "I", f"'{name}:' || chr(10)")

    asked = ", ".join(f(x, y) for x in ("z", "s", "a") for f, y in ((stay, "u"), (become, "user")))
    empty, never = "{'c': 0::BIGINT, 'l': '', 't': ''}", "{'c': 1000000000::BIGINT, 'l': '', 't': ''}"
    return rf"""
WITH RECURSIVE
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(
      list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT),
      lambda c, b: list_reduce([0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda d, z: xor(d >> 1, 3988292384 * (d & 1)), xor(c, b)),
      4294967295::BIGINT)) % 20 AS f
  FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM raw WHERE f <> 0),
n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen, left(role, 1) AS i FROM d),
o AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
    lag(i) OVER (PARTITION BY conv_id ORDER BY pos) || i AS pair FROM n),
rows AS (
  SELECT *, fault NOT IN ('blank', 'duplicate') AS ok, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS more FROM o),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count_if(fault = 'blank')::BIGINT AS blank, count_if(fault = 'duplicate')::BIGINT AS duplicate,
    count_if(fault = 'truncated')::BIGINT AS truncated, count_if(pair NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal
  FROM rows GROUP BY conv_id),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS pos, {empty} AS z, {never} AS s, {put(f"({empty})", "user")} AS u,
    {put(f"({put(f'({empty})', 'user')})", "assistant")} AS a FROM conversations
  UNION ALL
  SELECT conv_id, pos, z, s, u, list_min([a, {put("u", "assistant")}]) AS a
  FROM (
    SELECT conv_id, pos, z, s, a, list_min([u, {put("z", "user")}, {put("s", "user")}, {put("a", "user")}]) AS u
    FROM (
      SELECT w.conv_id, o.pos, {drop("z")} AS z, list_min([{drop("s")}, {stay("z", "s")}]) AS s,
        list_min([{drop("u")}, {asked}]) AS u, list_min([{drop("a")}, {stay("u", "a")}, {become("u", "assistant")}]) AS a
      FROM walk w JOIN rows o ON w.conv_id IS NOT DISTINCT FROM o.conv_id AND o.pos = w.pos + 1))),
done AS (SELECT conv_id, list_min([arg_max(z, pos), arg_max(a, pos)]) AS best FROM walk GROUP BY conv_id)
SELECT done.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.l AS audit,
  sha256(left(best.t, length(best.t) - 1)) AS repaired_sha256
FROM done LEFT JOIN counted ON done.conv_id IS NOT DISTINCT FROM counted.conv_id
"""


ORACLES["op11_conversation_repair"] = _repair_sql()


@query
def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """Ten best documents for each benchmark item."""
    return ranked.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


ORACLES["op13_ranked_search"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
whole AS (SELECT count(*) AS docs, sum(len(w)) AS words FROM d WHERE len(w) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM tf, whole GROUP BY term, docs),
long AS (SELECT r, doc_id, 100 - 75 + (75 * len(w) * docs) // words AS m FROM d, whole WHERE len(w) > 0),
asked AS (
  SELECT i, item_id, term, count(*) AS times FROM (
    SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL),
scored AS (
  SELECT i, item_id, r, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN df USING (term) JOIN long USING (r) GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r)::INT AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""


@query
def op12_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the passages that a document with a smaller id has."""
    found = repeats.remove_repeats(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op12_repeated_passages"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, (len(w) - 11)::BIGINT)) AS i FROM d WHERE doc_id IS NOT NULL AND len(w) > 12)),
earliest AS (SELECT phrase, min(doc_id) AS first FROM windows GROUP BY phrase),
gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 13)) AS i FROM windows JOIN earliest USING (phrase) WHERE first < doc_id),
lost AS (SELECT r, count(*) AS n FROM gone GROUP BY r),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM (
    SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d WHERE len(w) > 0) ANTI JOIN gone USING (r, i)
  GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN lost USING (r) LEFT JOIN kept USING (r)
"""
