from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from ledgerlens.llm import queries
from tests.compare import connect, difference
from tests.llm import plain
from tests.llm.test_decontaminate import expected
from tests.llm.test_pii import plain_spans


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, con, small, name):
    assert difference(queries.QUERIES[name](spark, small), con, queries.ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_covers_its_table(spark, small, name):
    rows = queries.QUERIES[name](spark, small).collect()
    table = {"op4": "conversations", "op9": "embeddings"}.get(name.split("_")[0], "documents")
    whole = spark.read.parquet(f"{small}/{table}.parquet")
    if name.startswith("op9"):
        assert len(rows) == 10 * whole.where("vec_id % 100 = 0").count()
    else:
        assert len(rows) == whole.count()
    if name.startswith("op7"):
        assert all(r["round_trip"] for r in rows)


def test_entry_has_one_query_per_operator():
    names = entry_points.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names


def test_stages_against_plain_versions(spark, small, documents, texts):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    group = plain.components({i: plain.shingles(t) for i, t in texts.items()}, 80)
    hits = expected(list(texts.items()), items)
    lettered = {i for i, t in texts.items() if t and any(c.isalpha() for c in t)}
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small).cache()
        if name != "piece_ids":
            assert out.columns == documents.columns
        seen[name] = {r["doc_id"]: r for r in out.collect()}
        assert len(seen[name]) == out.count()
        docs = out
    assert set(seen["language"]) == lettered
    assert set(seen["near_duplicates"]) == {i for i in lettered if group[i] == i}
    assert set(seen["benchmark"]) == {i for i in seen["near_duplicates"] if not hits[i][1]}
    assert set(seen["personal_data"]) == set(seen["benchmark"]) == set(seen["piece_ids"])
    for i, r in seen["personal_data"].items():
        assert plain_spans(r["text"]) == [] and r["n_chars"] == len(r["text"])
    assert all(r["n_tokens"] == len(r["ids"]) > 0 for r in seen["piece_ids"].values())
    assert docs.select(F.sum("n_tokens")).first()[0] == sum(r["n_tokens"] for r in seen["piece_ids"].values())


def test_awkward_rows(spark, small, awkward):
    docs = awkward.withColumn("source", F.lit("s")).select("doc_id", "text", "lang", "source", "n_chars")
    for docs_in in (docs, docs.limit(0)):
        out = docs_in
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, small)
        kept = sorted(str(r["doc_id"]) for r in out.collect())
        assert kept == (["5", "6", "7", "8", "None"] if docs_in is docs else [])


def test_near_copies_between_80_and_85_per_cent_are_one(spark, small):
    """100 words each, of which the last ones differ."""
    words = [f"w{i}" for i in range(100)]
    near = words[:90] + [f"x{i}" for i in range(10)]  # 86 of 106 shingles: 0.81
    far = words[:88] + [f"y{i}" for i in range(12)]  # 84 of 108: 0.78
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, small)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_near_duplicate_stage_against_plain_groups(spark, small, documents, texts):
    group = plain.components({i: plain.shingles(t) for i, t in texts.items()}, 80)
    kept = corpus_pipeline.near_duplicates(spark, documents, small)
    assert {r["doc_id"] for r in kept.collect()} == {i for i in texts if group[i] == i}


def test_language_stage_keeps_letters_without_a_model(spark, small):
    """No labels, labels on null texts only, and a label that reads like no language."""
    for label, other, filled in ((None, None, None), (None, "en", None), ("und", None, "und")):
        rows = [(1, "some clean words", label), (2, "other clean words", None), (3, "123 !", None), (4, None, other)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        got = corpus_pipeline.language(spark, docs, small).collect()
        assert sorted((r["doc_id"], r["lang"]) for r in got) == [(1, filled), (2, filled)]


def test_clashing_columns_keep_their_values(spark, small, awkward):
    docs = awkward.withColumn("source", F.lit("s"))
    clashes = ("lang_pred", "lettered", "n_hit", "items", "hit_spans", "Score", "component_id", "n_shingles")
    docs = docs.drop("score").withColumns({c: F.lit("taken") for c in clashes})
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
        rows = docs.collect()
        assert rows
        if name != "piece_ids":
            assert docs.columns == columns
            taken = [c for c in columns if c not in ("doc_id", "text", "lang", "n_chars", "source")]
            assert {r[c] for r in rows for c in taken} == {"taken"}
    assert {r[c] for r in rows for c in clashes} == {"taken"}
