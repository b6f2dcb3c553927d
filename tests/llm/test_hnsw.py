from __future__ import annotations

import math

import numpy as np

from ledgerlens.llm import hnsw


def plain_nearest(rows, queries, k=10):
    out = {}
    for q, v in queries:
        found = sorted((math.sqrt(((np.array(x) - np.array(v)) ** 2).sum()), i) for i, x in rows if i != q and len(x) == len(v))
        out[q] = found[:k]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(found, expected):
    hits = sum(len({i for _, i in found.get(q, [])} & {i for _, i in e}) for q, e in expected.items())
    return hits / sum(len(e) for e in expected.values())


def test_recall_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r[0], r[1]) for r in table.collect()]
    found = result(hnsw.nearest(table, table.where("vec_id % 100 = 0"), shard_rows=600))
    expected = plain_nearest(rows, [r for r in rows if r[0] % 100 == 0])
    assert recall(found, expected) >= 0.9
    first = expected[0][0]
    assert found[0][0][1] == first[1] and abs(found[0][0][0] - first[0]) < 1e-12


def test_recall_on_clusters():
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((40, 16)) * 8
    points = (centres[rng.integers(0, 40, 3000)] + rng.standard_normal((3000, 16))).astype(np.float32)
    graph = hnsw.Graph.from_bytes(hnsw.Graph.build(points).to_bytes())
    hits = 0
    for q in range(60):
        query = points[q] + 0.1
        near = np.argsort(((points - query) ** 2).sum(1), kind="stable")[:10]
        hits += len(set(near) & set(graph.search(query, 100)[:10].tolist()))
    assert hits / 600 >= 0.9
    assert all(len(a) == len(b) and a.shape[1] in (hnsw.LINKS, 2 * hnsw.LINKS) for a, b in zip(graph.links, graph.nodes))


def test_equal_vectors_ties_and_odd_rows(spark):
    rows = [(i, [1.0, 2.0]) for i in range(40)] + [(100, [1.0, 3.0]), (101, [1.0, 1.0]), (102, [2.0, 2.0])]
    odd = [(200, None), (201, [0.0, 0.0]), (202, [float("nan"), 1.0]), (203, [None, 1.0]), (204, [float("inf"), 1.0]), (205, []),
           (None, [1.0, 2.0]), (206, [5.0, 5.0, 5.0])]
    frame = spark.createDataFrame([(*r, "x", 0.5) for r in [*rows, *odd, rows[3]]], "vec_id long, embedding array<float>, id string, score double")
    queries = frame.where("vec_id in (0, 20, 100, 200, 201, 206)")
    found = result(hnsw.nearest(frame, queries))
    expected = plain_nearest(rows, [r for r in rows if r[0] in (0, 20, 100)])
    assert found == expected
    assert result(hnsw.nearest(frame.where("vec_id >= 100"), queries))[100] == plain_nearest(rows[40:], [rows[40]])[100]
    assert hnsw.nearest(frame.limit(0), queries.limit(0)).collect() == []


def test_an_id_with_several_vectors_is_listed_once(spark):
    rows = [(0, [0.0, 1.0]), (1, [0.0, 1.1]), (1, [0.0, 1.2]), (1, [5.0, 1.0]), (2, [0.0, 1.15]), (2, [0.0, 1.3]), (3, [9.0, 9.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for shard_rows in (2, 100):
        got = hnsw.nearest(docs, docs.where("vec_id = 0"), shard_rows=shard_rows).orderBy("rank").collect()
        assert [(r["rank"], r["vec_id"]) for r in got] == [(1, 1), (2, 2), (3, 3)]
        assert abs(got[0]["score"] - 0.1) < 1e-12 and abs(got[1]["score"] - 0.15) < 1e-12
