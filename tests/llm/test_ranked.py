from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np

from ledgerlens.llm import ranked
from tests.llm import plain


def plain_search(docs, queries, k=10):
    """docs: (id, text) rows; queries: (id, text) rows."""
    terms = [plain.alnum(t) for _, t in docs]
    n = sum(bool(t) for t in terms)
    words = sum(map(len, terms))
    df = Counter(w for t in terms for w in set(t))
    out = []
    for query, text in queries:
        scores = []
        for (doc, _), mine in zip(docs, terms):
            if not mine:
                continue
            tf, m = Counter(mine), 25 + (75 * len(mine) * n) // words
            score = 0
            for w in plain.alnum(text):
                if tf[w]:
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1)))
                    score += weight * (1_000_000_000 * tf[w] // (1000 * tf[w] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc))
        best = sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k]
        out += [(query, r, doc, -s) for r, (s, _, doc) in enumerate(best, 1)]
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(seed=3, docs=300):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    pick = lambda n: " ".join(vocabulary[min(399, int(rng.paretovariate(0.6)) - 1)] for _ in range(n))
    rows = [(rng.randint(0, 10_000), pick(rng.choice([1, 5, 40, 200]))) for _ in range(docs)]
    rows += [(20_000 + i, rows[i][1]) for i in range(30)] + [rows[0], rows[0]]
    queries = [(i, pick(rng.choice([1, 3, 12, 40]))) for i in range(25)]
    return rows, queries


def test_against_plain_search(spark):
    rows, queries = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked = spark.createDataFrame(queries, "item_id long, text string")
    want = plain_search(rows, queries)
    assert result(ranked.search(docs, asked)) == want
    # Many segments per task, blocks of few queries, other partitions: the same rows.
    assert result(ranked.search(docs.repartition(5), asked, segment_postings=50, block_words=100)) == want
    assert result(ranked.search(docs, asked, k=3)) == plain_search(rows, queries, 3)


def test_accumulators_close_and_survivors_stay_exact():
    rng = np.random.default_rng(1)
    docs = 2000
    parts = []
    for term, share in enumerate((0.004, 0.02, 0.5, 0.9)):
        doc = np.flatnonzero(rng.random(docs) < share)
        parts.append((np.full(len(doc), term), doc, rng.integers(1, 4, len(doc))))
    term, doc, tf = (np.concatenate([p[i] for p in parts]) for i in range(3))
    frequency = np.bincount(term)
    weight = np.floor(1000 * np.log((2 * docs + 2) / (2 * frequency + 1))).astype(np.int64)
    statistics = ranked.Statistics(docs, docs * 20, weight, frequency)
    ids = np.arange(docs)
    segment = ranked.Segment([(term, doc, tf, ids, np.ones(docs, bool), np.full(docs, 20))], statistics, 4)
    whole = np.zeros(docs, np.int64)
    np.add.at(whole, segment.doc, segment.gain)
    found, score = ranked.evaluate(segment, np.arange(4), np.ones(4, np.int64), 10, 0)
    assert (score == whole[found]).all()
    assert len(found) < 200, "the frequent terms alone must not open accumulators"
    assert set(np.lexsort((ids, -whole))[:10]) <= set(found)


def test_awkward_rows(spark, awkward, no_docs):
    queries = [(1, "quick fox"), (1, "quick fox"), (None, "perro"), (2, None), (3, ""), (4, "!?"), (5, "nowhere"), (6, "日本語のテキスト xxx")]
    asked = spark.createDataFrame(queries, "item_id long, text string").selectExpr("*", "1 AS score", "'x' AS rank", "2 AS doc_id")
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert result(ranked.search(awkward, asked)) == plain_search(rows, queries)
    assert ranked.search(no_docs, asked).collect() == []
    assert ranked.search(awkward, asked.limit(0)).collect() == []
    assert ranked.search(awkward, asked.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
