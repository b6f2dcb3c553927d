from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import lm
from tests.llm import plain

END, START = ("end",), ("start",)


def plain_scores(rows, held, cut):
    """The same model with dictionaries."""
    tokens = [plain.spaced(t) + [END] for _, t in rows]
    train = [k for k in range(len(rows)) if not held(k)]
    kept = [k for k in train if not cut(k)]

    def count(which):
        one, two = Counter(), Counter()
        for k in which:
            one.update(tokens[k])
            two.update(zip([START, *tokens[k][:-1]], tokens[k]))
        one_context = one + Counter({START: len(which)})
        return one, two, one_context, sum(one.values())

    one, two, context, total = count(kept)
    distinct = len(count(train)[0])
    cells = {}
    for k in set(train) - set(kept):
        for u, v in zip([START, *tokens[k][:-1]], tokens[k]):
            f2 = two[u, v] / max(1, context[u])
            key = (int(math.log2(context[u])) + 1 if context[u] else 0, f2, one[v] / max(1, total))
            cells[key] = cells.get(key, 0) + 1
    keys = list(cells)
    arrays = [np.array([k[i] for k in keys], float if i else int) for i in range(3)]
    weights = lm.learn_weights((arrays[0], np.array([cells[k] for k in keys]), arrays[1], arrays[2]), distinct)
    one, two, context, total = count(train)
    out = []
    for k in range(len(rows)):
        base = score = 0.0
        for u, v in zip([START, *tokens[k][:-1]], tokens[k]):
            w = weights[int(math.log2(context[u])) + 1 if context[u] else 0]
            p = w[0] * two[u, v] / max(1, context[u]) + w[1] * one[v] / max(1, total) + w[2] / (distinct + 1)
            score += math.log10(p)
            base += math.log10((one[v] + 0.5) / (total + 0.5 * (distinct + 1)))
        out.append((len(tokens[k]), sum(one[v] > 0 for v in tokens[k]), total, base, score))
    return out


@pytest.mark.parametrize("chunk_bytes,shard_keys", [(lm.CHUNK_BYTES, lm.SHARD_KEYS), (500, 40)])
def test_matches_dictionaries(spark, chunk_bytes, shard_keys):
    """In one chunk and shard, and in many."""
    rng = random.Random(3)
    words = [f"w{int(rng.paretovariate(0.8))}" for _ in range(400)]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for k in range(80)]
    rows[5], rows[6] = (5, None), (6, " ")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = lm.lm_scores(docs, F.col("doc_id") % 5 == 1, F.col("doc_id") % 5 == 2, chunk_bytes=chunk_bytes, shard_keys=shard_keys)
    got = {r["doc_id"]: r for r in found.collect()}
    expected = plain_scores(rows, lambda k: k % 5 == 1, lambda k: k % 5 == 2)
    for (i, _), e in zip(rows, expected):
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == e[:3]
        assert r["base_score"] == pytest.approx(e[3], rel=1e-9)
        # The weights are learned from bins, which moves them a little.
        assert r["score"] == pytest.approx(e[4], rel=2e-3)
        assert r["held_out"] == (i % 5 == 1)


def test_weights_maximise_the_held_out_likelihood():
    rng = np.random.default_rng(1)
    two, one = rng.random(500), rng.random(500)
    w = lm.learn_weights((np.full(500, 3), np.ones(500), two, one), 9, rounds=400)[3]

    def likelihood(v):
        return np.log(v[0] * two + v[1] * one + v[2] / 10).sum()

    assert w.sum() == pytest.approx(1)
    for _ in range(200):
        other = rng.dirichlet([1, 1, 1])
        assert likelihood(other) <= likelihood(w) + 1e-3


def test_pairs_help_on_held_out_text(spark, small):
    from ledgerlens.llm.queries import QUERIES

    rows = QUERIES["op5_lm_scores"](spark, small).where("held_out").collect()
    assert sum(r["score"] for r in rows) > 0.9 * sum(r["base_score"] for r in rows)


def test_awkward_rows(awkward, no_docs):
    rows = lm.lm_scores(awkward, F.lit(False), F.col("doc_id") == 6).collect()
    assert len(rows) == awkward.count() and all(math.isfinite(r["score"]) for r in rows)
    assert all(r["n_tokens"] == 1 for r in rows if r["doc_id"] in (1, 2, 3))
    untaught = lm.lm_scores(awkward, F.lit(True), F.lit(None).cast("boolean")).collect()
    assert all(r["score"] == 0 and r["n_known"] == 0 for r in untaught)
    assert lm.lm_scores(no_docs, F.lit(False), F.lit(False)).collect() == []


def test_packing():
    for values in ([], [0], [1, 2**32 - 1, 7] * 100):
        assert lm._unpack(lm._pack(np.array(values, dtype=np.int64))).tolist() == values


def test_packing_of_large_totals():
    for values in ([2**32], [3, 2**32 - 1, 2**53, 2**32 + 5] * 100):
        assert lm._unpack(lm._pack(np.array(values, dtype=np.int64))).tolist() == values
