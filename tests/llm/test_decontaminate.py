from __future__ import annotations

import random

import pytest

from ledgerlens.llm import decontaminate as dc
from tests.llm import plain


def expected(docs, items, window=10):
    out = {}
    grams = [(i, plain.alnum(t)) for i, t in items]
    grams = [(i, w[k : k + min(window, len(w))]) for i, w in grams if w for k in range(len(w) - min(window, len(w)) + 1)]
    for doc, text in docs:
        words = plain.alnum(text)
        hit, found = set(), set()
        for item, g in grams:
            for k in range(len(words) - len(g) + 1):
                if words[k] == g[0] and words[k : k + len(g)] == g:
                    hit.update(range(k, k + len(g)))
                    if item is not None:
                        found.add(str(item))
        out[doc] = (len(words), len(hit), sorted(found))
    return out


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 4, 9, 10, 11, 25])))) for i in range(40)]
    items += [(3, "w1 w2 w3"), (None, "w4 w4 w4 w4"), (90, None), (91, "..."), (92, "W5-w5")]
    docs = []
    for i in range(60):
        text = [rng.choice([*words, "z"]) for _ in range(rng.randint(0, 60))]
        if i % 3 == 0:
            at = rng.randint(0, len(text))
            text[at:at] = (items[rng.randrange(40)][1] or "").split()
        docs.append((i, " ".join(text)))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    return *frames, expected(docs, items)


@pytest.mark.parametrize("block_words", [dc.BLOCK_WORDS, 60])
def test_matches_plain_search(case, block_words):
    """In one block, and in many that are merged."""
    docs, items, plain_result = case
    rows = dc.decontaminate(docs, items, keep=["doc_id"], block_words=block_words).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in rows} == plain_result
    for r in rows:
        spans = r["hit_spans"]
        assert sum(b - a for a, b in zip(spans[::2], spans[1::2])) == r["n_hit"]


def test_awkward_rows(spark, awkward, no_docs):
    items = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog"), (2, "")], "item_id long, text string")
    rows = dc.decontaminate(awkward, items).collect()
    assert len(rows) == awkward.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert (by_id[6]["n_hit"], by_id[6]["items"]) == (9, ["1"])
    assert by_id[5]["n_hit"] == 27_000
    assert all(by_id[i]["n_hit"] == 0 for i in (1, 2, 3, 4, None, 7, 8))
    assert by_id[1]["n_words"] == 0
    assert dc.decontaminate(no_docs, items).collect() == []
    assert all(r["n_hit"] == 0 for r in dc.decontaminate(awkward, items.limit(0)).collect())
