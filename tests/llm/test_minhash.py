from __future__ import annotations

import random

import numpy as np

from ledgerlens.llm import minhash
from tests.llm import plain


def result(df):
    return [tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()]


def test_groups_around_a_base_text(spark):
    """A base with edited copies of every degree, copies of copies, and exact copies."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(6))
    base = [word() for _ in range(150)]
    texts = {900: " ".join(base)}
    for i in range(120):
        words = list(base) if i % 3 else texts[900 + i].split() if i and 900 + i in texts else list(base)
        for _ in range(rng.randint(0, 7)):
            words[rng.randrange(len(words))] = word()
        texts[rng.choice([901, 100]) + i] = " ".join(words)
    texts |= {i: texts[900] for i in range(5)} | {2000 + i: " ".join(word() for _ in range(60)) for i in range(20)}
    texts |= {3000: "one two", 3001: "ONE  two", 3002: "one two three", 3003: None, 3004: " "}
    expected = plain.components({i: plain.shingles(t) for i, t in texts.items()})
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for found in (minhash.near_duplicates(docs), minhash.near_duplicates(docs.repartition(7))):
        assert {r[0]: r[2] for r in result(found)} == expected
    assert all(r[1] == len(plain.shingles(texts[r[0]])) and r[3] == (r[0] == r[2]) for r in result(found))


def test_awkward_rows(awkward, no_docs):
    rows = result(minhash.near_duplicates(awkward))
    assert len(rows) == awkward.count()
    by_id = {r[0]: r for r in rows}
    for i in (1, 2, 3):
        assert by_id[i] == (i, 0, i, True)
    assert [r for r in rows if r[0] == 6] == [(6, 5, 6, True)] * 2
    assert by_id[None] == (None, 6, None, True)
    assert by_id[5][1] == 13
    assert result(minhash.near_duplicates(no_docs)) == []


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(500, i) for i in range(501, 700)] + [(700, 699), (900, 901), (901, 900), (5, 5)]
    found = minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = {**{i: 0 for i in range(61)}, **{i: 500 for i in range(500, 701)}, 900: 900, 901: 900}
    assert sorted(map(tuple, found)) == sorted(expected.items())


def test_min_and_max_agree_as_often_as_the_sets_do():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    a, b = pool[:900], pool[100:]
    coefficients = minhash._coefficients(4096)
    x, y = minhash.min_max(a, coefficients), minhash.min_max(b, coefficients)
    assert abs((x == y).mean() - 0.8) < 0.02
    assert abs((x == y)[1::2].mean() - 0.8) < 0.03
