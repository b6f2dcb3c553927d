from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import text as tx
from tests.llm import plain

TEXT = st.lists(st.text(alphabet="aAbZ09 .,\t\n\x00\x7fé日😀-", max_size=40), min_size=1, max_size=5)


@settings(max_examples=60, deadline=None)
@given(TEXT)
def test_words_are_those_of_the_patterns(texts):
    data, offsets = tx.text_of(texts)
    for separators, words in ((tx.SPACES, plain.spaced), (tx.NON_WORD, plain.alnum)):
        found = tx.split_words(data, offsets, separators)
        expected = [words(t) for t in texts]
        assert found.counts.tolist() == [len(w) for w in expected]
        flat = [w for ws in expected for w in ws]
        cut = [found.data[a:b].tobytes().decode() for a, b in zip(found.start, found.end)]
        assert cut == flat
        assert len(set(found.hash.tolist())) == len(set(flat))
        if flat:
            same = {}
            for w, h in zip(flat, found.hash.tolist()):
                assert same.setdefault(w, h) == h


@settings(max_examples=60, deadline=None)
@given(TEXT)
def test_code_points(texts):
    points, borders = tx.code_points(*tx.text_of(texts))
    assert [chr(p) for p in points] == list("".join(texts))
    assert np.diff(borders).tolist() == [len(t) for t in texts]


def test_equal_words_hash_alike_across_slices():
    one = tx.split_words(*tx.text_of(["alpha beta"]), tx.SPACES)
    other = tx.split_words(*tx.text_of(["x " * 5000 + "beta", "alpha"]), tx.SPACES)
    assert one.hash[1] == other.hash[-2] and one.hash[0] == other.hash[-1]
    grams = tx.gram_hash(other.hash, 3)
    assert len(grams) == len(other.hash) - 2 and grams[0] == grams[1]
    assert tx.gram_hash(one.hash[:1], 1)[0] != tx.gram_hash(one.hash, 2)[0]
