"""Kernels on one text of 20 MB: what they allocate stays below a stated multiple of the text."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pytest

from ledgerlens.llm import langid, text as tx

SIZE = 20_000_000


@pytest.fixture(scope="module")
def long_text():
    rng = np.random.default_rng(3)
    words = rng.choice(np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8), (SIZE // 8 + 1, 8))
    words[:, 7] = 32
    return words.ravel()[:SIZE].copy(), np.array([0, SIZE])


def peak(work) -> int:
    tracemalloc.start()
    work()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


def test_words(long_text):
    assert peak(lambda: tx.split_words(*long_text, tx.SPACES)) < 12 * SIZE


def test_language(long_text):
    assert peak(lambda: langid.gram_counts(*long_text)) < 25 * SIZE


def test_hashes_do_not_depend_on_the_block(long_text):
    data = long_text[0][:300_000]
    start = np.arange(0, 299_000, 997)
    ends = start + 700
    ranges = tx.range_hash(data, start, ends)
    assert (tx.word_hash(data, start, ends) == ranges).all()
    alone = [tx.range_hash(data[a:b], np.array([0]), np.array([b - a]))[0] for a, b in zip(start, ends)]
    assert (ranges == np.array(alone)).all()
