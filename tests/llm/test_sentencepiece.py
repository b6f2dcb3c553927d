from __future__ import annotations

import random

import numpy as np
import pytest

from ledgerlens.llm import sentencepiece as sp
from ledgerlens.llm import text as tx

TEXTS = [
    "", " ", "   ", "a", " a", "a ", "  a  b ", "\n", "\n a\n\n b", "日本語のテキスト 😀 emoji", "x" * 300, "\t tab", "tab\t",
    "<s> </s> <unk> <0x0A>", " " * 40, "aaaa    bbbb" + " " * 17 + "cc", "déjà-vu Ünïcödé", "\x00\x01", "https://www.example.com/a?b=c",
    "1234567890 3.14159", "é 　 wide",
]


@pytest.fixture(scope="module")
def vocabulary():
    return sp.load_vocabulary()


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=sp.MODEL)


def encoded(vocabulary, texts):
    encoder = sp.Encoder(vocabulary)
    data, offsets = sp._plain_spaces(*tx.text_of(texts))
    start, end, first = sp.segments(data, offsets, sp._breaks(vocabulary))
    ids, size = encoder.lookup(data, start, end, first)
    edges = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(start, offsets)]
    return [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:])]


def test_ids_are_the_librarys(vocabulary, library, texts):
    rng = random.Random(1)
    bits = "the of and in tion ing ed s un re pre 😀 é ß ñ \n \t 　 . , ! ( ) 12 345 ▁".split(" ")
    made = ["".join(rng.choice(bits) + rng.choice(["", " ", "  "]) for _ in range(50)) for _ in range(200)]
    every = TEXTS + made + [t or "" for t in texts.values()]
    assert encoded(vocabulary, every) == library.encode(every)


def test_round_trip(spark, vocabulary, documents, library):
    whole = sp.decode(sp.encode(documents, vocabulary), vocabulary).collect()
    assert len(whole) == documents.count() and all(r["decoded"] == (r["text"] or "") for r in whole)
    texts = [(i, t) for i, t in enumerate(TEXTS)]
    rows = sp.decode(sp.encode(spark.createDataFrame(texts, "i int, text string"), vocabulary), vocabulary).collect()
    assert [r["decoded"] for r in sorted(rows)] == TEXTS


def test_every_piece_is_found_where_it_stands(vocabulary):
    text = "the theme of these thesis"
    points = np.array([ord(c) if c != " " else ord(sp.SPACE) for c in text] + [0], dtype=np.uint32)
    number = np.zeros(len(vocabulary.chars) + 1, np.uint16)
    where = np.searchsorted(vocabulary.chars, points[:-1])
    present = np.unique(where)
    number[present + 1] = np.arange(1, len(present) + 1)
    codes = np.append(number[where + 1], 0).astype(np.uint16)
    start, piece = sp.Encoder(vocabulary)._lattice(codes, 8, number)
    plain = text.replace(" ", sp.SPACE)
    expected = {(i, p) for i in range(len(plain)) for p, name in enumerate(vocabulary.pieces) if plain.startswith(name, i)}
    assert set(zip(start.tolist(), piece.tolist())) == expected


def test_awkward_rows(spark, awkward, no_docs, vocabulary, library):
    rows = sp.decode(sp.encode(awkward, vocabulary), vocabulary).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert r["ids"] == library.encode(r["text"] or "") and r["decoded"] == (r["text"] or "")
    assert sp.encode(no_docs, vocabulary).collect() == []
    odd = spark.createDataFrame([(None,), ([],), ([None, -1, 10**6, 413],)], "ids array<int>")
    assert [r["decoded"] for r in sp.decode(odd, vocabulary).collect()] == [None, "", library.decode([413])]
