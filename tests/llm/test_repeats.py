from __future__ import annotations

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import repeats


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_repeats(rows, window=13):
    """(id, words, removed, kept text, spans) of (id, text) rows."""
    first = {}
    for doc, text in rows:
        words = plain_words(text)
        for i in range(len(words) - window + 1) if doc is not None else ():
            key = tuple(words[i : i + window])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        words = plain_words(text)
        gone = [False] * len(words)
        for i in range(len(words) - window + 1) if doc is not None else ():
            if first[tuple(words[i : i + window])] < doc:
                gone[i : i + window] = [True] * window
        edges = [i for i in range(len(words) + 1) if (i > 0 and gone[i - 1]) != (i < len(words) and gone[i])]
        out.append((doc, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g), edges))
    return sorted(out, key=str)


def result(df):
    return sorted(((r[0], r[1], r[2], r[3], list(r[4])) for r in df.collect()), key=str)


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefg") + rng.choice(["", "A", "é", "日"])
    shared = [[word() for _ in range(n)] for n in (13, 14, 20, 55, 200, 12)]
    shared.append(["of", "the"] * 20)
    rows = []
    for i in range(80):
        words = []
        for _ in range(rng.randint(0, 6)):
            part = rng.choice(shared)
            a = rng.randrange(len(part))
            words += rng.choice([part, part[a:], part[:a], [word() for _ in range(rng.randint(1, 30))]])
        rows.append((rng.randint(-40, 60), rng.choice([" ", "\n", "\t \x0b"]).join(words)))
    # A frequent beginning before ever different words.
    rows += [(100 + i, "all rights reserved by the " + " ".join(word() for _ in range(25))) for i in range(30)]
    return rows + [rows[3], rows[3], (7, None), (None, rows[5][1]), (900, rows[5][1]), (901, "  "), (902, rows[5][1].upper())]


def test_against_plain_windows(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_repeats(rows)
    assert sum(r[2] for r in want) > 500
    assert result(repeats.remove_repeats(docs)) == want
    # Small chunks and shards, and anchors refined to windows from two passages on.
    small = dict(chunk_bytes=700, shard_anchors=20, shard_passages=10)
    for crowded in (1, 4, 2000):
        assert result(repeats.remove_repeats(docs.repartition(5), crowded=crowded, **small)) == want
    for window in (3, 7, 40):
        assert result(repeats.remove_repeats(docs, window=window, **small)) == plain_repeats(rows, window)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=12), max_size=5), st.lists(st.integers(0, 3), max_size=20))
def test_matching_statistics(added, streamed):
    automaton = repeats.Automaton()
    for tokens in added:
        automaton.add(tokens)
    held = {tuple(t[a:b]) for t in added for a in range(len(t)) for b in range(a + 1, len(t) + 1)}
    want = [max([n for n in range(1, i + 2) if tuple(streamed[i + 1 - n : i + 1]) in held], default=0) for i in range(len(streamed))]
    assert automaton.statistics(streamed) == want
    # As many states as a minimal automaton at most.
    assert len(automaton.size) <= max(2, 2 * sum(map(len, added)))


def test_awkward_rows(awkward, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert result(repeats.remove_repeats(awkward)) == plain_repeats(rows)
    assert repeats.remove_repeats(no_docs).collect() == []


def test_one_very_long_text(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(150_000)]
    rows = [(1, " ".join(words)), (2, " ".join(["x", *words[70_000:70_100], "y"])), (0, " ".join(words[-50:]))]
    found = {r[0]: r for r in result(repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), chunk_bytes=1000))}
    assert (found[1][2], found[1][4]) == (50, [149_950, 150_000])
    assert found[2][2:] == (100, "x y", [1, 101]) and found[0][2] == 0
