from __future__ import annotations

import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import pii
from ledgerlens.llm.tagger import Tagger


def plain_spans(text):
    """The patterns as they are written in the contract."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        if 14 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a@.-_+ 0123456789()é", max_size=60))
def test_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_patterns_in_long_runs_take_linear_time():
    text = "a" * 200_000 + " " + "1" * 200_000 + " " + "+1 " * 50_000 + "x@" * 50_000
    assert pii.base_spans(text) == []


def test_gradients():
    rng = np.random.default_rng(0)
    model = Tagger.fresh(20, 5, embed=3, size=4)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    codes, gold = rng.integers(0, 20, (9, 4)), rng.integers(0, 5, (9, 4))
    _, grads = model.gradients(codes, gold)
    for name, w in model.weights.items():
        at = (codes[0, 0], 1) if name == "embed" else tuple(rng.integers(0, n) for n in w.shape)
        w[at] += 1e-6
        up, _ = model.gradients(codes, gold)
        w[at] -= 2e-6
        down, _ = model.gradients(codes, gold)
        w[at] += 1e-6
        assert abs((up - down) / 2e-6 - grads[name][at]) < 1e-6


def windows(seed, size):
    rng = random.Random(seed)
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    made = []
    for _ in range(size):
        word = "".join(rng.choice("abcdefgh") for _ in range(5))
        kind = rng.randrange(4)
        body = [f"{word}.{d(2)}@mail{d(1)}.example.com", f"{d(2)}.1{d(2)}.{d(2)}.{d(1)}", f"v{d(1)}.{d(1)} {d(5)}", f"+1 ({d(3)}) 555-{d(4)}"][kind]
        text = f"{word} {word} {body} {word} {word} {word}"
        tags = np.zeros(len(text), np.int64)
        for a, k, b in plain_spans(text):
            tags[a:b] = k + 1
        points = np.array([ord(c) for c in text], dtype=np.uint32)
        starts = np.array([0])
        made.append((pii._cut(pii.encode(points), starts)[0], pii._cut(tags, starts)[0]))
    return tuple(np.stack(x) for x in zip(*made))


def test_held_out_spans_are_found():
    model = Tagger.fresh(pii.ALPHABET, 5)
    model.fit(*windows(1, 500), steps=120)
    codes, gold = windows(2, 200)
    found = model.decode(codes)
    inside = gold > 0
    assert (found[inside] == gold[inside]).mean() > 0.9
    assert (found[~inside] == 0).mean() > 0.97


def test_windows_are_reconciled():
    starts = pii._window_starts(np.array([5, 100]))
    assert starts.tolist() == [-32, 0, 64, 96]
    tags = np.zeros((4, pii.WINDOW), np.int8)
    tags[0], tags[1], tags[2], tags[3] = 1, 2, 3, 4
    where, tag = pii._reconciled(tags, starts)
    by = dict(zip(where.tolist(), tag.tolist()))
    assert by[0] == 1 and by[31] == 2 and by[90] == 3 and by[130] == 4 and len(by) == len(where)


def test_whole_documents(spark, documents):
    model = pii.fit(documents, steps=60)
    rows = pii.find(documents, model).collect()
    for r in rows:
        base = plain_spans(r["text"] or "")
        listed = pii._listed(base)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == i for s in base) for i in range(4)]
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(filter(None, r["spans"].split(",")))
    cleaned = {r["doc_id"]: r["text"] for r in pii.mask(documents, model).collect()}
    for r in rows:
        assert plain_spans(cleaned[r["doc_id"]] or "") == []
        if not r["spans"]:
            assert cleaned[r["doc_id"]] == r["text"]


def test_masks():
    text = "a@b.cc +1 (234) 555-6789 x"
    assert pii.masked(text, plain_spans(text)) == "<email> <phone> x"
    assert pii.masked("abcdef", [(0, 0, 4), (2, 3, 5)]) == "<email>f"


def test_slices_with_and_without_marks(spark):
    """A slice in which nothing is masked has the same schema as one with marks."""
    rows = [(i, ("x" * 700_000) if i % 4 else f"mail a.b{i}@mail1.example.com now") for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = {r["doc_id"]: r["text"] for r in pii.mask(docs, None).collect()}
    assert out == {i: t if i % 4 else "mail <email> now" for i, t in rows}


def test_awkward_rows(awkward, no_docs):
    assert pii.fit(no_docs) is None
    model = pii.fit(awkward)
    rows = pii.find(awkward, model).collect()
    assert len(rows) == awkward.count() and {r["spans"] for r in rows} == {""}
    masked = pii.mask(awkward, model).collect()
    assert sorted(map(str, masked)) == sorted(map(str, awkward.collect()))
    assert pii.find(no_docs, model).collect() == []


def test_training_windows_are_bounded(spark):
    rng = random.Random(6)
    gap = lambda: " " * rng.randint(1, 30) + "-" * rng.randint(1, 30) + "\n" * rng.randint(1, 30)
    body = "".join((f"a{i}@b{i}.cc" if i % 2 else f"k{i}") + gap() + " word" * 30 for i in range(2000))
    windows = pii.training_windows(spark.createDataFrame([(body,)], "text string"))
    pairs = lambda df: sorted((bytes(r["codes"]), bytes(r["tags"])) for r in df.collect())
    whole = pairs(windows)
    assert min(sum(any(t) == f for _, t in whole) for f in (True, False)) > 600
    kept = pairs(pii.bounded(windows, 200))
    assert set(kept) <= set(whole)
    assert all(120 < sum(any(t) == f for _, t in kept) < 280 for f in (True, False))
    assert pairs(pii.bounded(windows)) == whole


MATCHES = ["ann.b7@mail3.example.com", "97.51.17.173", "4111111111111111", "+1 (234) 555-7713"]


def test_forms_are_beyond_the_patterns():
    for kind, match in enumerate(MATCHES):
        for version in range(len(pii._FORMS[kind])):
            text = f"see {match} today"
            body, [(start, k, end)] = pii.rewritten(text, [(4, kind, 4 + len(match))], version)
            assert k == kind and (start, kind, end) not in plain_spans(body)
            assert body.startswith("see ") and body.endswith(" today")
            assert pii._plausible(kind, body[start:end])
            assert pii._snapped(kind, body, start, end) == (start, end)


def test_rewritten_texts_keep_what_stands_between():
    text = "a1@b2.cc, 10.20.30.40; 4111111111111111 x +1 (234) 555-7713"
    spans = plain_spans(text)
    for version in range(6):
        body, made = pii.rewritten(text, spans, version)
        assert [k for _, k, _ in made] == [k for _, k, _ in spans] and len(made) == 4
        assert ", " in body and "; " in body and " x " in body
    assert pii.rewritten("plain", [], 0) == ("plain", [])
    # The second of two overlapping spans is left out.
    assert len(pii.rewritten("4111111111111111", [(0, 2, 16), (4, 2, 16)], 0)[1]) == 1


def test_spans_are_snapped_and_checked():
    def spans(text, tagged, kind):
        points = pii._code_points(text)
        starts = np.arange(-pii.STRIDE, len(text), pii.STRIDE)
        tags = np.zeros(len(text), np.int8)
        tags[slice(*tagged)] = kind + 1
        return pii.tagged_spans(text, points, starts, pii._cut(tags, starts))

    assert spans("on 234.555.7713 it", (4, 14), 3) == [(3, 3, 15)]
    assert spans("on 2345557713 it", (3, 13), 3) == []  # digits without groups or plus sign
    assert spans("4111111111111111 12", (0, 16), 2) == [(0, 2, 16)]
    assert spans("4111111111111112 12", (0, 16), 2) == []
    assert spans("41111111111111111234 ", (0, 16), 2) == []  # not a part of a longer number
    assert spans("x 1 . 2 . 3 . 4, y", (1, 16), 1) == [(2, 1, 15)]
    assert spans("x 1 2 3 4 y", (2, 9), 1) == []
    assert spans("to ann @ b.cc. So", (3, 14), 0) == [(3, 0, 13)]
    assert spans("to ann @ bcc So", (3, 12), 0) == []


def test_rewritten_spans_of_other_documents_are_found(spark):
    from pyspark.sql import functions as F

    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = pii.fit(documents.where(fold != 1))
    rows = {r["kind"]: r for r in pii.rewritten_recall(documents.where(fold == 1), model).collect()}
    for kind in pii.KINDS:
        assert rows[kind]["made"] >= 25 and rows[kind]["found"] >= 0.9 * rows[kind]["made"]
        assert rows[kind]["others"] <= 2
    assert {r["found"] for r in pii.rewritten_recall(documents.where(fold == 1), None).collect()} == {0}
