from __future__ import annotations

import random

import pytest

from ledgerlens.llm import license_scan as ls
from tests.llm import plain


def plain_places(words):
    out = []
    for phrase, label in ls.PHRASES:
        p = phrase.split()
        out += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    return out


def check(rows):
    for r in rows:
        words = plain.alnum(r["text"])
        places = plain_places(words)
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        starts = [i for i, _ in places]
        assert (r["first_word"], r["last_word"]) == ((min(starts), max(starts)) if starts else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and (r["score"] == 1 or not places)


def test_places_match_plain_search(spark, documents):
    rng = random.Random(1)
    pieces = " ".join([p for p, _ in ls.PHRASES] + [t for _, t in ls.TEMPLATES]).split() + ["word"] * 20
    docs = [(i, " ".join(rng.choice(pieces) for _ in range(rng.randint(0, 80)))) for i in range(150)]
    docs += [(900, "cc by cc by mit license mit license"), (901, "MIT\nLicense"), (902, "gnu general gnu general public license")]
    check(ls.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    check(ls.scan(documents).collect())


def test_templates_are_covered_by_chained_matches(spark):
    whole = dict(ls.TEMPLATES)["mit-text"]
    words = whole.split()
    edited = " ".join([*words[:15], "really", *words[15:30], "very", "much", *words[31:]])
    rows = {
        r["doc_id"]: r
        for r in ls.scan(
            spark.createDataFrame(
                [(1, f"intro {whole} outro"), (2, f"a b {edited} c"), (3, " ".join(words[:12])), (4, "All rights reserved.")],
                "doc_id long, text string",
            )
        ).collect()
    }
    assert rows[1]["labels"] == "mit-text" and rows[1]["score"] == 1
    assert rows[1]["license_spans"][0]["start"] == 1
    assert rows[2]["labels"] == "mit-text" and 0.9 < rows[2]["score"] < 1
    assert rows[3]["labels"] == "" and 0 < rows[3]["score"] < 0.5
    assert rows[4]["labels"] == "all-rights-reserved"


def test_matching_statistics_are_longest_runs():
    scanner = ls.build_scanner((("a b", "x"),), (("t", "a b c a b d e f"), ("u", "c a b d")))
    found, long = scanner.matches(0, _tokens(scanner, "a b c a b d e f"))
    assert [p for p, _ in found] == [0, 3] and long == [(0, 8, long[0][2])]
    assert scanner.chains(long)[0][0] == "t"


def test_rules_that_cannot_match(spark):
    for rules in ((("gpl", "gpl"),), ()), ((), (("t", "two words"),)), ((("?", "x"),), ()):
        with pytest.raises(ValueError):
            ls.build_scanner(*rules)
    docs = spark.createDataFrame([(1, "mit license"), (2, None)], "doc_id long, text string")
    rows = ls.scan(docs, phrases=(), templates=()).collect()
    assert [(r["n_words"], r["n_base"], r["labels"], r["score"]) for r in rows] == [(2, 0, "", 0), (0, 0, "", 0)]


def _tokens(scanner, text):
    from ledgerlens.llm import text as tx

    return scanner.words.find(tx.split_words(*tx.text_of([text]), tx.NON_WORD).hash)[1]


def test_awkward_rows(awkward, no_docs):
    rows = ls.scan(awkward).collect()
    assert len(rows) == awkward.count()
    check(rows)
    assert ls.scan(no_docs).collect() == []


def _plain_coverage(words, template):
    """Longest common subsequence over the words that stand in common runs of three."""
    t = plain.alnum(template)
    cells = {
        (i + k, j + k)
        for i in range(len(words) - 2)
        for j in range(len(t) - 2)
        if words[i : i + 3] == t[j : j + 3]
        for k in range(3)
    }
    best = [0] * (len(t) + 1)
    for i in range(len(words)):
        row = [0]
        for j in range(len(t)):
            row.append(max(best[j + 1], row[j], best[j] + 1 if (i, j) in cells else 0))
        best = row
    return best[-1] / len(t)


def _scanned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for r in sorted(ls.scan(docs).collect(), key=lambda r: r["doc_id"])]


def test_templates_get_their_own_matches(spark):
    """Words that another template's match goes on with, and insertions of more than MAX_GAP words."""
    notice = dict(ls.TEMPLATES)["cc-by-4.0"]
    mit = plain.alnum(dict(ls.TEMPLATES)["mit-text"])
    line = "copyright 2024 some one and others of some firm somewhere".split()
    rows = _scanned(
        spark,
        [
            f"x {notice.replace(' a ', ' the ')}",
            " ".join(["x", *mit[:30], *line, *mit[30:], "y"]),
            " ".join([*mit[:20], *line * 3, *mit]),
        ],
    )
    assert rows[0]["labels"] == "cc-by-4.0" and rows[0]["score"] == 12 / 13
    assert rows[1]["labels"] == "mit-text" and rows[1]["score"] == 1
    assert [(s["start"], s["end"]) for s in rows[1]["license_spans"]] == [(1, 31), (41, 41 + len(mit) - 30)]
    assert [(s["start"], s["end"]) for s in rows[2]["license_spans"]] == [(50, 50 + len(mit))]


def test_coverage_is_the_longest_chain(spark):
    rng = random.Random(4)
    templates = [t.split() for _, t in ls.TEMPLATES]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 8)):
            t = rng.choice(templates)
            a = rng.randrange(len(t))
            parts += t[a : a + rng.randint(1, 30)] + ["word"] * rng.choice([0, 0, 1, 12])
        texts.append(" ".join(parts))
    for text, r in zip(texts, _scanned(spark, texts)):
        words = plain.alnum(text)
        share = {label: _plain_coverage(words, t) for label, t in ls.TEMPLATES}
        covered = {label for label, c in share.items() if c >= ls.COVERAGE}
        assert set(filter(None, r["labels"].split(","))) == covered | set(filter(None, r["base_labels"].split(",")))
        if not r["n_base"]:
            assert abs(r["score"] - max(share.values())) < 1e-12
        assert {(s["label"], s["coverage"]) for s in r["license_spans"]} == {(x, share[x]) for x in covered}


def test_every_template_is_told_from_the_others(spark):
    """A notice gets its own label, and no other but those of the phrases it holds."""
    names = [n for n, _ in ls.TEMPLATES]
    assert len(set(names)) == len(names)
    texts = [t for _, t in ls.TEMPLATES] + ["word " * 30 + t + " word" * 30 for _, t in ls.TEMPLATES]
    for row, name in zip(_scanned(spark, texts), names * 2):
        assert set(row["labels"].split(",")) - set(row["base_labels"].split(",")) == {name}, (name, row["labels"])


def test_whole_files_carry_all_their_parts(spark):
    rules = dict(ls.TEMPLATES)
    mit = f"MIT License Copyright (c) 2020 A. Person {rules['mit-text']}, and to permit persons to do so: {rules['mit-conditions']}."
    bsd = f"Copyright 2019 {rules['bsd-text']}, this list. 3. {rules['bsd-3-clause']}. {rules['bsd-disclaimer']}."
    rows = _scanned(spark, [mit, bsd, "# SPDX-License-Identifier: LGPL-2.1-only", "license identifier of the software", "GNU General Public License"])
    assert [r["labels"] for r in rows] == ["mit,mit-conditions,mit-text", "bsd-3-clause,bsd-disclaimer,bsd-text", "spdx-lgpl", "", "gpl"]
