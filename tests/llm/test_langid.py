from __future__ import annotations

from collections import Counter

import numpy as np

from ledgerlens.llm import langid, text as tx


def plain_grams(text):
    out = Counter()
    letters = "".join(c.lower() if c.isalpha() else " " for c in text)
    for word in letters.split():
        padded = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                gram = padded[i : i + n]
                if n > 1 or gram != " ":
                    out[gram] += 1
    return out


def test_gram_counts_match_plain_counting():
    for text in ("The  cat, the CAT!", "Éa b", "a1b", "", "x"):
        for block in (2, 1 << 18):
            owner, code, count = langid.gram_counts(*tx.text_of([text, "ab", text]), block)
            for d, t in enumerate((text, "ab", text)):
                assert sorted(count[owner == d].tolist()) == sorted(plain_grams(t).values())


def test_held_out_accuracy(spark, small, documents):
    train = documents.where(~langid.held_out())
    profiles = langid.learn(train)
    assert profiles.languages == ["de", "en", "es", "fr"]
    test = documents.where(langid.held_out())
    rows = langid.identify(test, profiles).select("lang", "lang_pred", "score").collect()
    assert rows and sum(r[0] == r[1] for r in rows) / len(rows) > 0.97
    assert all(0 <= r[2] <= 1 for r in rows)


def test_distance_matches_plain_ranks(spark):
    docs = spark.createDataFrame([(1, "aab aab abc", "x"), (2, "zz zy zy", "y")], "doc_id long, text string, lang string")
    profiles = langid.learn(docs)
    far, many = langid.distances(profiles, *tx.text_of(["aab aab abc", "qqq"]))
    assert far[0].argmin() == 0 and far[0, 0] == 0
    assert many[0] == len(plain_grams("aab aab abc"))
    assert (far[1] > 0).all()


def plain_prediction(text, training, size):
    """Out-of-place distance counted word by word; ties in frequency by the operator's gram code."""

    def code(gram):
        out = np.full(1, len(gram), np.uint64)
        for c in gram:
            out = out * np.uint64(0x200003) + np.uint64(0 if c == " " else ord(c))
        return int(tx.mix(out)[0] >> np.uint64(24))

    def ranked(counts):
        order = sorted(counts, key=lambda g: (-counts[g], code(g)))[:size]
        return {g: r for r, g in enumerate(order)}

    mine = ranked(plain_grams(text))
    far = {}
    for lang, texts in training.items():
        profile = ranked(sum((plain_grams(t) for t in texts), Counter()))
        far[lang] = sum(abs(r - profile[g]) if g in profile else size for g, r in mine.items())
    if not mine:
        return "und", 0.0
    best = min(sorted(far), key=lambda k: far[k])
    return best, 1 - far[best] / (len(mine) * size)


def test_predictions_match_plain_ones(spark, documents):
    rows = documents.where("lang is not null and text is not null and n_chars < 3000").orderBy("doc_id").limit(60).collect()
    training, asked = rows[:40], rows
    by_lang = {}
    for r in training:
        by_lang.setdefault(r["lang"], []).append(r["text"])
    schema = "doc_id long, text string, lang string"
    some = [(r["doc_id"], r["text"], r["lang"]) for r in training]
    profiles = langid.learn(spark.createDataFrame(some, schema), size=60)
    docs = spark.createDataFrame([(r["doc_id"], r["text"], None) for r in asked] + [(-1, "?! 12", None)], schema)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(docs, profiles).collect()}
    for r in docs.collect():
        lang, score = plain_prediction(r["text"], by_lang, 60)
        assert found[r["doc_id"]][0] == lang and abs(found[r["doc_id"]][1] - score) < 1e-12


def test_awkward_rows(awkward, no_docs):
    profiles = langid.learn(awkward)
    rows = langid.identify(awkward, profiles).collect()
    assert len(rows) == awkward.count()
    by_id = {r["doc_id"]: r for r in rows}
    for i in (1, 2, 3, 4):
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    assert by_id[5]["lang_pred"] == "en" and by_id[None]["lang_pred"] == "es"
    assert langid.identify(no_docs, profiles).collect() == []
    blank = langid.learn(no_docs)
    assert {r["lang_pred"] for r in langid.identify(awkward, blank).collect()} == {"und"}
