from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import turns

COLUMNS = ["conv_id", *turns.COUNTS, "audit", "repaired_sha256"]
BEGUN, DONE = re.compile(r"s?(ua)*u?"), re.compile(r"(s?(ua)+)?")
FILLS = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]


def plain_faults(rows):
    """(role, text, fault) of (turn, role, text) rows in order."""
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(turns.SPACES)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def plain_repair(rows):
    """(cost, audit, lines) by trying every edit."""
    best = None

    def go(i, cost, audit, lines):
        nonlocal best
        if not BEGUN.fullmatch("".join(role[:1] or "?" for role, _ in lines)) or best and cost > best[0]:
            return
        if i == len(rows):
            if DONE.fullmatch("".join(role[:1] for role, _ in lines)):
                best = min(best or (cost, audit, lines), (cost, audit, lines))
            return
        role, text, fault = rows[i]
        edits = [(4, "D", [])]
        if fault not in ("blank", "duplicate"):
            more = 3 if fault else 0
            edits += [(more, "K", [(role, text)])] + [(3 + more, "R", [(r, text)]) for r in ("user", "assistant")]
        for extra, letter, line in edits:
            for fill in FILLS:
                go(i + 1, cost + extra + 3 * len(fill), audit + letter + "I" * len(fill), lines + line + [(r, "") for r in fill])

    for fill in FILLS:
        go(0, 3 * len(fill), "I" * len(fill), [(r, "") for r in fill])
    return best


def ordered(rows):
    fill = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(fill, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), hashlib.sha256(x[2].encode()).hexdigest()))


def expected(conv, rows):
    rows = ordered(rows)
    faults = plain_faults(rows)
    cost, audit, lines = plain_repair(faults)
    at = [t for t, _, _ in rows if t is not None]
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(faults, faults[1:])]
    counts = [sum(f[2] == k for f in faults) for k in ("blank", "duplicate", "truncated")]
    digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in lines).encode()).hexdigest()
    return (conv, max(at) - min(at) + 1 - len(set(at)) if at else 0, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)


ROWS = st.lists(st.tuples(st.sampled_from("suat"), st.booleans(), st.booleans()), max_size=4)


@settings(max_examples=80, deadline=None)
@given(ROWS)
def test_parser_against_every_edit(rows):
    repair = turns.Repair(turns.Parser())
    for initial, doomed, cut in rows:
        repair.add(initial, doomed, cut and not doomed)
    faults = [(i, "x", "blank" if d else "truncated" if c else "") for i, d, c in rows]
    assert repair.best() == plain_repair(faults)[:2]


def test_stack_tops_stay_few_and_shared_parts_change_nothing(monkeypatch):
    rng = random.Random(5)
    for letters in ("suat", "t", "ua", "s"):
        rows = [(rng.choice(letters), rng.random() < 0.1, rng.random() < 0.2) for _ in range(400)]
        found = []
        for size in (8, 10_000):
            monkeypatch.setattr(turns, "_TAIL", size)
            repair = turns.Repair(turns.Parser())
            for initial, doomed, cut in rows:
                repair.add(initial, doomed, cut and not doomed)
                assert len(repair.tops) <= 4
            found.append(repair.best())
        assert found[0] == found[1]


def conversations():
    rng = random.Random(11)
    texts = ["Yes.", "No!", "Why?", "cut off", "  ", "", None, "Yes. \n", "a\x0bb."]
    roles = ["user", "assistant", "system", "tool", None, ""]
    out = []
    for conv in [*range(40), None]:
        for turn in range(rng.randint(1, 4)):
            out.append((conv, rng.choice([turn, turn, turn, None, 2]), rng.choice(roles[:2] + roles), rng.choice(texts)))
    return out


def test_every_conversation_against_every_edit(spark):
    rows = conversations()
    rows += rows[:5]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    by_conv = {}
    for conv, *rest in rows:
        by_conv.setdefault(conv, []).append(tuple(rest))
    want = {conv: expected(conv, some) for conv, some in by_conv.items() if len(some) <= 5}
    clash = messages.selectExpr("*", "'x' AS here", "1 AS seen", "'y' AS digest", "2 AS position", "'z' AS audit")
    for source in (messages, clash.repartition(7)):
        found = {r["conv_id"]: tuple(r) for r in turns.repair_digests(source).select(*COLUMNS).collect()}
        assert set(found) == set(by_conv)
        assert {c: found[c] for c in want} == want


def test_repaired_rows_are_sentences(spark):
    messages = spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string")
    audited = turns.audits(messages)
    fixed = turns.repaired(messages, audited).collect()
    audit = {r["conv_id"]: r["audit"] for r in audited.collect()}
    for conv in audit:
        mine = sorted((r for r in fixed if r["conv_id"] == conv), key=lambda r: r["position"])
        assert DONE.fullmatch("".join(r["role"][:1] for r in mine))
        assert "".join(r["edit"] for r in mine) == audit[conv].replace("D", "")
        assert all((r["turn"] is None and r["text"] == "") for r in mine if r["edit"] == "I")


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(30) for t in range(5)] + [(None, None, None, None)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = turns.damaged(messages).collect()
    want = []
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        want += [(c, t, "user" if fault == 4 else role, text, fault != 0)] * (2 if fault == 3 else 1)
    key = lambda r: str(tuple(r))
    assert sorted((tuple(r) for r in done), key=key) == sorted(want, key=key)


def test_conversations_without_rows_and_empty_tables(spark):
    messages = spark.createDataFrame([(1, 0, "user", "Hm.", False)], "conv_id long, turn long, role string, text string, here boolean")
    rows = turns.repair_digests(messages, here="here").select(*COLUMNS).collect()
    assert [tuple(r) for r in rows] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    assert turns.repair_digests(messages.limit(0), here="here").collect() == []


def test_one_long_conversation(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}. " + "long " * (200_000 if t == 7 else 1) + ".") for t in range(12_001)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = turns.repair_digests(messages).first()
    assert found["audit"] == "K" * 12_001 + "I" and found["cost"] == 3 and found["gaps"] == 0
    lines = "\n".join(f"{r}:{x}" for _, _, r, x in rows) + "\nassistant:"
    assert found["repaired_sha256"] == hashlib.sha256(lines.encode()).hexdigest()


@pytest.mark.parametrize("grammar", [(("Talk", ""), ("Talk", ("Talk", "u"))), turns.GRAMMAR])
def test_automaton_accepts_its_language(grammar):
    parser = turns.Parser(grammar)
    pattern = re.compile("u*" if len(grammar) == 2 else "(s?(ua)+)?")
    for k in range(3**5):
        word = "".join("sua"[k // 3**i % 3] for i in range(5))[: k % 6]
        tops = [parser.bottom]
        for letter in word:
            tops = [to for top in tops for to in parser.moves(top, letter)]
        assert any(parser.accepts(t) for t in tops) == bool(pattern.fullmatch(word))
