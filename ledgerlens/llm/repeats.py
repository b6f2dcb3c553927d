"""Substring dedup: words of passages that a document with a smaller id has too are removed.

The reference of a document is all documents with smaller ids, in shards; a suffix automaton of a
shard gives the matching statistics of the passages streamed through it, the length of the longest
match that ends at each word, and matches of ``window`` words or more are removed.

An automaton of the whole corpus fits nowhere, and every document against every shard would be the
square of the corpus. So shards follow content: a window is filed under the least hash of its short
grams, its anchor, which depends on the window's words alone. Windows in a row with one anchor make a
passage of at most ``2 * window - 5`` words, and equal windows have equal anchors, so a passage meets
every equal window in the shard of its anchor.

1. Documents are packed into chunks. Each chunk asks the counting shards of its distinct anchors
   which of them another document has, too.
2. It sends its distinct passages under those, each with the smallest id that holds it, to the
   shards of their anchors. A shard adds passages to its automaton by ascending id, after streaming
   them through it, and answers which windows a smaller id has. An anchor in front of very many
   different passages is refined: its windows travel one by one, filed under their own hash.
3. Each chunk reads its answers back and cuts its texts.

A chunk sends a passage once however often it holds it, so copies do not load a shard."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import text as tx
from ledgerlens.llm.packed import pack, rows, unpack
from ledgerlens.session import new_folder

WINDOW = 13
ANCHOR = 5
CHUNK_BYTES = 4_000_000
SHARD_ANCHORS = 400_000
SHARD_PASSAGES = 50_000
CROWDED = 2_000  # passages of an anchor, as chunks count them, from which its windows travel one by one
_CODE = 5  # bytes of a word's hash; windows are equal where all their words' are
_ALONE, _SHARED, _CROWDED = 0, 1, 2


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


_CHUNKS = "chunk long, ids array<bigint>, lengths binary, body binary, n_words long"


def _chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at, to, data, offsets in tx.slices(batch.column(1), chunk_bytes):
                lengths = np.diff(offsets)
                body = len(data).to_bytes(8, "little") + pa.Codec("zstd").compress(data.tobytes(), asbytes=True)
                n_words = int(np.count_nonzero(np.diff(tx.SPACES[data].astype(np.int8)))) // 2 + to - at
                row = [
                    pa.array([number], pa.int64()),
                    pa.array([batch.column(0).slice(at, to - at)], pa.list_(pa.int64())),
                    pa.array([pack(lengths)], pa.binary()),
                    pa.array([body], pa.binary()),
                    pa.array([n_words], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(row, names=["chunk", "ids", "lengths", "body", "n_words"])
                number += 1

    return docs.mapInArrow(run, _CHUNKS)


@dataclass
class Chunk:
    """Words of a chunk's documents and its passages: first and last window (by first word), anchor
    and document of each."""

    data: np.ndarray
    offsets: np.ndarray
    ids: pa.Array
    words: tx.Words
    window_hash: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    doc: np.ndarray  # id of the passage's document


def read_chunk(row: dict, window: int) -> Chunk:
    size = int.from_bytes(row["body"][:8], "little")
    body = pa.Codec("zstd").decompress(row["body"][8:], decompressed_size=size, asbytes=True)
    data = np.frombuffer(body, np.uint8)
    offsets = np.concatenate([[0], np.cumsum(unpack(row["lengths"]).astype(np.int64))])
    ids = pa.array(row["ids"], pa.int64())
    words = tx.split_words(data, offsets, tx.SPACES, lower=False)
    anchor = min(ANCHOR, window)
    grams, windows = tx.gram_hash(words.hash, anchor), tx.gram_hash(words.hash, window)
    known = np.asarray(ids.is_valid())
    owner = words.doc_of_word()[: len(windows)]
    # Documents without id take no part.
    start = np.flatnonzero((words.room()[: len(windows)] >= window) & known[owner])
    least, place = grams[start], start.copy()
    for k in range(1, window - anchor + 1):
        other = grams[start + k]
        less = other < least
        least[less] = other[less]
        place[less] = start[less] + k
    edge = np.ones(len(start), bool)
    edge[1:] = (np.diff(start) != 1) | (np.diff(place) != 0) | (np.diff(owner[start]) != 0)
    begin = np.flatnonzero(edge)
    end = np.append(begin[1:], len(start)) - 1 if len(begin) else begin
    doc = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)[owner[start[begin]]]
    return Chunk(data, offsets, ids, words, windows, start[begin], start[end], least[begin], doc)


@dataclass
class Passages:
    """Distinct passages of a chunk in order of their hash, and which one each place holds."""

    start: np.ndarray  # a place of each
    size: np.ndarray  # its words
    route: np.ndarray
    owner: np.ndarray  # smallest id of the chunk that holds it
    which: np.ndarray  # passage of each place
    place: np.ndarray  # first window of each place
    windows: np.ndarray  # windows of each place
    doc: np.ndarray  # id of each place


def _distinct(chunk: Chunk, first: np.ndarray, last: np.ndarray, route: np.ndarray, doc: np.ndarray, window: int) -> Passages:
    # The first and the last window hold every word of a passage.
    many = last - first + 1
    mixed = chunk.window_hash[first] * np.uint64(0x9E3779B97F4A7C15) + chunk.window_hash[last]
    key = tx.mix(mixed + many.astype(np.uint64)) ^ route
    order = np.lexsort((doc, key))
    _, lead, which = np.unique(key[order], return_index=True, return_inverse=True)
    back = np.empty(len(order), np.int64)
    back[order] = which
    one = order[lead]
    return Passages(first[one], many[one] + window - 1, route[one], doc[one], back, first, many, doc)


def _anchors(chunk: Chunk, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct anchors in order, different passages of each, and whether two documents hold it."""
    found = _distinct(chunk, chunk.first, chunk.last, chunk.anchor, chunk.doc, window)
    keys, which = np.unique(chunk.anchor, return_inverse=True)
    passages = np.bincount(np.searchsorted(keys, found.route), minlength=len(keys))
    low, high = np.full(len(keys), np.iinfo(np.int64).max), np.full(len(keys), np.iinfo(np.int64).min)
    np.minimum.at(low, which, chunk.doc)
    np.maximum.at(high, which, chunk.doc)
    return keys, passages, low < high


def wanted(chunk: Chunk, level: np.ndarray, window: int) -> Passages:
    """The passages under anchors that other documents have, by window under crowded ones."""
    keys, which = np.unique(chunk.anchor, return_inverse=True)
    level = level[which]
    shared, crowded = np.flatnonzero(level == _SHARED), np.flatnonzero(level == _CROWDED)
    many = chunk.last[crowded] - chunk.first[crowded] + 1
    single = np.repeat(chunk.first[crowded], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    first = np.concatenate([chunk.first[shared], single])
    last = np.concatenate([chunk.last[shared], single])
    route = np.concatenate([chunk.anchor[shared], chunk.window_hash[single]])
    return _distinct(chunk, first, last, route, np.concatenate([chunk.doc[shared], np.repeat(chunk.doc[crowded], many)]), window)


def _dealt(route: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys by shard, and where each shard's begin."""
    shard = (tx.mix(route) % np.uint64(shards)).astype(np.int64)
    return np.argsort(shard, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=shards))])


def _to_shards(row: dict, first: np.ndarray, columns: list, names: list[str]):
    """Batches of (shard, chunk, one binary per column) for the shards that are asked something."""
    used = np.flatnonzero(np.diff(first))
    for at in range(0, len(used), 64):
        some = used[at : at + 64]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some.astype(np.int32)),
                pa.array([row["chunk"]] * len(some), pa.int64()),
                *(pa.array([c(first[s], first[s + 1]) for s in some], pa.binary()) for c in columns),
            ],
            names=["shard", "chunk", *names],
        )


def _restored(answers: list[dict] | None, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.zeros(len(order), np.int64)
    for a in answers or []:
        out[order[first[a["shard"]] : first[a["shard"] + 1]]] = unpack(a["answer"])
    return out


def _low_bytes(values: np.ndarray, width: int) -> np.ndarray:
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]


def _wide(raw: bytes, width: int) -> np.ndarray:
    narrow = np.frombuffer(raw, np.uint8).reshape(-1, width)
    out = np.zeros((len(narrow), 8), np.uint8)
    out[:, :width] = narrow
    return out.view("<u8").ravel()


def _anchor_levels(chunks: DataFrame, shards: int, window: int, crowded: int) -> DataFrame:
    """(chunk, shard, answer, n): level of each anchor a chunk asked a shard about, and how many of
    the passages it counted are under shared ones."""

    def ask(batches):
        for row in rows(batches):
            chunk = read_chunk(row, window)
            keys, passages, several = _anchors(chunk, window)
            order, first = _dealt(keys, shards)
            # Anchors that fall together in four bytes are looked at in vain, no more.
            raw, told = _low_bytes(keys[order], 4), (passages * 2 + several)[order]
            yield from _to_shards(row, first, [lambda a, b: raw[a:b].tobytes(), lambda a, b: pack(told[a:b])], ["keys", "told"])

    def answer(table: pa.Table) -> pa.Table:
        keys = [_wide(k.as_buffer(), 4) for k in table.column("keys")]
        told = [unpack(t.as_py()) for t in table.column("told")]
        ends = np.cumsum([len(k) for k in keys])
        _, which = np.unique(np.concatenate(keys), return_inverse=True)
        told = np.concatenate(told).astype(np.int64)
        passages = np.bincount(which, told // 2)
        shared = (np.bincount(which) > 1) | (np.bincount(which, told % 2) > 0)
        level = np.where(shared, np.where(passages > crowded, _CROWDED, _SHARED), _ALONE)[which]
        n = np.where(level > 0, told // 2, 0)
        spans = [slice(e - len(k), e) for k, e in zip(keys, ends)]
        return pa.table(
            {
                "chunk": table.column("chunk"),
                "shard": table.column("shard"),
                "answer": pa.array([pack(level[s]) for s in spans], pa.binary()),
                "n": pa.array([int(n[s].sum()) for s in spans], pa.int64()),
            }
        )

    asked = chunks.mapInArrow(ask, "shard int, chunk long, keys binary, told binary")
    return _saved(asked.groupBy("shard").applyInArrow(answer, "chunk long, shard int, answer binary, n long"), "anchors")


class Automaton:
    """Suffix automaton of the passages added so far."""

    def __init__(self):
        self.step: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.size = [0]

    def _state(self, size: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.size.append(size)
        return len(self.size) - 1

    def _via(self, state: int, token: int) -> int:
        """Where ``token`` leads from ``state``, parted from longer strings that share the target."""
        to = self.step[state][token]
        if self.size[to] == self.size[state] + 1:
            return to
        own = self._state(self.size[state] + 1, dict(self.step[to]), self.link[to])
        self.link[to] = own
        while state >= 0 and self.step[state].get(token) == to:
            self.step[state][token] = own
            state = self.link[state]
        return own

    def add(self, tokens: list[int]) -> None:
        at = 0
        for token in tokens:
            if token in self.step[at]:
                at = self._via(at, token)
                continue
            new, up = self._state(self.size[at] + 1, {}, 0), at
            while up >= 0 and token not in self.step[up]:
                self.step[up][token] = new
                up = self.link[up]
            if up >= 0:
                self.link[new] = self._via(up, token)
            at = new

    def statistics(self, tokens: list[int]) -> list[int]:
        """Length of the longest match that ends at each token."""
        at = length = 0
        out = []
        for token in tokens:
            while at and token not in self.step[at]:
                at = self.link[at]
                length = self.size[at]
            if token in self.step[at]:
                at = self.step[at][token]
                length += 1
            out.append(length)
        return out


def covered(passages: list[tuple[int, list[int]]], window: int) -> list[int]:
    """For each (id, tokens), by ascending id: the windows that a smaller id holds, as bits."""
    automaton, out, waiting, now = Automaton(), [], [], None
    for doc, tokens in passages:
        if doc != now:
            for earlier in waiting:
                automaton.add(earlier)
            now, waiting = doc, []
        lengths = automaton.statistics(tokens)
        out.append(sum(1 << k for k, n in enumerate(lengths[window - 1 :]) if n >= window))
        # What is matched as a whole is in the automaton already.
        if lengths[-1] < len(tokens):
            waiting.append(tokens)
    return out


def _windows_met(chunks: DataFrame, levels: DataFrame, shards1: int, shards2: int, window: int) -> DataFrame:
    """(chunk, shard, answer): for each passage sent, its windows that a smaller id holds."""

    def ask(batches):
        for row in rows(batches):
            chunk = read_chunk(row, window)
            found = wanted(chunk, _levels(chunk, row, shards1), window)
            order, first = _dealt(found.route, shards2)
            start, size = found.start[order], found.size[order]
            ends = np.concatenate([[0], np.cumsum(size)])
            at = np.repeat(start, size) + np.arange(ends[-1]) - np.repeat(ends[:-1], size)
            codes = _low_bytes(chunk.words.hash[at], _CODE)
            routes = _low_bytes(tx.mix(found.route[order]), 4)
            owner = found.owner[order].view(np.uint64)
            yield from _to_shards(
                row,
                first,
                [
                    lambda a, b: routes[a:b].tobytes(),
                    lambda a, b: pack(size[a:b]),
                    lambda a, b: pack(owner[a:b]),
                    lambda a, b: codes[ends[a] : ends[b]].tobytes(),
                ],
                ["routes", "sizes", "owners", "codes"],
            )

    def answer(table: pa.Table) -> pa.Table:
        routes = [_wide(x.as_buffer(), 4) for x in table.column("routes")]
        counts = np.array([len(r) for r in routes])
        route = np.concatenate(routes)
        size, owner = (np.concatenate([unpack(x.as_py()).astype(np.uint64) for x in table.column(c)]) for c in ("sizes", "owners"))
        size, owner = size.astype(np.int64), owner.view(np.int64)
        codes = np.concatenate([_wide(x.as_buffer(), _CODE) for x in table.column("codes")])
        bits = shard_answers(route, size, owner, codes, window)
        ends = np.cumsum(counts)
        return pa.table(
            {
                "chunk": table.column("chunk"),
                "shard": table.column("shard"),
                "answer": pa.array([pack(bits[e - c : e]) for c, e in zip(counts, ends)], pa.binary()),
            }
        )

    joined = chunks.join(_by_chunk(levels, "levels"), "chunk")
    asked = joined.mapInArrow(ask, "shard int, chunk long, routes binary, sizes binary, owners binary, codes binary")
    return _saved(asked.groupBy("shard").applyInArrow(answer, "chunk long, shard int, answer binary"), "windows")


def shard_answers(route: np.ndarray, size: np.ndarray, owner: np.ndarray, codes: np.ndarray, window: int) -> np.ndarray:
    """Bits of the windows that a smaller id holds, for each passage asked about."""
    begin = np.cumsum(size) - size
    key = tx.mix(route + size.astype(np.uint64))
    for k in range(int(size.max(initial=0))):
        live = np.flatnonzero(size > k)
        key[live] = tx.mix(key[live] * np.uint64(0x9E3779B97F4A7C15) + codes[begin[live] + k])
    # Equal passages of one route together, the smallest id first.
    order = np.lexsort((owner, key, route))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(key[order]) != 0) | (np.diff(route[order]) != 0)
    lead = order[new]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    bits = np.zeros(len(lead), np.int64)
    by_route = np.lexsort((owner[lead], route[lead]))
    border = np.flatnonzero(np.concatenate([[True], np.diff(route[lead][by_route]) != 0, [True]])) if len(lead) else []
    for a, b in zip(border[:-1], border[1:]):
        # A passage without another in its shard has nothing to match.
        if b - a > 1:
            group = by_route[a:b]
            some = [(int(owner[i]), codes[begin[i] : begin[i] + size[i]].tolist()) for i in lead[group]]
            bits[group] = covered(some, window)
    whole = (np.int64(1) << (size - window + 1)) - 1
    return np.where(owner > owner[lead][which], whole, bits[which])


def _by_chunk(answers: DataFrame, name: str) -> DataFrame:
    return answers.groupBy("chunk").agg(F.collect_list(F.struct("shard", "answer")).alias(name))


def _levels(chunk: Chunk, row: dict, shards: int) -> np.ndarray:
    keys = np.unique(chunk.anchor)
    return _restored(row["levels"], *_dealt(keys, shards))


def removed_words(chunk: Chunk, found: Passages, bits: np.ndarray, window: int) -> np.ndarray:
    """Which words of a chunk go, from what the shards answered about its passages."""
    whole = (np.int64(1) << found.windows) - 1
    mine = np.where(found.doc > found.owner[found.which], whole, bits[found.which])
    step = np.zeros(len(chunk.words.hash) + 1, np.int64)
    for k in range(int(found.windows.max(initial=0))):
        start = found.place[(mine >> k) & 1 == 1] + k
        np.add.at(step, start, 1)
        np.add.at(step, start + window, -1)
    return np.cumsum(step[:-1]) > 0


def _kept(chunk: Chunk, gone: np.ndarray) -> pa.Array:
    """Words that stay, joined by one space, of each document."""
    words = chunk.words
    stay = np.flatnonzero(~gone)
    doc = np.searchsorted(words.first, stay, side="right") - 1
    followed = np.append(doc[1:] == doc[:-1], [False]) if len(stay) else np.zeros(0, bool)
    data = chunk.data.copy()
    step = np.zeros(len(data) + 2, np.int32)
    # A word that another one follows is not the last of its document, so a space stands behind it.
    data[words.end[stay[followed]]] = 32
    np.add.at(step, words.start[stay], 1)
    np.add.at(step, words.end[stay] + followed, -1)
    mask = np.cumsum(step[: len(data)]) > 0
    total = np.concatenate([[0], np.cumsum(mask)])
    ends = total[chunk.offsets].astype(np.int32)
    out = data[mask]
    return pa.Array.from_buffers(pa.string(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(out)])


def _spans(words: tx.Words, gone: np.ndarray) -> pa.Array:
    edges = np.zeros(len(gone) + 1, bool)
    edges[1:-1] = gone[1:] != gone[:-1]
    border = np.zeros(len(gone) + 1, bool)
    border[words.first] = True
    before, after = np.append([False], gone), np.append(gone, [False])
    start, end = np.flatnonzero(after & (edges | border)), np.flatnonzero(before & (edges | border))
    doc = np.searchsorted(words.first, start, side="right") - 1
    flat = np.stack([start, end], axis=1) - words.first[doc][:, None]
    ends = 2 * np.searchsorted(doc, np.arange(len(words.first)))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.ravel(), pa.int64()))


def remove_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    chunk_bytes: int = CHUNK_BYTES,
    shard_anchors: int = SHARD_ANCHORS,
    shard_passages: int = SHARD_PASSAGES,
    crowded: int = CROWDED,
) -> DataFrame:
    """One row per document row: its id, ``n_words``, ``n_removed``, ``kept_text`` (the words that
    stay, joined by one space) and ``removed_spans`` (start, end word pairs).

    Words are runs of bytes other than white space, unchanged. A word goes if a window of ``window``
    words that covers it starts in a document with a smaller id, too; windows are those of the input,
    not of what is left. What repeats inside one document, or in documents of one id, stays. Null and
    word-less texts have no words; texts shorter than a window lose none; rows without id are neither
    cut nor searched. Repeated rows each get their own row. Ids are whole numbers, ``window`` at most
    40. Memory follows the chunk, or the longest text. Other columns are not read; empty tables give
    no rows."""
    if not 1 <= window <= 40:
        raise ValueError(f"window of {window} words")
    source = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    chunks = _saved(_chunks(source, chunk_bytes), "repeat-chunks")
    n_words = chunks.agg(F.sum("n_words")).first()[0] or 0
    # One anchor in about half as many words as a window has anchors to choose from.
    shards1 = max(1, -(-2 * n_words // (max(1, window - ANCHOR) * shard_anchors)))
    levels = _anchor_levels(chunks, shards1, window, crowded)
    passages = levels.agg(F.sum("n")).first()[0] or 0
    shards2 = max(1, -(-passages // shard_passages))
    met = _windows_met(chunks, levels, shards1, shards2, window)

    def run(batches):
        for row in rows(batches):
            chunk = read_chunk(row, window)
            found = wanted(chunk, _levels(chunk, row, shards1), window)
            bits = _restored(row["met"], *_dealt(found.route, shards2))
            gone = removed_words(chunk, found, bits, window)
            total = np.concatenate([[0], np.cumsum(gone)])
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.ids,
                    pa.array(chunk.words.counts.astype(np.int64)),
                    pa.array(total[chunk.words.first[1:]] - total[chunk.words.first[:-1]]),
                    _kept(chunk, gone),
                    _spans(chunk.words, gone),
                ],
                names=[doc_id, "n_words", "n_removed", "kept_text", "removed_spans"],
            )

    answered = [_by_chunk(levels, "levels"), _by_chunk(met, "met")]
    joined = reduce(lambda left, right: left.join(right, "chunk", "left"), answered, chunks)
    return joined.mapInArrow(run, f"`{doc_id}` long, n_words long, n_removed long, kept_text string, removed_spans array<bigint>")
