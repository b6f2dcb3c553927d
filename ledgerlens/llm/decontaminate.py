"""Benchmark decontamination by a prefix-filtered join of word shingles.

A window is ``window`` consecutive words of a benchmark item (the whole item if it has fewer). For
full containment the necessary prefix of a window is its single rarest shingle, so only that one is
indexed: shingles are counted over all documents, each window is filed under its rarest shingle,
documents look their shingles up, the length and position of the window must fit the document, and
the remaining candidates are compared word by word.

The benchmark is read in blocks of bounded size. Each block is shipped to the tasks; a benchmark of
any size is handled by further passes over the documents, whose hits are merged per document."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import text as tx

WINDOW = 10
SHINGLE = 5
BLOCK_WORDS = 2_000_000  # words of one shipped block: about 16 MB of hashes
_FILTER_BITS = 20


@dataclass
class Lookup:
    """Sorted keys behind a small bit table, so that most misses cost one load."""

    keys: np.ndarray

    def __post_init__(self):
        bits = max(_FILTER_BITS, min(26, int(len(self.keys)).bit_length() + 4))
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, dtype=bool)
        self.table[(self.keys >> self.shift).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``hashes`` that are keys, and which key each is."""
        maybe = np.flatnonzero(self.table[(hashes >> self.shift).astype(np.int64)])
        if not len(maybe) or not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.searchsorted(self.keys, hashes[maybe])
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == hashes[maybe]
        return maybe[hit], at[hit]


@dataclass
class Block:
    """Windows of some benchmark items, by distinct content."""

    ids: list[str | None]  # item id of each item of the block
    words: np.ndarray  # word hashes of the distinct windows, one after the other
    begin: np.ndarray  # first word of each window
    length: np.ndarray
    owner_first: np.ndarray  # items of window w: owners[owner_first[w] : owner_first[w + 1]]
    owners: np.ndarray


def build_block(rows: list[tuple[str | None, str]], window: int) -> Block:
    words = tx.split_words(*tx.text_of(t for _, t in rows), tx.NON_WORD)
    begin, length, owner, key = [], [], [], []
    for item in range(len(rows)):
        a, b = int(words.first[item]), int(words.first[item + 1])
        if a == b:
            continue
        size = min(window, b - a)
        starts = np.arange(a, b - size + 1)
        begin.append(starts)
        length.append(np.full(len(starts), size))
        owner.append(np.full(len(starts), item))
        key.append(tx.gram_hash(words.hash[a:b], size))
    if not begin:
        none = np.zeros(0, np.int64)
        return Block([r[0] for r in rows], np.zeros(0, np.uint64), none, none, np.zeros(1, np.int64), none)
    begin, length, owner, key = map(np.concatenate, (begin, length, owner, key))
    _, one, which = np.unique(key, return_index=True, return_inverse=True)
    order = np.argsort(which, kind="stable")
    owner_first = np.concatenate([[0], np.cumsum(np.bincount(which))])
    return Block([r[0] for r in rows], words.hash, begin[one], length[one], owner_first, owner[order])


def blocks(benchmark: DataFrame, item_id: str, text: str, window: int, limit: int) -> Iterator[Block]:
    """Blocks of at most ``limit`` words (a longer item is a block of its own), one at a time."""
    rows, size = [], 0
    items = benchmark.select(F.col(item_id).cast("string"), F.coalesce(F.col(text).cast("string"), F.lit("")))
    for row in items.toLocalIterator():
        words = len(row[1]) // 2 + 1
        if rows and size + words > limit:
            yield build_block(rows, window)
            rows, size = [], 0
        rows.append((row[0], row[1]))
        size += words
    yield build_block(rows, window)


def _shingles(block: Block, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(window, offset, width, hash) of every shingle of every window."""
    out = []
    for size in np.unique(block.length):
        width = min(shingle, int(size))
        hashed = tx.gram_hash(block.words, width)
        which = np.flatnonzero(block.length == size)
        for offset in range(int(size) - width + 1):
            h = hashed[block.begin[which] + offset]
            out.append((which, np.full(len(which), offset), np.full(len(which), width), h))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    return tuple(map(np.concatenate, zip(*out, strict=True)))


def _document_shingles(words: tx.Words, widths: list[int], lookup: Lookup):
    """(position, key) of document shingles that are keys, none across a document's end."""
    room = words.room()
    for width in widths:
        at, key = lookup.find(tx.gram_hash(words.hash, width))
        fits = room[at] >= width
        yield at[fits], key[fits]


def count_shingles(docs: DataFrame, text: str, keys: np.ndarray, widths: list[int]) -> np.ndarray:
    """How often each key occurs in all documents: bounded counts, summed on Spark."""
    lookup = docs.sparkSession.sparkContext.broadcast(Lookup(keys))
    size = len(keys)

    def run(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for _, _, data, offsets in tx.slices(batch.column(0)):
                words = tx.split_words(data, offsets, tx.NON_WORD)
                for _, key in _document_shingles(words, widths, lookup.value):
                    total += np.bincount(key, minlength=size)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["k", "n"])

    counted = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(run, "k long, n long")
    out = np.zeros(size, dtype=np.int64)
    for row in counted.groupBy("k").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row["k"]] = row["n"]
    return out


@dataclass
class Index:
    """Each window under its rarest shingle."""

    lookup: Lookup
    widths: list[int]
    first: np.ndarray  # windows of key k: entries first[k] .. first[k + 1]
    window: np.ndarray
    offset: np.ndarray
    block: Block


def build_index(docs: DataFrame, text: str, block: Block, shingle: int) -> Index:
    window, offset, width, hashed = _shingles(block, shingle)
    widths = [int(w) for w in np.unique(width)]
    keys = np.unique(hashed)
    counts = count_shingles(docs, text, keys, widths) if len(keys) else np.zeros(0, np.int64)
    rarity = counts[np.searchsorted(keys, hashed)]
    order = np.lexsort((offset, hashed, rarity, window))
    _, lead = np.unique(window[order], return_index=True)
    chosen = order[lead]
    chosen = chosen[np.argsort(hashed[chosen], kind="stable")]
    used, first = np.unique(hashed[chosen], return_index=True)
    first = np.append(first, len(chosen))
    return Index(Lookup(used), widths, first, window[chosen], offset[chosen], block)


def _hits(words: tx.Words, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of every occurrence of a window in the slice."""
    block, room = index.block, words.room()
    left = np.arange(len(words.hash)) - np.repeat(words.first[:-1], words.counts)
    starts, windows = [], []
    for at, key in _document_shingles(words, index.widths, index.lookup):
        many = index.first[key + 1] - index.first[key]
        at = np.repeat(at, many)
        entry = np.repeat(index.first[key], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        window, offset = index.window[entry], index.offset[entry]
        begin = at - offset
        fits = left[at] >= offset
        fits[fits] = room[begin[fits]] >= block.length[window[fits]]
        begin, window = begin[fits], window[fits]
        same = np.ones(len(begin), dtype=bool)
        for k in range(int(block.length.max(initial=0))):
            live = np.flatnonzero(same & (block.length[window] > k))
            same[live] = words.hash[begin[live] + k] == block.words[block.begin[window[live]] + k]
        starts.append(begin[same])
        windows.append(window[same])
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts), np.concatenate(windows)


_ADDED = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("hit_spans", T.ArrayType(T.LongType())),
    ]
)


def _pass(docs: DataFrame, keep: list[str], text: str, index: Index) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast(index)

    def work(data, offsets):
        index = shipped.value
        words = tx.split_words(data, offsets, tx.NON_WORD)
        begin, window = _hits(words, index)
        size = len(words.hash)
        step = np.zeros(size + 1, dtype=np.int64)
        np.add.at(step, begin, 1)
        np.add.at(step, begin + index.block.length[window], -1)
        covered = np.cumsum(step[:-1]) > 0
        total = np.concatenate([[0], np.cumsum(covered)])
        docs_hit = np.searchsorted(words.first, begin, side="right") - 1
        items: list[list[str]] = [[]] * (len(offsets) - 1)
        spans: list[list[int]] = [[]] * (len(offsets) - 1)
        for d in np.unique(docs_hit):
            mine = np.unique(window[docs_hit == d])
            owners = {o for w in mine for o in index.block.owners[index.block.owner_first[w] : index.block.owner_first[w + 1]]}
            items[d] = sorted({i for o in owners if (i := index.block.ids[o]) is not None})
            a, b = words.first[d], words.first[d + 1]
            edges = np.flatnonzero(np.diff(np.concatenate([[0], covered[a:b].astype(np.int8), [0]])))
            spans[d] = edges.tolist()
        return {
            "n_words": words.counts.astype(np.int64),
            "n_hit": total[words.first[1:]] - total[words.first[:-1]],
            "items": pa.array(items, pa.list_(pa.string())),
            "hit_spans": pa.array(spans, pa.list_(pa.int64())),
        }

    return tx.map_texts(docs, keep, _ADDED, work, text)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str] | None = None,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document row: the ``keep`` columns (all by default) and ``n_words``, ``n_hit``,
    ``items`` (sorted distinct ids as strings), ``hit_spans`` (start, end word pairs, merged).

    Null or word-less texts have no words and no hits; a null or word-less item has no windows; an
    item without id covers words but is not listed; items with one id count once; repeated
    document rows each get their own row; texts of any length are read whole; a column named like
    an added one is replaced; empty tables give no hits or no rows."""
    keep = docs.columns if keep is None else keep
    following = blocks(benchmark, item_id, item_text, window, block_words)
    block, out = next(following), None
    while block is not None:
        later = next(following, None)
        index = build_index(docs, text, block, shingle)
        # A further pass needs the text again.
        wanted = keep if later is None or text in keep else [*keep, text]
        if out is None:
            out = _pass(docs, wanted, text, index)
        else:
            out = _further(out, wanted, text, index)
        block = later
    return out


def _further(out: DataFrame, keep: list[str], text: str, index: Index) -> DataFrame:
    """A further block: its items and spans are added to what the row already has."""
    earlier = out.withColumnsRenamed({"items": "__items", "hit_spans": "__spans"})
    return (
        _pass(earlier, [*keep, "__items", "__spans"], text, index)
        .withColumn("items", F.array_sort(F.array_union("items", "__items")))
        .withColumn("hit_spans", _union_spans(F.col("hit_spans"), F.col("__spans")))
        .withColumn("n_hit", _span_words(F.col("hit_spans")))
        .drop("__items", "__spans")
    )


def _pairs(spans):
    return F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(spans) - 2), F.lit(2)),
        lambda i: F.struct(F.get(spans, i.cast("int")).alias("a"), F.get(spans, (i + 1).cast("int")).alias("b")),
    )


def _union_spans(left, right):
    pairs = F.array_sort(F.filter(F.concat(_pairs(left), _pairs(right)), lambda p: p["a"].isNotNull()))
    start = F.expr("cast(array() as array<bigint>)")

    def add(done, pair):
        last = F.element_at(done, -1)
        return (
            F.when(F.size(done) == 0, F.array(pair["a"], pair["b"]))
            .when(pair["a"] > last, F.concat(done, F.array(pair["a"], pair["b"])))
            .otherwise(F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.greatest(last, pair["b"]))))
        )

    return F.aggregate(pairs, start, add)


def _span_words(spans):
    return F.aggregate(_pairs(spans), F.lit(0).cast("long"), lambda n, p: n + F.coalesce(p["b"] - p["a"], F.lit(0)))
