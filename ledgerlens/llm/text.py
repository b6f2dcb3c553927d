"""Vectorised splitting and hashing of whole texts inside Arrow tasks.

Texts are handled as UTF-8 bytes in slices of a few megabytes cut at document borders, so memory
follows the slice or the longest single document, not the partition. Both word classes used here
keep every byte above 0x7F inside a word, so working on bytes gives exactly the words that the
code-point patterns give."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

SLICE_BYTES = 2_000_000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Bytes outside [^\x20\x09-\x0D] and outside [^\x00-\x2F\x3A-\x60\x7B-\x7F].
SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
NON_WORD = np.zeros(256, dtype=bool)
NON_WORD[0x00:0x30] = NON_WORD[0x3A:0x61] = NON_WORD[0x7B:0x80] = True

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser, elementwise."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_STEP = 1 << 12  # bytes over which powers restart


@lru_cache(maxsize=1)
def _near() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse within a step."""
    return _far(_BASE, _STEP), _far(_BASE_INVERSE, _STEP)


def _far(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def _down(at: np.ndarray) -> np.ndarray:
    """Inverse powers at any positions, from two short tables."""
    steps = _far(pow(_BASE_INVERSE, _STEP, 1 << 64), int(at.max(initial=0)) // _STEP + 1)
    return _near()[1][at % _STEP] * steps[at // _STEP]


@dataclass
class Words:
    """Words of a slice of documents: byte range, 64-bit hash, and where each document's begin."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # index of each document's first word, one entry more than documents

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def room(self) -> np.ndarray:
        """For each word, how many words its document has from there on."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.hash))


def split_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, lower: bool = True) -> Words:
    """Lower-case A-Z (unless told not to) and cut into words at ``separators``; ``offsets`` are
    document borders."""
    size = len(data)
    low = LOWER[data] if lower else data
    inside = np.zeros(size + 1, dtype=bool)
    np.logical_not(separators[low], out=inside[:size])
    border = np.zeros(size + 1, dtype=bool)
    border[offsets] = True
    before = np.zeros(size + 1, dtype=bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (border | ~before))
    end = np.flatnonzero(before & (border | ~inside))
    return Words(low, start, end, word_hash(low, start, end), np.searchsorted(start, offsets))


def range_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range of ``data``, in any order."""
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    for at, sums in _running(data):
        prefix[at + 1 : at + 1 + len(sums)] = sums
    return mix((prefix[end] - prefix[start]) * _down(start))


def word_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``range_hash`` of ranges that follow each other, with memory for the ranges only."""
    out = np.zeros(len(start), dtype=np.uint64)
    for at, sums in _running(data):
        # The sum up to a range's border is that of the byte before it.
        for edge, add in ((end, np.add), (start, np.subtract)):
            a, b = np.searchsorted(edge, [at + 1, at + 1 + len(sums)])
            add(out[a:b], sums[edge[a:b] - at - 1], out=out[a:b])
    return mix(out * _down(start))


def _running(data: np.ndarray, block: int = 64 * _STEP):
    """(position, running sums of the coded bytes from there on) of each block of ``data``."""
    step = pow(_BASE, _STEP, 1 << 64)
    total, scale = np.uint64(0), 1
    for at in range(0, len(data), block):
        codes = _BYTE_CODES[data[at : at + block]]
        for k in range(0, len(codes), _STEP):
            codes[k : k + _STEP] *= _near()[0][: len(codes) - k] * np.uint64(scale)
            scale = scale * step % (1 << 64)
        np.cumsum(codes, out=codes)
        codes += total
        total = codes[-1]
        yield at, codes


def gram_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words, by its first word; one entry per complete run."""
    out = words[: max(0, len(words) - n + 1)].copy()
    for k in range(1, n):
        out = out * np.uint64(_BASE) + words[k : k + len(out)]
    return mix(out + np.uint64(n))


def text_of(values: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and borders of Python strings (null: empty)."""
    raw = [(v or "").encode() for v in values]
    offsets = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(r) for r in raw], out=offsets[1:])
    return np.frombuffer(b"".join(raw), dtype=np.uint8), offsets


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and borders of an Arrow string column, nulls as empty texts, without a copy."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, borders, raw = texts.buffers()
    offsets = np.frombuffer(borders, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data, offsets


def slices(texts: pa.Array, target: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, borders) pieces of about ``target`` bytes, whole rows each."""
    if not len(texts):
        return
    data, offsets = buffers(texts)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(offsets, offsets[at] + target, side="right")) - 1
        to = min(len(texts), max(to, at + 1))
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def map_texts(
    docs: DataFrame,
    keep: list[str],
    added: T.StructType,
    work: Callable[[np.ndarray, np.ndarray], dict],
    text: str = "text",
    target: int = SLICE_BYTES,
) -> DataFrame:
    """One output row per input row: the ``keep`` columns and what ``work(bytes, borders)`` gives
    for each document. A kept column named like an added one is left out in favour of the latter."""
    names = {f.name.lower() for f in added}
    keep = [c for c in keep if c.lower() not in names]
    kept = [F.col(f"`{c}`") for c in keep]
    # A kept text is not sent twice.
    place = keep.index(text) if text in keep and dict(docs.dtypes)[text] == "string" else len(keep)
    source = docs.select(*kept, *([F.col(text).cast("string").alias("__text")] if place == len(keep) else []))
    schema = T.StructType([*source.schema.fields[: len(keep)], *added.fields])

    # Typed, so that a slice of nulls has the same schema as any other.
    types = {f.name: to_arrow_type(f.dataType) for f in added}

    def typed(name: str, value) -> pa.Array:
        return value if isinstance(value, pa.Array) else pa.array(value, types[name])

    def run(batches):
        for batch in batches:
            texts = batch.column(place)
            for at, to, data, offsets in slices(texts, target):
                new = work(data, offsets)
                kept = [batch.column(i).slice(at, to - at) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    kept + [typed(f.name, new[f.name]) for f in added],
                    names=[*keep, *(f.name for f in added)],
                )

    return source.mapInArrow(run, schema)


def code_points(data: np.ndarray, offsets: np.ndarray, block: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes as code points, and the document borders counted in them."""
    out, counts, at = [np.zeros(0, np.uint32)], [0], 0
    ends = []
    while at < len(data):
        to = min(len(data), at + block)
        while to < len(data) and data[to] & 0xC0 == 0x80:
            to += 1
        out.append(_decoded(data[at:to]))
        counts.append(counts[-1] + len(out[-1]))
        ends.append(to)
        at = to
    borders = np.zeros(len(offsets), dtype=np.int64)
    at = 0
    for k, to in enumerate(ends):
        inner = (offsets > at) & (offsets <= to)
        before = np.concatenate([[0], np.cumsum((data[at:to] & 0xC0) != 0x80, dtype=np.int64)])
        borders[inner] = counts[k] + before[offsets[inner] - at]
        at = to
    return np.concatenate(out), borders


def _decoded(data: np.ndarray) -> np.ndarray:
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    first = data[lead].astype(np.uint32)
    out = first.copy()
    last = len(data) - 1
    for k, (low, mask) in enumerate(((0xC0, 0x1F), (0xE0, 0x0F), (0xF0, 0x07)), start=1):
        many = np.flatnonzero(first >= low)
        out[many] = first[many] & mask
        for j in range(1, k + 1):
            out[many] = (out[many] << 6) | (data[np.minimum(lead[many] + j, last)] & 0x3F)
    return out
