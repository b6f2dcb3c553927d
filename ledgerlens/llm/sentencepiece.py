"""SentencePiece encoding by suffix-array matching, and decoding.

Distinct segments of a batch (a word with the spaces before it) are joined to one text whose suffix
array is built to the depth of the longest piece. Every piece is looked up by binary search, its
range of suffixes gives its occurrences, and these are the edges of the segment lattices. Edges are
sorted by their end and relaxed for all segments at once.

The vocabulary is a byte-pair one, where the encoding of a prefix ends with the one piece that
stays apart from the last piece before it when the two are merged by the vocabulary's priorities.
So relaxing an edge means: keep it if its piece and the one that ends at its start stay apart. That
test is answered by merging the two alone, once per pair, and kept in a table of fixed size."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

from pyspark.sql import types as T

from ledgerlens.llm import text as tx

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
BATCH_CHARS = 120_000
SLICE_BYTES = 1_000_000
CACHE_SEGMENTS = 500_000
_PAIR_SLOTS = 1 << 21


@dataclass
class Vocabulary:
    """Pieces by id: ``score`` orders merges, ``surface`` is what decoding writes."""

    score: dict[str, float]
    ids: dict[str, int]
    pieces: list[str]  # by lattice number
    piece_ids: np.ndarray
    chars: np.ndarray  # known characters, sorted; numbers from 1 in ``coded``
    coded: np.ndarray  # (piece, longest) numbers of the piece's characters, 0: none
    lengths: np.ndarray
    byte_ids: np.ndarray
    surface: list[bytes]
    unknown: int

    @property
    def longest(self) -> int:
        return self.coded.shape[1]


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Vocabulary of a byte-pair model file with byte fallback, a dummy prefix and no normaliser."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(len(model))]
    normal = [i for i in range(len(model)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    score = {names[i]: model.get_score(i) for i in normal}
    byte_ids = np.full(256, model.unk_id(), dtype=np.int32)
    surface = [n.replace(SPACE, " ").encode() for n in names]
    for i in range(len(model)):
        if model.is_byte(i):
            byte_ids[int(names[i][3:5], 16)] = i
            surface[i] = bytes([int(names[i][3:5], 16)])
        elif model.is_control(i):
            surface[i] = b""
        elif model.is_unknown(i):
            surface[i] = " ⁇ ".encode()
    chars = np.array(sorted(ord(n) for n in score if len(n) == 1), dtype=np.uint32)
    known = set(map(chr, chars.tolist()))
    split = [n for n in score if any(n[k] == SPACE and n[k - 1] != SPACE for k in range(1, len(n)))]
    if split:
        raise ValueError(f"pieces reach across words: {split[:3]}")
    usable = [n for n in score if set(n) <= known]
    lengths = np.array([len(n) for n in usable])
    coded = np.zeros((len(usable), int(lengths.max(initial=1))), dtype=np.uint16)
    for row, name in enumerate(usable):
        coded[row, : len(name)] = np.searchsorted(chars, [ord(c) for c in name]) + 1
    ids = {names[i]: i for i in normal}
    return Vocabulary(score, ids, usable, np.array([ids[n] for n in usable], np.int32), chars, coded, lengths, byte_ids, surface, model.unk_id())


def merged(text: str, score: dict[str, float]) -> list[str]:
    """Merges the best-scored adjacent pair, the leftmost among equals, until none is a piece."""
    parts = list(text)
    gains = [score.get(parts[k] + parts[k + 1]) for k in range(len(parts) - 1)]
    while True:
        best = None
        for k, g in enumerate(gains):
            if g is not None and (best is None or g > gains[best]):
                best = k
        if best is None:
            return parts
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
        del gains[best]
        if best > 0:
            gains[best - 1] = score.get(parts[best - 1] + parts[best])
        if best < len(gains):
            gains[best] = score.get(parts[best] + parts[best + 1])


class Encoder:
    """Encodes segments; remembers recent segments and pairs within fixed bounds."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.none = len(vocabulary.pieces)  # lattice number of a character without a piece
        self.pair = np.full(_PAIR_SLOTS, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.apart = np.zeros(_PAIR_SLOTS, bool)
        self.alone = np.array([merged(p, vocabulary.score) == [p] for p in vocabulary.pieces])
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.tokens = np.zeros(0, np.int32)

    def _stays_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether two pieces stay as they are when merged together."""
        key = left.astype(np.uint64) * np.uint64(self.none + 1) + right.astype(np.uint64)
        slot = (tx.mix(key) % np.uint64(_PAIR_SLOTS)).astype(np.int64)
        out = self.apart[slot]
        missing = np.flatnonzero(self.pair[slot] != key)
        if len(missing):
            new, first, back = np.unique(key[missing], return_index=True, return_inverse=True)
            p, score = self.v.pieces, self.v.score
            fresh = np.empty(len(new), bool)
            for i, m in enumerate(missing[first].tolist()):
                a, b = p[left[m]], p[right[m]]
                fresh[i] = merged(a + b, score) == [a, b]
            out[missing] = fresh[back]
            self.pair[slot[missing]] = key[missing]
            self.apart[slot[missing]] = fresh[back]
            # Of pairs that share a slot the last one written counts, with its own answer.
            clash = self.pair[slot[missing]] != key[missing]
            if clash.any():
                self.pair[slot[missing[clash]]] = np.uint64(0xFFFFFFFFFFFFFFFF)
        return out

    def _lattice(self, codes: np.ndarray, bits: int, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, piece) of every occurrence of every piece in the batch text. ``number``: code in
        the batch of each vocabulary character, 0 if it does not occur."""
        v = self.v
        per_key = 64 // bits
        n_keys = -(-v.longest // per_key)
        padded = np.concatenate([codes, np.zeros(n_keys * per_key, codes.dtype)]).astype(np.uint64)
        keys = []
        for k in range(n_keys):
            key = np.zeros(len(codes), np.uint64)
            for c in range(per_key):
                at = k * per_key + c
                key = (key << np.uint64(bits)) | padded[at : at + len(codes)]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]
        spelled = number[v.coded]
        inside = np.arange(v.longest) < v.lengths[:, None]
        piece = np.flatnonzero(((spelled > 0) | ~inside).all(axis=1) & self.alone)
        low, high = [], []
        full = np.uint64((1 << bits) - 1)
        for k in range(n_keys):
            lo, hi = np.zeros(len(piece), np.uint64), np.zeros(len(piece), np.uint64)
            for c in range(per_key):
                at = k * per_key + c
                has = inside[piece, at] if at < v.longest else np.zeros(len(piece), bool)
                value = spelled[piece, at].astype(np.uint64) if at < v.longest else np.zeros(len(piece), np.uint64)
                lo = (lo << np.uint64(bits)) | np.where(has, value, np.uint64(0))
                hi = (hi << np.uint64(bits)) | np.where(has, value, full)
            low.append(lo)
            high.append(hi)
        first, last = _bisect(keys, low, False), _bisect(keys, high, True)
        many = last - first
        place = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
        return order[place], np.repeat(piece, many)

    def encode_batch(self, points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token ids, tokens per segment). ``points`` holds the segments with a free place after
        each; ``begin`` and ``end`` are their ranges."""
        v = self.v
        where = np.minimum(np.searchsorted(v.chars, points), len(v.chars) - 1)
        known = v.chars[where] == points
        known[end] = False
        present = np.unique(where[known])
        number = np.zeros(len(v.chars) + 1, np.uint16)
        number[present + 1] = np.arange(1, len(present) + 1)
        bits = 8 if len(present) < 255 else 16
        codes = np.where(known, number[where + 1], (1 << bits) - 1).astype(np.uint16)
        codes[end] = 0
        start, piece = self._lattice(codes, bits, number)
        strange = np.flatnonzero(~known)
        strange = strange[codes[strange] != 0]
        start = np.concatenate([start, strange])
        piece = np.concatenate([piece, np.full(len(strange), self.none)])
        stop = start + np.append(v.lengths, 1)[piece]
        size = end - begin
        origin = np.repeat(begin, size + 1)
        depth = stop - origin[start]
        order = np.argsort(depth.astype(np.uint16) if depth.max(initial=0) < 65536 else depth, kind="stable")
        start, stop, piece = start[order], stop[order], piece[order]
        steps = np.concatenate([[0], np.cumsum(np.bincount(depth, minlength=1))])
        ending = np.full(len(points), -1, np.int64)
        source = np.zeros(len(points), np.int64)
        rank = np.zeros(len(points), np.int64)
        for d in range(1, len(steps) - 1):
            s, e, p = (x[steps[d] : steps[d + 1]] for x in (start, stop, piece))
            before = ending[s]
            free = (before < 0) | (before == self.none) | (p == self.none)
            ask = np.flatnonzero(~free)
            good = free
            good[ask] = self._stays_apart(before[ask], p[ask])
            s, e, p = s[good], e[good], p[good]
            ending[e], source[e], rank[e] = p, s, rank[s] + 1
        count = rank[end]
        first = np.cumsum(count) - count
        token = np.zeros(int(count.sum()), np.int64)
        char = np.zeros(len(token), np.uint32)
        at, base = end.copy(), first
        live = np.flatnonzero(at > begin)
        while len(live):
            here = at[live]
            place = base[live] + rank[here] - 1
            token[place] = ending[here]
            char[place] = points[source[here]]
            at[live] = source[here]
            live = live[at[live] > begin[live]]
        return self._with_bytes(token, char, count)

    def _with_bytes(self, token: np.ndarray, char: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids, with the UTF-8 bytes of characters that no piece holds."""
        ids = np.append(self.v.piece_ids, 0)[token]
        odd = token == self.none
        if not odd.any():
            return ids, count
        width = np.where(odd, 1 + (char >= 0x80) + (char >= 0x800) + (char >= 0x10000), 1)
        raw = b"".join(chr(c).encode("utf-8", "replace").ljust(w, b"?")[:w] for c, w in zip(char[odd].tolist(), width[odd].tolist()))
        out = np.repeat(ids, width)
        out[np.repeat(odd, width)] = self.v.byte_ids[np.frombuffer(raw, np.uint8)]
        ends = np.concatenate([[0], np.cumsum(width)])
        stop = np.cumsum(count)
        return out, ends[stop] - ends[stop - count]

    def lookup(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, tokens per segment) of byte ranges; ``first`` ones get the dummy prefix."""
        key = tx.mix(tx.range_hash(data, start, end) + first.astype(np.uint64))
        unique, one, which = np.unique(key, return_index=True, return_inverse=True)
        if len(self.keys) > CACHE_SEGMENTS:
            self._forget()
        place = np.minimum(np.searchsorted(self.keys, unique), max(0, len(self.keys) - 1))
        new = np.flatnonzero(self.keys[place] != unique) if len(self.keys) else np.arange(len(unique))
        if len(new):
            self._learn(data, unique[new], start[one[new]], end[one[new]], first[one[new]])
        place = np.searchsorted(self.keys, unique)[which]
        size = self.size[place]
        spread = np.repeat(self.at[place] - np.cumsum(size) + size, size) + np.arange(size.sum())
        return self.tokens[spread], size

    def _learn(self, data, keys, start, end, first) -> None:
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        load = np.cumsum(chars[end] - chars[start] + 2)
        for some in np.split(np.arange(len(keys)), np.flatnonzero(np.diff(load // BATCH_CHARS)) + 1):
            a, b, f = start[some], end[some], first[some].astype(np.int64)
            width = b - a
            raw = data[np.repeat(a - np.cumsum(width) + width, width) + np.arange(width.sum())]
            points, borders = tx.code_points(raw, np.concatenate([[0], np.cumsum(width)]))
            size = np.diff(borders) + f
            begin = np.cumsum(size + 1) - size - 1
            joined = np.zeros(int((size + 1).sum()), np.uint32)
            owner = np.repeat(np.arange(len(some)), np.diff(borders))
            joined[np.arange(len(points)) - borders[owner] + begin[owner] + f[owner]] = np.where(points == 32, ord(SPACE), points)
            joined[begin[f > 0]] = ord(SPACE)
            ids, count = self.encode_batch(joined, begin, begin + size)
            self.at = np.concatenate([self.at, len(self.tokens) + np.cumsum(count) - count])
            self.size = np.concatenate([self.size, count])
            self.tokens = np.concatenate([self.tokens, ids.astype(np.int32)])
        self.keys = np.concatenate([self.keys, keys])
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.at, self.size = self.keys[order], self.at[order], self.size[order]


def _bisect(keys: list[np.ndarray], wanted: list[np.ndarray], after: bool) -> np.ndarray:
    """Place of each wanted key in sorted multi-word keys, before or after equal ones."""
    low = np.zeros(len(wanted[0]), np.int64)
    high = np.full(len(wanted[0]), len(keys[0]), np.int64)
    for _ in range(int(len(keys[0])).bit_length()):
        live = low < high
        middle = np.minimum((low + high) // 2, len(keys[0]) - 1)
        less = np.zeros(len(low), bool)
        same = np.ones(len(low), bool)
        for k, w in zip(keys, wanted):
            value = k[middle]
            less |= same & (value < w)
            same &= value == w
        right = (less | same) if after else less
        low = np.where(live & right, middle + 1, low)
        high = np.where(live & ~right, middle, high)
    return low


def _plain_spaces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text with the vocabulary's space mark read as the space it stands for."""
    mark = np.frombuffer(SPACE.encode(), np.uint8)
    at = np.flatnonzero((data[:-2] == mark[0]) & (data[1:-1] == mark[1]) & (data[2:] == mark[2]))
    if not len(at):
        return data, offsets
    keep = np.ones(len(data), bool)
    keep[at + 1] = keep[at + 2] = False
    data = data.copy()
    data[at] = 32
    return data[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


def segments(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first of its document) byte ranges that no piece reaches across, in order:
    words with the spaces before them, and what else stands between words."""
    size = len(data)
    inside = np.zeros(size + 1, bool)
    np.logical_not(breaks[data], out=inside[:size])
    border = np.zeros(size + 1, bool)
    border[offsets] = True
    before = np.zeros(size + 1, bool)
    before[1:] = inside[:-1]
    start, end = np.flatnonzero(inside & (border | ~before)), np.flatnonzero(before & (border | ~inside))
    doc = np.searchsorted(offsets, start, side="right") - 1
    floor = np.concatenate([[0], end[:-1]])[: len(start)]
    floor = np.maximum(floor, offsets[doc])
    solid = np.maximum.accumulate(np.where(data != 32, np.arange(size), -1)) if size else np.zeros(0, np.int64)
    gap = np.maximum(floor, np.concatenate([[-1], solid])[start] + 1)
    rest = floor < gap
    last = np.searchsorted(start, offsets[1:]) - 1
    tail = np.maximum(offsets[:-1], np.where(last >= 0, np.append(end, 0)[last], 0))
    open_end = tail < offsets[1:]
    begin = np.concatenate([gap, floor[rest], tail[open_end]])
    finish = np.concatenate([end, gap[rest], offsets[1:][open_end]])
    order = np.argsort(begin, kind="stable")
    begin, finish = begin[order], finish[order]
    return begin, finish, border[begin]


_IDS = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))])
_ENCODERS: dict[str, Encoder] = {}


def _breaks(vocabulary: Vocabulary) -> np.ndarray:
    """Bytes that end a word: the space and ASCII characters without a piece."""
    out = np.zeros(256, bool)
    out[:128] = ~np.isin(np.arange(128), vocabulary.chars)
    out[32] = True
    return out


def encode(docs: DataFrame, vocabulary: Vocabulary, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """One row per input row: the ``keep`` columns (all by default) and ``ids``.

    A null or empty text has no ids. The space mark U+2581 in a text counts as a space. Characters
    without a piece become their bytes. Texts of any length are encoded whole; repeated rows each
    get their own row; an empty table gives none. Where two ways to join pieces tie, the leftmost
    is taken, as the library does. A column named ``ids`` is replaced."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)
    breaks, name = _breaks(vocabulary), uuid.uuid4().hex

    def work(data, offsets):
        # One encoder per worker, so that its memory of segments outlives a task.
        encoder = _ENCODERS.get(name)
        if encoder is None:
            _ENCODERS.clear()
            encoder = _ENCODERS[name] = Encoder(shipped.value)
        data, offsets = _plain_spaces(data, offsets)
        start, end, first = segments(data, offsets, breaks)
        if not len(start):
            return {"ids": pa.array([[]] * (len(offsets) - 1), pa.list_(pa.int32()))}
        ids, size = encoder.lookup(data, start, end, first)
        total = np.concatenate([[0], np.cumsum(size)])
        edges = total[np.searchsorted(start, offsets)].astype(np.int32)
        return {"ids": pa.ListArray.from_arrays(pa.array(edges), pa.array(ids))}

    return tx.map_texts(docs, docs.columns if keep is None else keep, _IDS, work, text, SLICE_BYTES)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the text of ``ids``: pieces side by side, without the dummy prefix. Null gives null; ids
    outside the vocabulary and null ids give nothing; broken UTF-8 becomes U+FFFD."""
    shipped = encoded.sparkSession.sparkContext.broadcast(vocabulary.surface)
    names = [c for c in encoded.columns if c.lower() != out.lower()]
    source = encoded.select(*(f"`{c}`" for c in names))
    schema = T.StructType([*source.schema.fields, T.StructField(out, T.StringType())])
    at = names.index(ids)

    def run(batches):
        surface = shipped.value
        table = pa.array(surface, pa.binary())
        for batch in batches:
            column = batch.column(at)
            texts = []
            for i in range(batch.num_rows):
                value = column[i]
                if not value.is_valid:
                    texts.append(None)
                    continue
                numbers = value.values
                if numbers.null_count or (len(numbers) and not (0 <= pa.compute.min(numbers).as_py() and pa.compute.max(numbers).as_py() < len(surface))):
                    numbers = pa.array([n for n in numbers.to_pylist() if n is not None and 0 <= n < len(surface)], pa.int32())
                taken = table.take(numbers)
                raw = b"" if not len(taken) else taken.buffers()[2].to_pybytes()
                texts.append((raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, out])

    return source.mapInArrow(run, schema)
