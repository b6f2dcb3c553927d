"""Personal data in whole texts: pattern matches, and spans of a trained character tagger.

Every kind of span holds a digit or an at-sign, so the tagger reads exactly the windows that hold
one; windows overlap by half, each is decoded by itself, and a character takes its tag from the
window in which it stands nearest to the middle. Tagger spans that touch a pattern match are left
to the match.

The tagger learns more than the patterns take: it is trained on texts with the matches as they
stand and on the same texts with the matches rewritten in forms that no pattern takes (``_FORMS``).
It proposes shapes; range, length and check digit are tested afterwards, so a number of a card's
shape is labelled as one in training whether its check digit holds or not."""

from __future__ import annotations

import hashlib
import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import text as tx
from ledgerlens.llm.tagger import Tagger
from ledgerlens.session import materialise

KINDS = ("email", "ip", "card", "phone")
WINDOW = 64
STRIDE = 32
TRAINING_DOCS = 20_000  # expected size of the labelled sample
STEPS = 600
VERSIONS = 2  # rewritten copies of a sampled document that holds a match
TRAINING_WINDOWS = 20_000  # expected number at most, with spans and without; training draws 38,400

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match always takes whole runs of digits, so starting only at a run's start loses nothing.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: list[int]) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> list[int]:
    return [int(d) for d in _DIGITS.findall(text)]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern matches, leftmost and non-overlapping within a kind; the
    time is linear in the text."""
    found, floor = [], 0
    for at in (m.start() for m in re.finditer("@", text)):
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            found.append((start, 0, m.end()))
            floor = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def _code_table() -> np.ndarray:
    """Letters by case and vowel-free identity, each digit as one class, punctuation as itself."""
    table = np.full(0x250, 2, dtype=np.int16)  # 0 padding, 1 beyond the table, 2 other
    for c in range(0x250):
        s = chr(c)
        if c < 128 and s.isdigit():
            table[c] = 3
        elif c < 128 and s.isalpha():
            table[c] = 4 + (ord(s.lower()) - 97)
        elif c in (9, 10, 13, 32):
            table[c] = 30
        elif 32 < c < 127:
            table[c] = 31 + (c - 33 if c < 65 else c - 33 - 26 if c < 97 else c - 33 - 52)
        elif s.isalpha():
            table[c] = 1
    return table


_CODES = _code_table()
ALPHABET = int(_CODES.max()) + 1


def encode(points: np.ndarray) -> np.ndarray:
    return np.where(points < len(_CODES), _CODES[np.minimum(points, len(_CODES) - 1)], 1)


def _window_starts(trigger: np.ndarray) -> np.ndarray:
    """Starts of the grid windows that hold a trigger position."""
    cell = np.unique(np.concatenate([trigger // STRIDE, trigger // STRIDE - 1]))
    return cell[cell >= -1] * STRIDE


def _cut(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(window, WINDOW) codes, padded with zeros outside the text."""
    padded = np.concatenate([np.zeros(STRIDE, codes.dtype), codes, np.zeros(WINDOW, codes.dtype)])
    return padded[(starts + STRIDE)[:, None] + np.arange(WINDOW)]


def _reconciled(tags: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, tags): each position from the window in which it is most central."""
    where = (starts[:, None] + np.arange(WINDOW)).ravel()
    edge = np.tile(np.minimum(np.arange(WINDOW), WINDOW - 1 - np.arange(WINDOW)), len(starts))
    order = np.lexsort((np.repeat(starts, WINDOW), -edge, where))
    where, tags = where[order], tags.ravel()[order]
    lead = np.concatenate([[True], where[1:] != where[:-1]]) if len(where) else np.zeros(0, bool)
    return where[lead], tags[lead]


def _plausible(kind: int, text: str) -> bool:
    """What a tagged span must hold to be one of its kind; a card its check digit, a phone without
    plus sign its digits in groups."""
    if kind == 0:
        local, at, domain = text.partition("@")
        return bool(at) and any(c.isalnum() for c in local) and "." in domain and text[-1].isalnum()
    digits, between = _digits(text), set(_DIGITS.sub("", text))
    if kind == 1:
        parts = re.findall(r"[0-9]+", text)
        return (
            text.count(".") == 3
            and between <= set(" .[]()")
            and len(parts) == 4
            and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)
        )
    if kind == 2:
        return between <= set(" .-") and 13 <= len(digits) <= 19 and luhn(digits)
    return bool(between) and between <= set("+ ().-/") and 10 <= len(digits) <= 15


_EDGES = " .,;:\n\t"
_HOST = _LOCAL - set("._%+")


def _snapped(kind: int, text: str, start: int, end: int) -> tuple[int, int]:
    """The span without loose characters at its ends, which then cut no word of an address and no
    run of digits."""
    while start < end and (text[start] in _EDGES or kind and text[start] not in "+(0123456789"):
        start += 1
    while start < end and (text[end - 1] in _EDGES or kind and text[end - 1] not in "0123456789"):
        end -= 1
    if start == end:
        return start, end
    left, right = (_LOCAL, _HOST) if kind == 0 else (frozenset("0123456789"),) * 2
    while start and text[start] in left and text[start - 1] in left:
        start -= 1
    while end < len(text) and text[end] in right:
        end += 1
    return start, end


def tagged_spans(text: str, points: np.ndarray, starts: np.ndarray, tags: np.ndarray) -> list[tuple[int, int, int]]:
    where, tag = _reconciled(tags, starts)
    inside = (where >= 0) & (where < len(points))
    where, tag = where[inside], tag[inside]
    if not len(where):
        return []
    cut = np.flatnonzero((np.diff(where) != 1) | (np.diff(tag) != 0)) + 1
    out = []
    for a, b in zip(np.concatenate([[0], cut]), np.concatenate([cut, [len(where)]])):
        if tag[a]:
            start, end = int(where[a]), int(where[b - 1]) + 1
            kind = int(tag[a]) - 1
            start, end = _snapped(kind, text, start, end)
            free = not out or out[-1][2] <= start
            if free and start < end and _plausible(kind, text[start:end]):
                out.append((start, kind, end))
    return out


def _candidates(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Documents of a slice with a digit or an at-sign."""
    trigger = ((data >= 48) & (data <= 57)) | (data == 64)
    return np.unique(np.searchsorted(offsets, np.flatnonzero(trigger), side="right") - 1)


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", errors="replace"), dtype=np.uint32)


def _points(raw: np.ndarray) -> tuple[str, np.ndarray]:
    text = raw.tobytes().decode("utf-8", errors="replace")
    return text, _code_points(text)


def _triggers(points: np.ndarray) -> np.ndarray:
    return np.flatnonzero(((points >= 48) & (points <= 57)) | (points == 64))


def _fours(digits: str, between: str) -> str:
    return between.join(digits[i : i + 4] for i in range(0, len(digits), 4))


def _checked(digits: str) -> str:
    """The digits with a check digit after them."""
    return next(digits + c for c in "0123456789" if luhn(_digits(digits + c)))


def _grouped(digits: str, between: str) -> str:
    return between.join((digits[:-7], digits[-7:-4], digits[-4:]))


# Forms that the patterns do not take, by kind: what stands for a match, and what follows the span.
# Cards and phones get their digits only, addresses their text.
_FORMS = (
    (
        lambda m: (m.replace("@", " @ "), ""),
        lambda m: (m.replace("@", "[@]"), ""),
        lambda m: (m.replace("@", "(@)"), ""),
        lambda m: (m.partition("@")[0] + "@" + m.partition("@")[2].replace(".", "[.]"), ""),
    ),
    (
        lambda m: (m.replace(".", "[.]"), ""),
        lambda m: (m.replace(".", "(.)"), ""),
        lambda m: (m.replace(".", " . "), ""),
    ),
    (
        lambda d: (_fours(d, "."), ""),
        lambda d: (_fours(d, "  "), ""),
        lambda d: (_checked(d[:12]), ""),
        lambda d: (_fours(d, " "), " " + d[1:4]),
        lambda d: (d, " " + d[2:6]),
    ),
    (
        lambda d: (f"{d[:-10]} ({d[-10:-7]}) {d[-7:-4]}-{d[-4:]}".strip(), ""),
        lambda d: (f"({d[-10:-7]}) {d[-7:-4]}-{d[-4:]}", ""),
        lambda d: (_grouped(d[-10:], "."), ""),
        lambda d: (_grouped(d[-10:], "-"), ""),
        lambda d: (f"+{d[:-10]}/{_grouped(d[-10:], '/')}", ""),
        lambda d: (f"+{d[:-10]} ({d[-10:-7]}) {d[-7:-4]}-{d[-4:]}", f" {d[-6:]}"),
    ),
)


def rewritten(text: str, spans: list[tuple[int, int, int]], version: int) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with its spans in other forms, chosen by hash and version, and the new spans; a
    span that overlaps an earlier one stays as it is, unlabelled."""
    out, made, at, size = [], [], 0, 0
    for start, kind, end in spans:
        if start < at:
            continue
        match = text[start:end]
        forms = _FORMS[kind]
        form = forms[(zlib.crc32(f"{start}:{match}".encode()) + version) % len(forms)]
        new, after = form(match if kind < 2 else "".join(_DIGITS.findall(match)))
        size += start - at
        out += [text[at:start], new, after]
        made.append((size, kind, size + len(new)))
        size, at = size + len(new) + len(after), end
    return "".join([*out, text[at:]]), made


def _shapes(text: str) -> list[tuple[int, int, int]]:
    """The pattern matches and the numbers that only lack a card's check digit."""
    cards = ((m.start(), 2, m.end()) for m in _CARD.finditer(text) if 14 <= len(_digits(m[0])) <= 19)
    return sorted({*base_spans(text), *cards})


def _labelled(text: str) -> Iterator[tuple[str, list[tuple[int, int, int]]]]:
    """The text as it stands and rewritten, with its labels."""
    spans = _shapes(text)
    yield text, spans
    for version in range(VERSIONS if spans else 0):
        yield rewritten(text, spans, version)


def training_windows(docs: DataFrame, text: str = "text", sample: int = TRAINING_DOCS) -> DataFrame:
    """(codes, tags) of the distinct windows with triggers in about ``sample`` documents, chosen by
    hash, labelled by the shapes in them, and of the same documents with these rewritten."""
    total = docs.count()
    share = min(1.0, sample / max(1, total))
    chosen = docs.select(F.col(text).cast("string").alias("t")).where(
        f"t is not null and pmod(xxhash64(t), 1000000) < {share * 1_000_000:.0f}"
    )

    def packed(rows):
        columns = [pa.array([r[i] for r in rows], pa.binary()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, names=["codes", "tags"])

    def label(batches):
        for batch in batches:
            for _, _, data, offsets in tx.slices(batch.column(0)):
                rows = []
                for d in _candidates(data, offsets):
                    for body, spans in _labelled(_points(data[offsets[d] : offsets[d + 1]])[0]):
                        points = _code_points(body)
                        tags = np.zeros(len(points), np.int8)
                        for start, kind, end in spans:
                            tags[start:end] = kind + 1
                        starts = _window_starts(_triggers(points))
                        both = _cut(encode(points).astype(np.int8), starts), _cut(tags, starts)
                        rows += [(c.tobytes(), t.tobytes()) for c, t in zip(*both, strict=True)]
                        # A long text is not held with its rewritten copies.
                        if len(rows) >= 50_000:
                            yield packed(rows)
                            rows = []
                yield packed(rows)

    return chosen.mapInArrow(label, "codes binary, tags binary").distinct()


def bounded(windows: DataFrame, most: int = TRAINING_WINDOWS) -> DataFrame:
    """The windows, or about ``most`` of those with spans and of those without, chosen by hash."""
    windows = materialise(windows.withColumn("filled", F.col("tags") != F.lit(bytes(WINDOW))))
    total = {r["filled"]: r["n"] for r in windows.groupBy("filled").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = 1 << 40
    draw = F.pmod(F.xxhash64("codes", "tags"), F.lit(parts))
    under = F.lit(0)
    for filled, n in total.items():
        under = F.when(F.col("filled") == filled, F.lit(int(parts * min(1.0, most / n)))).otherwise(under)
    return windows.where(draw < under).select("codes", "tags")


def train(windows: list[tuple[bytes, bytes]], steps: int = STEPS) -> Tagger | None:
    """Tagger from labelled windows in any order; none where no window holds a span."""
    windows = sorted(windows)
    codes, tags = (
        np.frombuffer(b"".join(w[i] for w in windows), dtype=np.int8).reshape(-1, WINDOW).astype(np.int64)
        for i in (0, 1)
    )
    filled, bare = np.flatnonzero(tags.any(axis=1)), np.flatnonzero(~tags.any(axis=1))
    if not len(filled):
        return None
    # As many windows with spans as without, so that both are learnt in few steps.
    size = max(len(filled), len(bare))
    order = np.concatenate([np.resize(filled, size), np.resize(bare, size if len(bare) else 0)])
    model = Tagger.fresh(ALPHABET, len(KINDS) + 1)
    model.fit(codes[order], tags[order], steps=steps)
    return model


def fit(docs: DataFrame, text: str = "text", sample: int = TRAINING_DOCS, steps: int = STEPS) -> Tagger | None:
    """Tagger trained in one task on a labelled sample, bounded in documents and in windows; none
    without a span."""

    def work(batches):
        rows = [(r["codes"], r["tags"]) for batch in batches for r in batch.to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(rows, steps))], pa.binary())], names=["model"])

    fitted = bounded(training_windows(docs, text, sample)).coalesce(1).mapInArrow(work, "model binary").first()
    return pickle.loads(fitted["model"]) if fitted else None


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_ADDED = T.StructType(
    [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
)


def _found(model: Tagger | None, data: np.ndarray, offsets: np.ndarray) -> dict[int, tuple[list, list, str]]:
    """By document of the slice: pattern spans, all spans, text. Others have none."""
    some = [(d, *_points(data[offsets[d] : offsets[d + 1]])) for d in _candidates(data, offsets)]
    if not some:
        return {}
    starts = [_window_starts(_triggers(points)) for _, _, points in some]
    tags = [np.zeros((len(s), WINDOW), np.int8) for s in starts]
    if model is not None:
        codes = np.concatenate([_cut(encode(p).astype(np.int16), s) for (_, _, p), s in zip(some, starts)])
        done = np.concatenate([model.decode(codes[i : i + 1024]) for i in range(0, len(codes), 1024)])
        tags = np.split(done, np.cumsum([len(s) for s in starts])[:-1])
    out = {}
    for (d, body, points), s, t in zip(some, starts, tags):
        base = base_spans(body)
        more = [x for x in tagged_spans(body, points, s, t) if not any(x[0] < b and a < x[2] for a, _, b in base)]
        out[int(d)] = base, sorted(base + more), body
    return out


def find(docs: DataFrame, model: Tagger | None, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """One row per input row: the ``keep`` columns (all by default), the count of pattern matches
    of each kind (``n_email``, ``n_ip``, ``n_card``, ``n_phone``), ``base_sha256`` (of their
    ``kind:start:end`` list) and ``spans`` (all spans listed, the tagger's included; code points,
    end exclusive, by start and then kind).

    Null and empty texts have no spans. Without a model only patterns are found. Texts of any
    length are read whole. Repeated rows are each judged; of an empty table nothing is returned.
    Columns named like an added one are replaced."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    nothing = hashlib.sha256(b"").hexdigest()

    def work(data, offsets):
        size = len(offsets) - 1
        counts = np.zeros((size, len(KINDS)), np.int64)
        digest, listed = [nothing] * size, [""] * size
        for d, (base, spans, _) in _found(shipped.value, data, offsets).items():
            counts[d] = np.bincount([k for _, k, _ in base], minlength=len(KINDS))
            digest[d] = hashlib.sha256(_listed(base).encode()).hexdigest()
            listed[d] = _listed(spans)
        return {f"n_{k}": counts[:, i] for i, k in enumerate(KINDS)} | {"base_sha256": digest, "spans": listed}

    return tx.map_texts(docs, docs.columns if keep is None else keep, _ADDED, work, text)


def masked(body: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for start, kind, end in spans:
        if end <= at:
            continue
        if start >= at:
            out += [body[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join([*out, body[at:]])


def mask(docs: DataFrame, model: Tagger | None, text: str = "text") -> DataFrame:
    """The input with every span in ``text`` replaced by its kind in angle brackets; null stays
    null. Overlapping spans become one mark, that of the first. Repeated rows stay repeated, an
    empty table stays empty."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns
    added = T.StructType([T.StructField("__masked", T.StringType())])

    def work(data, offsets):
        out: list[str | None] = [None] * (len(offsets) - 1)
        for d, (_, spans, body) in _found(shipped.value, data, offsets).items():
            if spans:
                out[d] = masked(body, spans)
        return {"__masked": out}

    done = tx.map_texts(docs, columns, added, work, text)
    return done.withColumn(text, F.coalesce("__masked", F.col(f"`{text}`"))).select(*(f"`{c}`" for c in columns))


def rewritten_recall(docs: DataFrame, model: Tagger | None, text: str = "text") -> DataFrame:
    """(kind, made, found, others): matches of the documents rewritten in forms that the patterns do
    not take, how many of them come out with exact bounds, and how many more tagged spans there are
    that touch none of them. Measured on documents that the model was not fitted on."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        for batch in batches:
            count = np.zeros((3, len(KINDS)), np.int64)
            for _, _, data, offsets in tx.slices(batch.column(0)):
                for d in _candidates(data, offsets):
                    body = _points(data[offsets[d] : offsets[d + 1]])[0]
                    body, made = rewritten(body, base_spans(body), 0)
                    raw = np.frombuffer(body.encode("utf-8"), np.uint8)
                    seen = _found(shipped.value, raw, np.array([0, len(raw)])).get(0, ([], [], ""))
                    for span in made:
                        count[0, span[1]] += 1
                        count[1, span[1]] += span in seen[1]
                    for a, k, b in set(seen[1]) - set(seen[0]):
                        count[2, k] += not any(a < e and s < b for s, _, e in made)
            rows = [pa.array(list(KINDS)), *(pa.array(c) for c in count)]
            yield pa.RecordBatch.from_arrays(rows, names=["kind", "made", "found", "others"])

    texts = docs.select(F.col(text).cast("string").alias("t")).where("t is not null")
    sums = texts.mapInArrow(work, "kind string, made long, found long, others long").groupBy("kind")
    return sums.agg(*(F.sum(c).alias(c) for c in ("made", "found", "others")))
