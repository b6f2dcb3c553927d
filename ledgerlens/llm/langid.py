"""Language identification by rank-order profiles of character n-grams.

The profile of a language lists its most frequent n-grams in order of frequency. A document gets
the language whose profile is nearest by the out-of-place distance: for each of the document's most
frequent n-grams, how far its rank is from the rank in the profile, or the profile's size if it is
not there. Counts for the profiles come from all labelled training documents."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import text as tx

PROFILE = 400
MAX_N = 3
UNKNOWN = "und"
SLICE_BYTES = 500_000
BLOCK = 1 << 18  # characters counted at a time
_GRAM_BITS = np.uint64(40)
_TABLE = 0x20000


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case letter of each code point, 0 for what is no letter."""
    out = np.zeros(_TABLE, dtype=np.uint32)
    for c in range(_TABLE):
        if unicodedata.category(chr(c))[0] == "L":
            small = chr(c).lower()
            out[c] = ord(small) if len(small) == 1 else c
    return out


def _letter_codes(points: np.ndarray) -> np.ndarray:
    inside = points < _TABLE
    codes = _letters()[np.where(inside, points, 0)]
    # Planes beyond the table hold ideographs only.
    return np.where(inside | (points > 0x3FFFF), codes, points)


def _lettered(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(letter or 0 for a word border, document) along the slice: one border around each word."""
    points, borders = tx.code_points(data, offsets)
    docs, many = len(offsets) - 1, np.diff(borders)
    codes = np.zeros(len(points) + 2 * docs, dtype=np.uint32)
    owner = np.repeat(np.arange(docs, dtype=np.int32), many + 2)
    inner = np.ones(len(codes), dtype=bool)
    inner[borders[:-1] + 2 * np.arange(docs)] = False
    inner[borders[1:] + 2 * np.arange(docs) + 1] = False
    codes[inner] = _letter_codes(points)
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0) | (owner[1:] != owner[:-1])
    return codes[keep], owner[keep]


def gram_counts(data: np.ndarray, offsets: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, gram code) of the n-grams of letters with word borders, n up to 3, in
    order, with counts. Grams are told apart by 40 bits of their hash, so two of a million distinct
    ones fall together with a probability of 0.4. Counted ``block`` characters at a time, so memory
    follows the letters and the distinct grams. Fewer than 2^24 documents."""
    codes, owner = _lettered(data, offsets)
    parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    for n in range(1, MAX_N + 1):
        size = len(codes) - n + 1
        for a in range(0, size, block):
            b = min(size, a + block)
            # Neither a border alone nor one between two words makes a gram.
            good = owner[a:b] == owner[a + n - 1 : b + n - 1]
            for k in range(n) if n == 1 else range(1, n - 1):
                good &= codes[a + k : b + k] != 0
            if n == 2:
                good &= (codes[a:b] != 0) | (codes[a + 1 : b + 1] != 0)
            at = a + np.flatnonzero(good)
            code = np.full(len(at), n, dtype=np.uint64)
            for k in range(n):
                code = code * np.uint64(0x200003) + codes[at + k]
            key = (owner[at].astype(np.uint64) << _GRAM_BITS) | (tx.mix(code) >> (np.uint64(64) - _GRAM_BITS))
            parts.append(_summed([(key, np.ones(len(key), np.int64))]))
    key, count = _summed(parts)
    return (key >> _GRAM_BITS).astype(np.int64), key & ((np.uint64(1) << _GRAM_BITS) - np.uint64(1)), count


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their summed counts."""
    key, count = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[edge], np.add.reduceat(count, edge) if len(edge) else count


@dataclass
class Profiles:
    """Gram codes of all profiles, and their rank in each (``size``: not there)."""

    languages: list[str]
    codes: np.ndarray
    ranks: np.ndarray
    size: int


def learn(training: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE) -> Profiles:
    """Profiles of all languages of ``training`` (rows with a null label or text teach nothing).
    The driver gets ``size`` rows per language; a tie in frequency goes to the smaller gram code."""

    def count(batches):
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            labels = batch.column(1).dictionary_encode()
            names, which = labels.dictionary.to_pylist(), labels.indices.to_numpy()
            for at, to, data, offsets in tx.slices(batch.column(0), SLICE_BYTES):
                doc, code, n = gram_counts(data, offsets)
                label = which[at:to][doc]
                for k in np.unique(label):
                    mine = label == k
                    old = total.get(names[k], (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
                    total[names[k]] = _summed([old, (code[mine], n[mine])])
        for name, (code, n) in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(code)), pa.array(code.astype(np.int64)), pa.array(n)],
                names=["lang", "code", "n"],
            )

    rows = training.select(F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("l"))
    rows = rows.where("l is not null and t is not null")
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = (
        rows.mapInArrow(count, "lang string, code long, n long")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
        .withColumn("r", F.row_number().over(best))
        .where(F.col("r") <= size)
        .select("lang", "code", "r")
        .toPandas()
    )
    languages = sorted(top["lang"].unique())
    codes = np.unique(top["code"].to_numpy().astype(np.uint64))
    ranks = np.full((len(codes), len(languages)), size, dtype=np.int32)
    row = np.searchsorted(codes, top["code"].to_numpy().astype(np.uint64))
    column = np.searchsorted(np.array(languages, dtype=object), top["lang"].to_numpy()) if languages else row
    ranks[row, column] = top["r"].to_numpy() - 1
    return Profiles(languages, codes, ranks, size)


def distances(profiles: Profiles, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Out-of-place distance of each document to each profile, and how many grams were compared."""
    docs = len(offsets) - 1
    owner, code, count = gram_counts(data, offsets)
    order = np.argsort((owner.astype(np.uint64) << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - count.astype(np.uint64)), kind="stable")
    owner, code = owner[order], code[order]
    many = np.bincount(owner, minlength=docs)
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    top = rank < profiles.size
    owner, code, rank = owner[top], code[top], rank[top]
    out = np.zeros((docs, len(profiles.languages)))
    if len(profiles.codes):
        at = np.minimum(np.searchsorted(profiles.codes, code), len(profiles.codes) - 1)
        known = profiles.codes[at] == code
        for k in range(len(profiles.languages)):
            place = np.where(known, profiles.ranks[at, k], profiles.size)
            apart = np.where(place < profiles.size, np.abs(place - rank), profiles.size)
            out[:, k] = np.bincount(owner, apart, docs)
    return out, np.minimum(many, profiles.size)


_ADDED = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
_LETTERED = T.StructType([*_ADDED.fields, T.StructField("lettered", T.BooleanType())])


def identify(
    docs: DataFrame, profiles: Profiles, keep: list[str] | None = None, text: str = "text", lettered: bool = False
) -> DataFrame:
    """One row per input row: the ``keep`` columns (all by default), ``lang_pred`` and ``score``
    (1 less the distance per gram as a share of the largest possible; 0 to 1).

    A null text, one without letters, or a model without languages gives ``und`` and 0. Equal
    distances go to the language that sorts first; equal frequencies inside a document to the
    smaller gram code. Whole texts are counted whatever their length. ``lettered`` adds a column of
    that name: whether the text has letters, with or without a model. Repeated rows each get their
    own row, empty tables give none. Columns named like an added one are replaced."""
    shipped = docs.sparkSession.sparkContext.broadcast(profiles)

    def work(data, offsets):
        model = shipped.value
        size = len(offsets) - 1
        if not model.languages:
            none = {"lang_pred": [UNKNOWN] * size, "score": np.zeros(size)}
            return none | ({"lettered": distances(model, data, offsets)[1] > 0} if lettered else {})
        far, many = distances(model, data, offsets)
        best = far.argmin(axis=1)
        score = 1 - far[np.arange(size), best] / np.maximum(1, many * model.size)
        names = np.array(model.languages, dtype=object)[best]
        names[many == 0] = UNKNOWN
        found = {"lang_pred": names, "score": np.where(many > 0, np.clip(score, 0, 1), 0.0)}
        return found | ({"lettered": many > 0} if lettered else {})

    return tx.map_texts(docs, docs.columns if keep is None else keep, _LETTERED if lettered else _ADDED, work, text, SLICE_BYTES)


def held_out(doc_id: str = "doc_id", parts: int = 4, part: int = 2):
    """Whether a document is kept from training: crc32 of its id as text; never for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))
