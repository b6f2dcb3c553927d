"""Language-model scores by deleted interpolation.

A token's probability mixes the maximum-likelihood bigram and unigram estimates and the uniform one.
The mixture weights depend on the bucket of the context's frequency and are learned by expectation
maximisation on a part of the training documents that is deleted from the counts.

No table of counts ever meets one task or the driver. Documents are packed into chunks of a few
megabytes with chunk-local word numbers. Each chunk sends its distinct words and pairs, dealt by
hash, to counting shards of bounded size; a shard adds up what the chunks sent and answers each
chunk with the totals in the order asked. A chunk sends a word or pair once, however often it
occurs, so frequent ones do not load a shard. With more shards than keys in a chunk this is an
ordinary shuffle of pre-aggregated keys. The driver sees only totals and, for the weights, a
histogram of bounded size."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import text as tx
from ledgerlens.llm.packed import pack as _pack
from ledgerlens.llm.packed import rows as _rows
from ledgerlens.llm.packed import unpack as _unpack
from ledgerlens.session import new_folder

CHUNK_BYTES = 8_000_000
SHARD_KEYS = 400_000
ROUNDS = 40
_END, _START = np.uint64(0x6A09E667F3BCC909), 0x5BE0
_BITS = 4  # histogram steps per factor of two
_KEEP, _CUT, _HELD = 0, 1, 2


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


_CHUNKS = (
    "chunk long, cut boolean, ids array<bigint>, flags binary, lengths binary, stream binary,"
    " high binary, low binary, n_words long, n_tokens long"
)


def _chunk_row(number: int, cut: bool, parts: list[tuple]) -> pa.RecordBatch:
    ids, flags, lengths, tokens = (np.concatenate([p[i] for p in parts]) for i in range(4))
    words, inverse, counts = np.unique(tokens, return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    place = np.empty(len(words), np.uint32)
    place[order] = np.arange(len(words), dtype=np.uint32)
    words = words[order]
    raw = words.view(np.uint8).reshape(-1, 8)
    missing = np.concatenate([p[4] for p in parts])
    row = {
        "chunk": pa.array([number], pa.int64()),
        "cut": pa.array([cut]),
        "ids": pa.array([pa.array(ids, pa.int64(), mask=missing)], pa.list_(pa.int64())),
        "flags": pa.array([flags.astype(np.uint8).tobytes()], pa.binary()),
        "lengths": pa.array([_pack(lengths)], pa.binary()),
        "stream": pa.array([_pack(place[inverse])], pa.binary()),
        "high": pa.array([raw[:, 4:].tobytes()], pa.binary()),
        "low": pa.array([raw[:, :4].tobytes()], pa.binary()),
        "n_words": pa.array([len(words)], pa.int64()),
        "n_tokens": pa.array([len(tokens)], pa.int64()),
    }
    return pa.RecordBatch.from_arrays(list(row.values()), names=list(row))


def _chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """Packed documents; those deleted from the counts have chunks of their own."""

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        waiting: dict[bool, list] = {False: [], True: []}
        size = {False: 0, True: 0}
        for batch in batches:
            ids_all = batch.column(0)
            missing_all = np.asarray(ids_all.is_null())
            ids_all = ids_all.fill_null(0).to_numpy()
            flags_all = batch.column(1).to_numpy()
            for at, to, data, offsets in tx.slices(batch.column(2)):
                words = tx.split_words(data, offsets, tx.SPACES)
                owner = words.doc_of_word()
                tokens = np.full(len(words.hash) + to - at, _END, dtype=np.uint64)
                tokens[np.arange(len(owner)) + owner] = words.hash
                lengths = words.counts + 1
                flags = flags_all[at:to]
                for cut in (False, True):
                    mine = (flags == _CUT) == cut
                    if not mine.any():
                        continue
                    part = ids_all[at:to][mine], flags[mine], lengths[mine], tokens[np.repeat(mine, lengths)], missing_all[at:to][mine]
                    waiting[cut].append(part)
                    size[cut] += int((np.diff(offsets)[mine]).sum())
                    if size[cut] >= chunk_bytes:
                        yield _chunk_row(number, cut, waiting[cut])
                        number, waiting[cut], size[cut] = number + 1, [], 0
        for cut, parts in waiting.items():
            if parts:
                yield _chunk_row(number, cut, parts)
                number += 1

    return docs.mapInArrow(run, _CHUNKS)


def _high(row: dict) -> np.ndarray:
    return np.frombuffer(row["high"], "<u4")


def _words(row: dict) -> np.ndarray:
    high = np.frombuffer(row["high"], np.uint8).reshape(-1, 4)
    low = np.frombuffer(row["low"], np.uint8).reshape(-1, 4)
    return np.ascontiguousarray(np.concatenate([low, high], axis=1)).view("<u8").ravel()


def _contexts(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token stream, context of each token (number of words: the start), tokens per document."""
    stream, lengths = _unpack(row["stream"]), _unpack(row["lengths"]).astype(np.int64)
    before = np.empty_like(stream)
    before[1:] = stream[:-1]
    before[np.cumsum(lengths) - lengths] = row["n_words"]
    return stream, before, lengths


def _pairs(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (context, word) of a chunk in order, and the pair of each token."""
    stream, before, _ = _contexts(row)
    wide = np.uint64(row["n_words"] + 1)
    pair, which = np.unique(before * wide + stream, return_inverse=True)
    return (pair // wide).astype(np.int64), (pair % wide).astype(np.int64), which


def _dealt(code: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of keys by shard, and where each shard's begin."""
    shard = (tx.mix(code) % np.uint64(shards)).astype(np.int64)
    return np.argsort(shard, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=shards))])


def _word_codes(row: dict) -> np.ndarray:
    return _high(row).astype(np.uint64)


def _pair_codes(row: dict, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    high = np.append(_high(row), np.uint32(_START)).astype(np.uint64)
    return (high[left] << np.uint64(32)) | high[right]


_ASKED = "shard int, chunk long, cut boolean, keys binary, counts binary"
_ANSWERED = "chunk long, shard int, kept binary, whole binary, kept_total long, whole_total long, n_distinct long"


def _counted(chunks: DataFrame, pairs: bool, shards: int) -> DataFrame:
    """What each shard answers each chunk, and one row of totals per shard (chunk null)."""
    # A shard holds few enough pairs for five bytes of their hash to tell them apart.
    width = 5 if pairs else 8

    def ask(batches):
        for row in _rows(batches):
            words = _words(row)
            trained = _trained(row)
            if pairs:
                left, right, which = _pairs(row)
                counts = np.bincount(which[trained], minlength=len(left))
                ends = np.append(words, np.uint64(_START))
                keys = tx.mix(ends[left] * np.uint64(0x9E3779B97F4A7C15) + ends[right])
                order, first = _dealt(_pair_codes(row, left, right), shards)
            else:
                keys, counts = words, np.bincount(_unpack(row["stream"])[trained], minlength=len(words))
                order, first = _dealt(_word_codes(row), shards)
            raw = keys[order].view(np.uint8).reshape(-1, 8)[:, :width]
            counts = counts[order]
            used = np.flatnonzero(np.diff(first))
            for at in range(0, len(used), 64):
                some = used[at : at + 64]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(some.astype(np.int32)),
                        pa.array([row["chunk"]] * len(some), pa.int64()),
                        pa.array([row["cut"]] * len(some)),
                        pa.array([raw[first[s] : first[s + 1]].tobytes() for s in some], pa.binary()),
                        pa.array([_pack(counts[first[s] : first[s + 1]]) for s in some], pa.binary()),
                    ],
                    names=["shard", "chunk", "cut", "keys", "counts"],
                )

    def add_up(table: pa.Table) -> pa.Table:
        chunk, cut = table.column("chunk").to_pylist(), table.column("cut").to_pylist()
        raw = [np.frombuffer(k.as_buffer(), np.uint8).reshape(-1, width) for k in table.column("keys")]
        sizes = [len(r) for r in raw]
        wide = np.zeros((sum(sizes), 8), np.uint8)
        wide[:, :width] = np.concatenate(raw)
        _, which = np.unique(wide.view("<u8").ravel(), return_inverse=True)
        counts = np.concatenate([_unpack(c.as_py()) for c in table.column("counts")]).astype(float)
        deleted = np.repeat(cut, sizes)
        kept = np.bincount(which, np.where(deleted, 0, counts)).astype(np.int64)
        whole = np.bincount(which, counts).astype(np.int64)
        ends = np.cumsum(sizes)
        spans = [which[e - s : e] for s, e in zip(sizes, ends)]
        none = [None] * len(chunk)
        return pa.table(
            {
                "chunk": pa.array([*chunk, None], pa.int64()),
                "shard": pa.array([table.column("shard")[0].as_py()] * (len(chunk) + 1), pa.int32()),
                "kept": pa.array([*(_pack(kept[w]) if c else None for w, c in zip(spans, cut)), None], pa.binary()),
                "whole": pa.array([*(_pack(whole[w]) for w in spans), None], pa.binary()),
                "kept_total": pa.array([*none, kept.sum()], pa.int64()),
                "whole_total": pa.array([*none, whole.sum()], pa.int64()),
                "n_distinct": pa.array([*none, int((whole > 0).sum())], pa.int64()),
            }
        )

    columns = ["chunk", "cut", "flags", "lengths", "stream", "high", "low", "n_words"]
    asked = chunks.select(*columns).mapInArrow(ask, _ASKED)
    return _saved(asked.groupBy("shard").applyInArrow(add_up, _ANSWERED), "counts")


def _trained(row: dict) -> np.ndarray:
    """Which tokens of a chunk belong to training documents."""
    return np.repeat(np.frombuffer(row["flags"], np.uint8) != _HELD, _unpack(row["lengths"]).astype(np.int64))


def _answers(chunks: DataFrame, words: DataFrame, pairs: DataFrame, cut_only: bool) -> DataFrame:
    """Chunks with the answers to both their questions."""
    column = "kept" if cut_only else "whole"
    asked = [
        t.where(f"chunk is not null and {column} is not null").select("chunk", F.lit(k).alias("kind"), "shard", F.col(column).alias("n"))
        for k, t in enumerate((words, pairs))
    ]
    answers = asked[0].unionByName(asked[1]).groupBy("chunk").agg(F.collect_list(F.struct("kind", "shard", "n")).alias("answers"))
    chunks = chunks.where("cut") if cut_only else chunks
    return chunks.select("chunk", "ids", "flags", "lengths", "stream", "high", "n_words").join(answers, "chunk")


def _restored(row: dict, kind: int, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.zeros(len(order), np.int64)
    for a in row["answers"]:
        if a["kind"] == kind:
            out[order[first[a["shard"]] : first[a["shard"] + 1]]] = _unpack(a["n"])
    return out


@dataclass
class Model:
    """Totals and mixture weights: ``weights[bucket]`` for bigram, unigram and uniform."""

    total: int
    distinct: int
    documents: int
    weights: np.ndarray
    word_shards: int
    pair_shards: int


def _bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + the whole part of its binary logarithm."""
    return np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))).astype(np.int64) + 1, 0)


def _estimates(row: dict, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per token: its count, its context's count, its bigram and its unigram estimate."""
    stream, before, _ = _contexts(row)
    word_count = _restored(row, 0, *_dealt(_word_codes(row), model.word_shards))
    left, right, which = _pairs(row)
    pair_count = _restored(row, 1, *_dealt(_pair_codes(row, left, right), model.pair_shards))
    context = np.append(word_count, model.documents)[before]
    own = word_count[stream]
    bigram = pair_count[which] / np.maximum(context, 1)
    return own, context, bigram, own / max(1, model.total)


def _histogram(joined: DataFrame, model: Model) -> DataFrame:
    """Deleted tokens by context bucket and binned estimates, with the bins' sums."""

    def binned(x: np.ndarray) -> np.ndarray:
        return np.where(x > 0, np.maximum(1, 241 + np.floor(np.log2(np.maximum(x, 2.0**-60)) * _BITS)), 0).astype(np.int64)

    def run(batches):
        for row in _rows(batches):
            _, context, bigram, unigram = _estimates(row, model)
            cell = (_bucket(context) << 20) | (binned(bigram) << 10) | binned(unigram)
            cells, which, n = np.unique(cell, return_inverse=True, return_counts=True)
            sums = [np.bincount(which, x, len(cells)) for x in (bigram, unigram)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells), pa.array(n), *map(pa.array, sums)], names=["cell", "n", "two", "one"]
            )

    cells = joined.mapInArrow(run, "cell long, n long, two double, one double")
    return cells.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("two").alias("two"), F.sum("one").alias("one"))


def learn_weights(cells, distinct: int, rounds: int = ROUNDS) -> np.ndarray:
    """Weights by bucket from (bucket, n, bigram, unigram) cells; a bucket without held-out tokens
    takes those of the next lower one."""
    out = np.tile([0.0, 0.9, 0.1], (66, 1))
    out[1:] = [0.5, 0.4, 0.1]
    if not distinct:
        out[:] = [0.0, 0.0, 1.0]
        return out
    uniform = 1 / (distinct + 1)
    bucket, n, two, one = cells
    for b in range(66):
        mine = bucket == b
        if not mine.any():
            if b > 1:
                out[b] = out[b - 1]
            continue
        f = np.stack([two[mine], one[mine], np.full(mine.sum(), uniform)], axis=1)
        w = np.full(3, 1 / 3)
        for _ in range(rounds):
            share = w * f
            share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
            w = (n[mine][:, None] * share).sum(axis=0) / n[mine].sum()
        # Some mass stays with the uniform part, so that no text gets probability zero.
        w = np.maximum(w, [0.0, 0.0, 1e-6])
        out[b] = w / w.sum()
    return out


def lm_scores(
    docs: DataFrame,
    held_out,
    deleted,
    doc_id: str = "doc_id",
    text: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    shard_keys: int = SHARD_KEYS,
) -> DataFrame:
    """One row per document row: ``doc_id``, ``held_out``, ``n_tokens`` (words and one end),
    ``n_known`` (of those, seen in training), ``train_tokens``, ``base_score`` (add-half unigram)
    and ``score`` (the model's), both as base-10 logarithms of the text's probability.

    ``held_out`` documents teach nothing. The weights are learned on the training documents for
    which ``deleted`` holds, with counts that leave them out; then all training documents count.
    A null result of either condition means false. Null and word-less texts consist of their end.
    Without training documents all probabilities are uniform. Ids are whole numbers, repeated rows
    and null ids stay as they are, other columns are not read, empty tables give no rows."""
    flag = F.when(F.coalesce(held_out, F.lit(False)), _HELD).when(F.coalesce(deleted, F.lit(False)), _CUT).otherwise(_KEEP)
    source = docs.select(F.col(doc_id).cast("long").alias("id"), flag.alias("flag"), F.col(text).cast("string").alias("text"))
    chunks = _saved(_chunks(source, chunk_bytes), "chunks")
    sizes = chunks.agg(F.sum("n_words"), F.sum("n_tokens")).first()
    word_shards, pair_shards = (max(1, -(-(n or 0) // shard_keys)) for n in sizes)
    words, pairs = _counted(chunks, False, word_shards), _counted(chunks, True, pair_shards)
    total = words.where("chunk is null").agg(F.sum("kept_total"), F.sum("whole_total"), F.sum("n_distinct")).first()
    kept, whole, distinct = (n or 0 for n in total)
    # Every training document has one end.
    by_flag = {r["flag"]: r["n"] for r in source.groupBy("flag").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_kept, n_cut = by_flag.get(_KEEP, 0), by_flag.get(_CUT, 0)
    deleted_model = Model(kept, distinct, n_kept, np.zeros((0, 3)), word_shards, pair_shards)
    cells = _histogram(_answers(chunks, words, pairs, True), deleted_model).toPandas()
    n = cells["n"].to_numpy()
    table = (cells["cell"].to_numpy() >> 20, n, cells["two"].to_numpy() / n, cells["one"].to_numpy() / n)
    model = Model(whole, distinct, n_kept + n_cut, learn_weights(table, distinct), word_shards, pair_shards)

    def score(batches):
        for row in _rows(batches):
            own, context, bigram, unigram = _estimates(row, model)
            w = model.weights[_bucket(context)]
            p = w[:, 0] * bigram + w[:, 1] * unigram + w[:, 2] / (model.distinct + 1)
            base = (own + 0.5) / (model.total + 0.5 * (model.distinct + 1))
            lengths = _unpack(row["lengths"]).astype(np.int64)
            first = np.cumsum(lengths) - lengths
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["ids"], pa.int64()),
                    pa.array(np.frombuffer(row["flags"], np.uint8) == _HELD),
                    pa.array(lengths),
                    pa.array(np.add.reduceat((own > 0).astype(np.int64), first)),
                    pa.array(np.full(len(lengths), model.total)),
                    pa.array(np.add.reduceat(np.log10(base), first)),
                    pa.array(np.add.reduceat(np.log10(p), first)),
                ],
                names=[doc_id, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    schema = f"`{doc_id}` long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return _answers(chunks, words, pairs, False).mapInArrow(score, schema)
