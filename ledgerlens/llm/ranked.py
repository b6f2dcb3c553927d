"""Ranked lexical search by accumulator-limited term-at-a-time evaluation.

Queries are a stated set against all documents, read in blocks of bounded size. Only the block's
distinct terms are shipped: a first pass counts in how many documents each occurs, a second one
scores. There each task indexes a segment of its documents at a time and evaluates every query on
it, the rarest term first. A term met while accumulators are open adds to every document it occurs
in; as soon as the bounds of the remaining terms cannot lift a new document to the k-th partial
score, no accumulator is created any more and the survivors alone are updated, exactly. The k-th
score of a query so far is carried from segment to segment, so later ones close earlier. A task
sends its k best documents per query, whatever it read."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm import text as tx
from ledgerlens.llm.decontaminate import Lookup

BEST = 10
BLOCK_WORDS = 2_000_000  # words of the queries of one block: 16 MB of hashes, with a further pass per block
SLICE_BYTES = 500_000
SEGMENT_POSTINGS = 1 << 19
K1_TENTHS, B_HUNDREDTHS = 8, 75  # saturation 0.8, length normalisation 0.75


@dataclass
class Queries:
    """Distinct terms of a block and, by query, its terms with their numbers."""

    ids: list
    keys: np.ndarray
    first: np.ndarray  # terms of query q: entries first[q] .. first[q + 1]
    term: np.ndarray
    times: np.ndarray


def _block(rows: list[tuple]) -> Queries:
    words = tx.split_words(*tx.text_of(t for _, t in rows), tx.NON_WORD)
    keys, term = np.unique(words.hash, return_inverse=True)
    pair, times = np.unique(words.doc_of_word() * max(1, len(keys)) + term, return_counts=True)
    owner, term = pair // max(1, len(keys)), pair % max(1, len(keys))
    return Queries([i for i, _ in rows], keys, np.searchsorted(owner, np.arange(len(rows) + 1)), term, times)


def _blocks(queries: DataFrame, limit: int) -> Iterator[Queries]:
    """Queries in blocks of about ``limit`` words (a longer one is a block of its own)."""
    rows, size = [], 0
    for query, text in queries.toLocalIterator():
        words = len(text) // 2 + 1
        if rows and size + words > limit:
            yield _block(rows)
            rows, size = [], 0
        rows.append((query, text))
        size += words
    if rows:
        yield _block(rows)


def _counted(words: tx.Words, lookup: Lookup) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, document, occurrences) of the terms asked for, by term and document."""
    at, term = lookup.find(words.hash)
    docs = len(words.first)
    owner = np.searchsorted(words.first, at, side="right") - 1
    pair, tf = np.unique(term * docs + owner, return_counts=True)
    return pair // docs, pair % docs, tf


@dataclass
class Statistics:
    """Documents with terms, all their terms, and the weight of each term asked for."""

    documents: int
    words: int
    weight: np.ndarray
    frequency: np.ndarray


def _statistics(texts: DataFrame, keys: np.ndarray) -> Statistics:
    lookup = texts.sparkSession.sparkContext.broadcast(Lookup(keys))
    size = len(keys)

    def run(batches):
        total = np.zeros(size + 2, np.int64)
        for batch in batches:
            for _, _, data, offsets in tx.slices(batch.column(0), SLICE_BYTES):
                words = tx.split_words(data, offsets, tx.NON_WORD)
                total[:size] += np.bincount(_counted(words, lookup.value)[0], minlength=size)
                total[size:] += np.count_nonzero(words.counts), len(words.hash)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["k", "n"])

    total = np.zeros(size + 2, np.int64)
    counts = texts.select("text").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
    for row in counts.toLocalIterator():
        total[row["k"]] = row["n"]
    documents, words = map(int, total[size:])
    weight = np.floor(1000 * np.log((2 * documents + 2) / (2 * total[:size] + 1))).astype(np.int64)
    return Statistics(documents, words, weight, total[:size])


class Segment:
    """Postings of a part of a task's documents: by term, documents and what the term adds there."""

    def __init__(self, parts: list[tuple], statistics: Statistics, size: int):
        term, self.doc, tf, self.ids, self.known, length = (np.concatenate([p[i] for p in parts]) for i in range(6))
        order = np.argsort(term, kind="stable")
        term, self.doc, tf = term[order], self.doc[order], tf[order]
        wide = 75 * int(length.max(initial=0)) * statistics.documents >= 1 << 63
        m = 100 - B_HUNDREDTHS + B_HUNDREDTHS * length.astype(object if wide else np.int64) * statistics.documents // max(1, statistics.words)
        m = m.astype(np.int64)
        self.gain = statistics.weight[term] * (1_000_000_000 * tf // (1000 * tf + K1_TENTHS * m[self.doc]))
        self.first = np.searchsorted(term, np.arange(size + 1))
        self.most = np.zeros(size, np.int64)
        here = np.flatnonzero(np.diff(self.first))
        if len(here):
            self.most[here] = np.maximum.reduceat(self.gain, self.first[here])


def evaluate(segment: Segment, term: np.ndarray, times: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, score) of a segment's documents that may be among the ``k`` best of a query: all
    of the ``k`` best are there, with exact scores. ``term`` is in the order of evaluation, and only
    scores of ``least`` or more are wanted."""
    bound = segment.most[term] * times
    left = np.cumsum(bound[::-1])[::-1]
    total = np.zeros(len(segment.ids), np.int64)
    met = np.zeros(len(segment.ids), bool)
    live = None  # survivors, once no accumulator is created any more
    for i, t in enumerate(term):
        a, b = segment.first[t], segment.first[t + 1]
        if a == b:
            continue
        doc, gain = segment.doc[a:b], segment.gain[a:b] * times[i]
        if live is None:
            floor = least
            if np.count_nonzero(met) >= k:
                partial = total[met]
                floor = max(floor, int(np.partition(partial, len(partial) - k)[len(partial) - k]))
            # A document that only ties could still win by its id.
            if left[i] < floor:
                live = met
        if live is not None:
            some = live[doc]
            doc, gain = doc[some], gain[some]
        total[doc] += gain
        met[doc] = True
    found = np.flatnonzero(met & (total >= max(1, least)))
    return found, total[found]


def _best(score: np.ndarray, ids: np.ndarray, known: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best: highest score, then smallest id, rows without one last."""
    return np.lexsort((ids, ~known, -score))[:k]


_FOUND = "query long, score long, doc_id long"


def _scored(texts: DataFrame, queries: Queries, statistics: Statistics, k: int, postings: int) -> DataFrame:
    rarest = [
        a + np.lexsort((queries.term[a:b], statistics.frequency[queries.term[a:b]]))
        for a, b in zip(queries.first[:-1], queries.first[1:])
    ]
    plan = [(queries.term[o], queries.times[o]) for o in rarest]
    shipped = texts.sparkSession.sparkContext.broadcast((Lookup(queries.keys), plan, statistics))

    def run(batches):
        lookup, plan, statistics = shipped.value
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        best = [none] * len(plan)

        def finish(parts):
            segment = Segment(parts, statistics, len(lookup.keys))
            for q, (term, times) in enumerate(plan):
                score, ids, known = best[q]
                found, gained = evaluate(segment, term, times, k, int(score[-1]) if len(score) == k else 0)
                if len(found):
                    score, ids, known = np.append(score, gained), np.append(ids, segment.ids[found]), np.append(known, segment.known[found])
                    top = _best(score, ids, known, k)
                    best[q] = score[top], ids[top], known[top]

        parts, size, docs = [], 0, 0
        for batch in batches:
            known = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            ids = batch.column(1).fill_null(0).to_numpy()
            for at, to, data, offsets in tx.slices(batch.column(0), SLICE_BYTES):
                words = tx.split_words(data, offsets, tx.NON_WORD)
                term, doc, tf = _counted(words, lookup)
                parts.append((term, doc + docs, tf, ids[at:to], known[at:to], words.counts))
                size, docs = size + len(term), docs + to - at
                if size >= postings:
                    finish(parts)
                    parts, size, docs = [], 0, 0
        if parts:
            finish(parts)
        many = [len(b[0]) for b in best]
        if sum(many):
            score, ids, known = (np.concatenate([b[i] for b in best]) for i in range(3))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(best)), many)), pa.array(score), pa.array(ids, pa.int64(), mask=~known)],
                names=["query", "score", "doc_id"],
            )

    return texts.mapInArrow(run, _FOUND)


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = BEST,
    doc_id: str = "doc_id",
    text: str = "text",
    query_id: str = "item_id",
    query_text: str = "text",
    block_words: int = BLOCK_WORDS,
    segment_postings: int = SEGMENT_POSTINGS,
) -> DataFrame:
    """For each query row its ``k`` best documents with a score above zero: the query's id,
    ``rank`` (from 1), ``doc_id`` and ``score``, highest first, equal scores by ascending id.

    Null and word-less texts have no terms: such documents are neither counted nor found, such
    queries find nothing. Terms that occur in no document add nothing. Each query row is searched by
    itself, so repeated rows and rows with one id or none have lists of their own; each document row
    counts, repeated ones too, and rows without id come last among equal scores. Whole texts count,
    however long. Ids of documents are whole numbers; other columns are not read; empty tables give
    no rows."""
    texts = docs.select(F.col(text).cast("string").alias("text"), F.col(doc_id).cast("long").alias("id"))
    asked = queries.select(F.col(query_id).alias("id"), F.coalesce(F.col(query_text).cast("string"), F.lit("")).alias("text"))
    out = None
    for block in _blocks(asked, block_words):
        found = _scored(texts, block, _statistics(texts, block.keys), k, segment_postings)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        # A query's id by its place in the block, as a literal of the block's size.
        names = docs.sparkSession.createDataFrame(
            [(i, q) for i, q in enumerate(block.ids)], f"query long, `{query_id}` {asked.schema['id'].dataType.simpleString()}"
        )
        part = top.join(names, "query").select(query_id, "rank", F.col("doc_id").alias(doc_id), "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        empty = f"`{query_id}` {asked.schema['id'].dataType.simpleString()}, rank int, `{doc_id}` long, score long"
        return docs.sparkSession.createDataFrame([], empty)
    return out
