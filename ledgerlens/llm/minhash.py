"""Near-duplicate groups by min-max hashing.

Each document is the set of its distinct word shingles. Under every permutation both the smallest
and the largest value are kept, so half as many permutations as signature values are evaluated.
Bands of the signature give candidates; links are confirmed on the full sets.

Sets are compared along three steps, none of which lists the pairs of a group:

1. Documents with equal sets are one node, found by a fingerprint with map-side aggregation.
2. In every band bucket all nodes are compared with one hub, the node that meets most others.
3. Nodes of buckets whose members are still in several components are joined on the necessary
   prefix of their sets in rarity order with the positional bound, and only across components,
   which is exact for what the hubs could not settle.

Components come from alternating large and small stars. Links, labels and sets stay in tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import text as tx
from ledgerlens.session import materialise, new_folder

SHINGLE = 5
PERMUTATIONS = 64  # 128 signature values
BAND_VALUES = 4  # 32 bands: a pair at 0.85 is missed with probability 6e-11
THRESHOLD = 85  # per cent of the union
_CHUNK = 1 << 14


def shingle_sets(words: tx.Words, shingle: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document; the whole sequence if it has fewer words."""
    out = []
    for a, b in zip(words.first[:-1], words.first[1:]):
        out.append(np.unique(tx.gram_hash(words.hash[a:b], min(shingle, b - a))) if b > a else np.zeros(0, np.uint64))
    return out


def _coefficients(permutations: int) -> np.ndarray:
    return np.random.default_rng(7).integers(0, 1 << 32, permutations, dtype=np.uint32)[:, None] | np.uint32(1)


def min_max(shingles: np.ndarray, coefficients: np.ndarray) -> np.ndarray:
    """Smallest and largest value of the set under each permutation, side by side."""
    low, high = shingles.astype(np.uint32), (shingles >> np.uint64(32)).astype(np.uint32)
    least, most = None, None
    for at in range(0, len(low), _CHUNK):
        values = coefficients * low[None, at : at + _CHUNK] + high[None, at : at + _CHUNK]
        a, b = values.min(axis=1), values.max(axis=1)
        least = a if least is None else np.minimum(least, a)
        most = b if most is None else np.maximum(most, b)
    return np.stack([least, most], axis=1).ravel()


def bands_of(signature: np.ndarray, values: int) -> np.ndarray:
    """64-bit key of each band of a signature, told apart by its place."""
    rows = signature.astype(np.uint64).reshape(-1, values)
    key = np.arange(len(rows), dtype=np.uint64)
    for k in range(values):
        key = tx.mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return key


_SIGNED = T.StructType(
    [
        T.StructField("f1", T.LongType()),
        T.StructField("f2", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)


def _signatures(docs: DataFrame, text: str, shingle: int, permutations: int, values: int) -> DataFrame:
    coefficients = _coefficients(permutations)

    def work(data, offsets):
        sets = shingle_sets(tx.split_words(data, offsets, tx.SPACES), shingle)
        f1 = np.array([tx.mix(s).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
        f2 = np.array([tx.mix(s ^ np.uint64(0x5BD1E9955BD1E995)).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
        bands = [bands_of(min_max(s, coefficients), values).astype(np.int64) if len(s) else [] for s in sets]
        return {
            "f1": f1.astype(np.int64),
            "f2": f2.astype(np.int64),
            "n_shingles": np.array([len(s) for s in sets], dtype=np.int64),
            "bands": pa.array(bands, pa.list_(pa.int64())),
        }

    return tx.map_texts(docs, ["id"], _SIGNED, work, text)


def _set_table(docs: DataFrame, text: str, shingle: int) -> DataFrame:
    """(id, shingles as packed sorted hashes)."""

    def work(data, offsets):
        sets = shingle_sets(tx.split_words(data, offsets, tx.SPACES), shingle)
        return {"shingles": pa.array([s.tobytes() for s in sets], pa.binary())}

    added = T.StructType([T.StructField("shingles", T.BinaryType())])
    return tx.map_texts(docs, ["id"], added, work, text)


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _linked(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The (a, b) pairs whose full sets reach the threshold."""
    with_both = pairs.join(sets.selectExpr("id AS b", "shingles AS y"), "b").join(
        sets.selectExpr("id AS a", "shingles AS x"), "a"
    )

    def check(batches):
        for batch in batches:
            a, b, x, y = (batch.column(batch.schema.get_field_index(c)) for c in "abxy")
            keep = []
            for i in range(batch.num_rows):
                p = np.frombuffer(x[i].as_buffer(), dtype=np.uint64)
                q = np.frombuffer(y[i].as_buffer(), dtype=np.uint64)
                # Sizes alone rule most false candidates out.
                if 100 * min(len(p), len(q)) < threshold * max(len(p), len(q)):
                    continue
                both = np.sort(np.concatenate([p, q]))
                same = int((both[1:] == both[:-1]).sum())
                if 100 * same >= threshold * (len(p) + len(q) - same):
                    keep.append(i)
            take = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([a.take(take), b.take(take)], names=["a", "b"])

    return with_both.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with an edge in ``edges`` (a, b); label: smallest node reached.

    A star's centre may hold any share of the edges: minima are combined map-side and saved before
    they are joined back, so that the join can be split."""
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = materialise(edges.where("u > v").distinct())
    before = None
    while True:
        now = _checksum(edges)
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            )
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
        larger = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Nodes that are their neighbourhood's minimum keep their edges through the larger side.
        edges = materialise(larger.where("u > v").distinct())
        least = materialise(edges.groupBy("u").agg(F.min("v").alias("m")))
        joined = edges.join(least, "u")
        smaller = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        edges = materialise(smaller.where("u > v").distinct())


def _prefix_pairs(members: DataFrame, sets: DataFrame, labels: DataFrame, threshold: int) -> DataFrame:
    """Pairs across components among ``members`` that can still be linked: they share a shingle in
    the necessary prefix of both sets, and its places leave room for the overlap."""

    def unpack(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                s = np.frombuffer(batch.column(1)[i].as_buffer(), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(s), batch.column(0)[i].as_py())), pa.array(s), pa.array(np.full(len(s), len(s)))],
                    names=["id", "s", "size"],
                )

    rows = _saved(
        sets.join(members, "id", "left_semi").select("id", "shingles").mapInArrow(unpack, "id long, s long, size long"),
        "shingles",
    )
    # Shingles of one document lead nowhere; they only take the first places of its order.
    common = materialise(rows.groupBy("s").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    shared = rows.join(common, "s")
    kept = f"size - ceil(size * {threshold} / 100.0) + 1"
    place = Window.partitionBy("id").orderBy("df", "s")
    ordered = (
        shared.withColumn("r", F.row_number().over(place))
        .withColumn("n_shared", F.count(F.lit(1)).over(Window.partitionBy("id")))
        .withColumn("place", F.expr("size - n_shared + r - 1"))
        .where(F.expr(f"place < {kept}"))
        .join(labels.select(F.col("node").alias("id"), "label"), "id", "left")
        .select("s", "id", "size", "place", F.coalesce("label", "id").alias("label"))
    )
    ordered = _saved(ordered, "prefixes")
    by_label = ordered.groupBy("s", "label").agg(F.count(F.lit(1)).alias("n"))
    major = by_label.groupBy("s").agg(
        F.max(F.struct("n", F.col("label").alias("major")))["major"].alias("major"), F.count(F.lit(1)).alias("k")
    )
    major = materialise(major.where("k > 1").select("s", "major"))
    mixed = _saved(ordered.join(major, "s"), "mixed")
    few = mixed.where("label <> major").selectExpr("s", "id AS i", "size AS n", "place AS p", "label AS l")
    every = mixed.selectExpr("s", "id AS j", "size AS m", "place AS q", "label AS k", "label = major AS is_major")
    need = f"{threshold} * (n + m)"
    room = f"{100 + threshold} * least(n - p, m - q)"
    return (
        few.join(every, "s")
        .where(f"l <> k AND (is_major OR i < j) AND {room} >= {need}")
        .select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"))
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    threshold: int = THRESHOLD,
    permutations: int = PERMUTATIONS,
    band_values: int = BAND_VALUES,
) -> DataFrame:
    """One row per document row: ``doc_id``, ``n_shingles`` (size of its set), ``component_id``
    (smallest id reachable over links, its own included) and ``kept`` (the ids are equal).

    Null, empty and word-less texts have an empty set and no links. Repeated rows are each
    returned, with one component. A row without id takes the smallest id of its group; where the
    group has none it is null and the row kept. Ids are whole numbers. Other columns are not read,
    so their names cannot clash. Empty tables give no rows."""
    source = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    signed = _saved(_signatures(source, "text", shingle, permutations, band_values), "signatures")
    nodes = materialise(signed.where("n_shingles > 0").groupBy("f1", "f2").agg(F.min("id").alias("node")))
    placed = signed.join(nodes, ["f1", "f2"], "left")
    keyed = placed.where("id = node").select("node", F.explode("bands").alias("band"))
    shared = materialise(
        keyed.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("x"), F.max("node").alias("y")).where("x < y").select("band", "n")
    )
    met = _saved(keyed.join(shared, "band"), "buckets")
    weight = materialise(met.groupBy("node").agg(F.sum("n").alias("w")))
    weighed = met.join(weight, "node")
    hubs = materialise(
        weighed.groupBy("band").agg(F.min(F.struct((-F.col("w")).alias("w"), "node"))["node"].alias("hub"))
    )
    members = weight.select(F.col("node").alias("id"))
    sets = _saved(_set_table(source.join(members, "id", "left_semi"), "text", shingle), "sets").dropDuplicates(["id", "shingles"])
    to_hub = met.join(hubs, "band").where("hub <> node").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = materialise(_linked(to_hub, sets, threshold))
    labels = materialise(components(links))
    named = met.join(labels.withColumnRenamed("label", "l"), "node", "left").select("band", "node", F.coalesce("l", "node").alias("label"))
    named = _saved(named, "named")
    open_bands = materialise(
        named.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("band")
    )
    unsettled = materialise(named.join(open_bands, "band").select(F.col("node").alias("id")).distinct())
    more = materialise(_linked(_prefix_pairs(unsettled, sets, labels, threshold), sets, threshold))
    labels = materialise(components(links.unionByName(more)))
    found = placed.join(labels, "node", "left")
    component = F.coalesce("label", "node", "id")
    return found.select(
        F.col("id").alias(doc_id),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, component.isNull()).alias("kept"),
    )
