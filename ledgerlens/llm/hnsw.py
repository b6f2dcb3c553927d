"""Approximate nearest neighbours: one hierarchical navigable small-world graph per shard.

Equal vectors are merged first, so a vector that holds any share of the rows is one node. Distinct
vectors are dealt to shards of bounded size by hash. A shard's graph is built by insertion in a
fixed random order, each node linked to a diverse choice of its nearest earlier nodes and back, and
is stored as flat neighbour arrays in one row. Queries visit every shard in blocks of bounded size;
each returns its nearest, which are merged per query."""

from __future__ import annotations

import heapq
import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import new_folder

SHARD_ROWS = 4096
LINKS = 16  # per node on upper levels; twice as many on the lowest
CANDIDATES = 64
WIDTH = 160  # search list on the lowest level
QUERY_BLOCK = 256
_BLOCK = 256


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1)[None] - 2 * (a @ b.T), 0)


def _diverse(points: np.ndarray, near: np.ndarray, far: np.ndarray, links: int) -> np.ndarray:
    """Of each row's candidates (nearest first, -1: none), those nearer to the node than to any
    candidate taken before, filled up with the nearest others; (node, links), -1: none."""
    count, width = near.shape
    out = np.full((count, links), -1, np.int32)
    for at in range(0, count, _BLOCK):
        ids, d = near[at : at + _BLOCK], far[at : at + _BLOCK]
        v = points[np.maximum(ids, 0)]
        norm = (v**2).sum(2)
        apart = norm[:, :, None] + norm[:, None, :] - 2 * (v @ v.transpose(0, 2, 1))
        taken = np.zeros(ids.shape, bool)
        for c in range(width):
            close = (taken & (apart[:, c] <= d[:, c : c + 1])).any(axis=1)
            taken[:, c] = (ids[:, c] >= 0) & ~close & (taken.sum(axis=1) < links)
        order = np.argsort(np.where(taken, 0, np.where(ids >= 0, 1, 2)), axis=1, kind="stable")[:, :links]
        out[at : at + _BLOCK, : order.shape[1]] = np.take_along_axis(ids, order, 1)
    return out


def _nearest_earlier(points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each point its nearest earlier points (ids, squared distances), nearest first."""
    n = len(points)
    ids, far = np.full((n, width), -1, np.int32), np.full((n, width), np.inf, np.float32)
    for at in range(0, n, _BLOCK):
        to = min(n, at + _BLOCK)
        d = _squared(points[at:to], points[:to]).astype(np.float32)
        d[np.arange(to)[None] >= np.arange(at, to)[:, None]] = np.inf
        some = min(width, to)
        pick = np.argpartition(d, some - 1, axis=1)[:, :some]
        pick = np.take_along_axis(pick, np.argsort(np.take_along_axis(d, pick, 1), axis=1, kind="stable"), 1)
        got = np.take_along_axis(d, pick, 1)
        ids[at:to, :some] = np.where(np.isfinite(got), pick, -1)
        far[at:to, :some] = got
    return ids, far


def _level(points: np.ndarray, links: int, most: int) -> np.ndarray:
    """Flat neighbour array (node, most) of one level, nodes in insertion order."""
    n = len(points)
    near, far = _nearest_earlier(points, min(CANDIDATES, max(1, n)))
    ahead = _diverse(points, near, far, links)
    a = np.repeat(np.arange(n), links)
    b = ahead.ravel()
    a, b = a[b >= 0], b[b >= 0]
    source, target = np.concatenate([a, b]), np.concatenate([b, a])
    d = ((points[source] - points[target]) ** 2).sum(1)
    order = np.lexsort((target, d, source))
    source, target, d = source[order], target[order], d[order]
    many = np.bincount(source, minlength=n)
    rank = np.arange(len(source)) - np.repeat(np.cumsum(many) - many, many)
    width = int(min(CANDIDATES, many.max(initial=1)))
    some = rank < width
    ids, gap = np.full((n, width), -1, np.int32), np.full((n, width), np.inf, np.float32)
    ids[source[some], rank[some]] = target[some]
    gap[source[some], rank[some]] = d[some]
    return _diverse(points, ids, gap, most)


@dataclass
class Graph:
    """``nodes[l]``: members of level l; ``links[l]``: their neighbours by place in ``nodes[l]``."""

    points: np.ndarray
    nodes: list[np.ndarray]
    links: list[np.ndarray]

    @classmethod
    def build(cls, points: np.ndarray, links: int = LINKS, seed: int = 11) -> Graph:
        """``points`` in insertion order."""
        rng = np.random.default_rng(seed)
        level = np.floor(-np.log(1 - rng.random(len(points))) / np.log(links)).astype(int)
        nodes, flat = [], []
        for l in range(level.max(initial=0) + 1):
            members = np.flatnonzero(level >= l)
            nodes.append(members.astype(np.int32))
            flat.append(_level(points[members], links, 2 * links if l == 0 else links))
        return cls(points, nodes, flat)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        arrays = {f"n{i}": a for i, a in enumerate(self.nodes)} | {f"l{i}": a for i, a in enumerate(self.links)}
        np.savez(out, points=self.points, **arrays)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Graph:
        with np.load(io.BytesIO(raw)) as z:
            levels = sum(name[0] == "n" for name in z.files)
            return cls(z["points"], [z[f"n{i}"] for i in range(levels)], [z[f"l{i}"] for i in range(levels)])

    def search(self, query: np.ndarray, width: int) -> np.ndarray:
        """Nodes found nearest to the query, best first, ``width`` at most."""
        start = 0
        for l in reversed(range(1, len(self.nodes))):
            if l + 1 < len(self.nodes):
                start = int(np.searchsorted(self.nodes[l], self.nodes[l + 1][start]))
            start = self._walk(l, query, start, 1)[0]
        if len(self.nodes) > 1:
            start = int(self.nodes[1][start])
        return np.array(self._walk(0, query, start, width))

    def _walk(self, l: int, query: np.ndarray, start: int, width: int) -> list[int]:
        nodes, links, points = self.nodes[l], self.links[l], self.points
        seen = np.zeros(len(nodes), bool)
        seen[start] = True
        d = float(((points[nodes[start]] - query) ** 2).sum())
        todo, best = [(d, start)], [(-d, start)]
        while todo:
            d, at = heapq.heappop(todo)
            if len(best) >= width and d > -best[0][0]:
                break
            near = links[at]
            near = near[near >= 0]
            near = near[~seen[near]]
            if not len(near):
                continue
            seen[near] = True
            gaps = ((points[nodes[near]] - query) ** 2).sum(1)
            if len(best) >= width:
                good = gaps < -best[0][0]
                near, gaps = near[good], gaps[good]
            for g, x in zip(gaps.tolist(), near.tolist()):
                if len(best) < width or g < -best[0][0]:
                    heapq.heappush(todo, (g, x))
                    heapq.heappush(best, (-g, x))
                    if len(best) > width:
                        heapq.heappop(best)
        return [x for _, x in sorted((-g, x) for g, x in best)]


def valid_vectors(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part: an id, and finite components that are not all zero."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        rows.select(F.col(vec_id).cast("long").alias("id"), v.alias("v"))
        .where(F.col("id").isNotNull() & F.col("v").isNotNull())
        .where(finite & F.exists("v", lambda x: x != 0))
    )


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def build_index(rows: DataFrame, k: int, shard_rows: int = SHARD_ROWS, links: int = LINKS) -> DataFrame:
    """(shard, dim, graph, vectors, ids) rows: one graph per shard, with the ``k + 1`` smallest ids
    of each distinct vector. ``rows`` as from ``valid_vectors``; vectors of one length share shards."""
    same = Window.partitionBy("v").orderBy("id")
    distinct = (
        rows.distinct()
        .withColumn("r", F.row_number().over(same))
        .where(F.col("r") <= k + 1)
        .groupBy("v")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )
    distinct = _saved(distinct, "vectors")
    shards = max(1, -(-distinct.count() // shard_rows))
    placed = distinct.withColumn("dim", F.size("v")).withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)))

    def build(table: pa.Table) -> pa.Table:
        ids = table.column("ids").to_pylist()
        vectors = _matrix(table.column("v"))
        order = np.argsort([i[0] for i in ids], kind="stable")
        order = order[np.random.default_rng(1).permutation(len(order))]
        vectors, ids = vectors[order], [ids[i] for i in order]
        graph = Graph.build(vectors.astype(np.float32), links)
        return pa.table(
            {
                "shard": pa.array([table.column("shard")[0].as_py()], pa.int64()),
                "dim": pa.array([vectors.shape[1]], pa.int32()),
                "graph": pa.array([graph.to_bytes()], pa.binary()),
                "vectors": pa.array([vectors.tobytes()], pa.binary()),
                "ids": pa.array([ids], pa.list_(pa.list_(pa.int64()))),
            }
        )

    schema = "shard long, dim int, graph binary, vectors binary, ids array<array<bigint>>"
    return _saved(placed.groupBy("shard", "dim").applyInArrow(build, schema), "graphs")


def search(index: DataFrame, queries: DataFrame, k: int, width: int = WIDTH, block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found for each query row (id, v)."""
    queries = queries.distinct()
    blocks = max(1, -(-queries.count() // block))
    spread = (
        queries.withColumn("dim", F.size("v"))
        .withColumn("b", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)))
        .groupBy("dim", "b")
        .agg(F.collect_list(F.struct("id", "v")).alias("q"))
    )
    shards = index.select("shard", "dim").groupBy("dim").agg(F.collect_set("shard").alias("s"))
    met = spread.join(shards, "dim").select("dim", F.explode("s").alias("shard"), "q").join(index, ["shard", "dim"])

    def run(batches):
        held, graph = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i] for j, name in enumerate(batch.schema.names)}
                key = (row["shard"].as_py(), row["dim"].as_py())
                if key != held:
                    graph = Graph.from_bytes(row["graph"].as_py())
                    vectors = np.frombuffer(row["vectors"].as_buffer(), np.float64).reshape(-1, key[1])
                    ids, held = row["ids"].as_py(), key
                out = []
                for q in row["q"].as_py():
                    v = np.array(q["v"])
                    near = graph.search(v.astype(np.float32), max(width, k + 1))
                    exact = np.sqrt(((vectors[near] - v) ** 2).sum(1))
                    # An id with several vectors counts once, with its nearest.
                    found: dict[int, float] = {}
                    for d, j in sorted((float(d), j) for d, n in zip(exact, near) for j in ids[n] if j != q["id"]):
                        found.setdefault(j, d)
                    out += [(q["id"], j, d) for j, d in list(found.items())[:k]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[c] for o in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.float64()))],
                    names=["query_id", "vec_id", "score"],
                )

    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        met.mapInArrow(run, "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id")
        .agg(F.min("score").alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def nearest(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    width: int = WIDTH,
) -> DataFrame:
    """The ``k`` nearest rows found for each query by Euclidean distance in double precision, the
    query's own id left out; ties go to the smaller id; all candidates if there are fewer.

    Vectors that are null, zero or hold null or non-finite components, and rows without id, take no
    part; vectors of different length are not compared; repeated rows count once; a query id with
    several vectors gets one list over all of them; other columns are not read; empty tables give
    no rows."""
    index = build_index(valid_vectors(rows, vec_id, vector), k, shard_rows)
    return search(index, valid_vectors(queries, vec_id, vector), k, width)
