"""Exact k nearest neighbours over mixed numeric and categorical columns.

Squared distance = sum of squared numeric differences + ``mismatch``² per differing category;
ties (after rounding the square to 9 digits) go to the smaller id. Every coordinate adds on its own,
so the distance to a box (an interval per coordinate) is a lower bound that prunes:

1. Equal points are merged first; each keeps its ``k + 1`` smallest ids, so a point shared by a
   large part of the rows is compared once.
2. A tree of cuts, each of one coordinate at its median over a bounded sample of hash-chosen points,
   deals the points to cells. Only the balance of the cells depends on the sample. A cell that
   holds more than a block is split by hash.
3. Each block finds an upper bound on its points' k-th distance among itself, and sends the
   points, packed with their bounds, to those cells whose box lies within it.
4. Packed points stream past the block they were sent to, which is cut into small boxes of its own;
   only boxes within a point's bound are compared. At most ``k + 1`` neighbours per point return
   (never the pairs themselves); the lists of one point are then merged.

``PivotTree`` and ``_Cells`` bound distances by pivots, for which the metric alone is enough; the
search itself uses the boxes, which prune far more.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import materialise

# Ship the helpers below with the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_POINTS = 4_096
CELL_POINTS = 2_048
LEAF_POINTS = 128
SAMPLE = 16  # sample points a cell
STRIP_POINTS = 256
TIE_DIGITS = 9


def pivot_count(points: int, cell_points: int) -> int:
    """One per ``cell_points`` at first; beyond a million points they follow the square root, where
    the search for a point's pivot and for its neighbours cost about the same."""
    return max(1, min(-(-points // cell_points), math.ceil(2 * math.sqrt(points))))


def squared_distances(a: np.ndarray, b: np.ndarray, numeric: int, mismatch: float) -> np.ndarray:
    """Matrix of squared distances; the first ``numeric`` columns are numbers, the rest codes."""
    out = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        if i < numeric:
            out += (a[:, i, None] - b[None, :, i]) ** 2
        else:
            out += mismatch**2 * (a[:, i, None] != b[None, :, i])
    return out


def _matrix(points) -> np.ndarray:
    return np.array([np.asarray(p, dtype=float) for p in points])


def _within(bound: np.ndarray) -> np.ndarray:
    """The slack covers rounding: rows tied with the k-th distance must be met too."""
    return bound * (1 + 1e-9) + 1e-4


class PivotTree:
    """Pivots grouped around about the square root of their number of heads, with the radius of each
    group; ``counted`` is the number of distances taken."""

    def __init__(self, pivots: np.ndarray, numeric: int, mismatch: float):
        self.pivots, self.numeric, self.mismatch, self.counted = pivots, numeric, mismatch, 0
        self.heads = pivots[: math.ceil(math.sqrt(len(pivots)))]
        far = self.distances(pivots, self.heads)
        self.group = far.argmin(axis=1)
        self.from_head = far[np.arange(len(pivots)), self.group]
        self.members = [np.flatnonzero(self.group == g) for g in range(len(self.heads))]
        self.counted = 0

    def distances(self, points: np.ndarray, others: np.ndarray) -> np.ndarray:
        self.counted += len(points) * len(others)
        return np.sqrt(squared_distances(points, others, self.numeric, self.mismatch))

    def radius(self, extra: np.ndarray | float = 0.0) -> np.ndarray:
        """Per group the largest distance from the head to a pivot, plus ``extra`` of the pivot."""
        reach = self.from_head + extra
        return np.array([reach[m].max(initial=-np.inf) for m in self.members])

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest pivot of each point and its distance."""
        cell, best = np.zeros(len(points), dtype=int), np.full(len(points), np.inf)
        radius = self.radius()
        to_heads = self.distances(points, self.heads)
        first = to_heads.argmin(axis=1)
        for own in (True, False):
            for g, members in enumerate(self.members):
                if own:
                    rows = np.flatnonzero(first == g)
                else:
                    rows = np.flatnonzero((first != g) & (to_heads[:, g] - radius[g] <= best))
                if not len(rows) or not len(members):
                    continue
                row, member, d = self.in_ring(points, rows, members, to_heads[rows, g], best[rows])
                # Per point the nearest of its pairs, which come in the order of the points.
                order = np.lexsort((d, row))
                row, member, d = row[order], member[order], d[order]
                lead = np.concatenate([[True], row[1:] != row[:-1]])[: len(row)]
                row, member, d = row[lead], member[lead], d[lead]
                nearer = d < best[row]
                best[row[nearer]], cell[row[nearer]] = d[nearer], member[nearer]
        return cell, best

    def in_ring(
        self, points: np.ndarray, rows: np.ndarray, members: np.ndarray, to_head: np.ndarray, reach: np.ndarray, extra: np.ndarray | float = 0.0
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, pivot, distance) of the pairs of a point and a pivot of one group whose distances to
        the head differ by ``reach`` plus ``extra`` at most: no others can lie that near."""
        gap = np.abs(to_head[:, None] - self.from_head[members]) - extra
        row, member = np.nonzero(gap <= reach[:, None] + 1e-9)
        row, member = rows[row], members[member]
        self.counted += len(row)
        apart = points[row] - self.pivots[member]
        apart[:, self.numeric :] = self.mismatch * (apart[:, self.numeric :] != 0)
        return row, member, np.sqrt((apart**2).sum(axis=1))


def _distinct_points(rows: DataFrame, k: int) -> DataFrame:
    """One row per point with its ``k + 1`` smallest ids. The rank filter is applied by every
    map task before the shuffle, so no task receives all ids of a frequent point."""
    order = Window.partitionBy("x").orderBy("id")
    first = rows.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k + 1)
    return first.groupBy("x").agg(F.sort_array(F.collect_list("id")).alias("ids"))


class _Cells:
    """Per-cell figures, one entry per pivot."""

    def __init__(self, stats: list, tree: PivotTree, block_points: int):
        n = len(tree.pivots)
        self.tree = tree
        self.ids = np.zeros(n)
        self.low = np.full(n, np.inf)
        self.high = np.full(n, -np.inf)
        self.blocks = np.zeros(n, dtype=int)
        for s in stats:
            self.ids[s["cell"]] = s["ids"]
            self.low[s["cell"]], self.high[s["cell"]] = s["low"], s["high"]
            self.blocks[s["cell"]] = -(-s["points"] // block_points)
        self.reach = tree.radius(self.high)

    def upper_bound(self, d: np.ndarray, some: np.ndarray, need: int) -> np.ndarray:
        """Distance within which whole cells, of those in ``some``, already hold ``need`` ids."""
        held_by = self.ids[some]
        reach = np.where(held_by > 0, d + self.high[some], np.inf)
        order = reach.argsort(axis=1)
        held = held_by[order].cumsum(axis=1)
        at = (held >= need).argmax(axis=1)
        rows = np.arange(len(d))
        found = held[rows, at] >= need
        return np.where(found, reach[rows, order[rows, at]], np.inf)

    def bounds(self, x: np.ndarray, own: int, known: np.ndarray, need: int) -> np.ndarray:
        """Upper bound on the k-th distance: ``known``, or the cells of the own group, or else all."""
        near = self.tree.members[self.tree.group[own]]
        bound = np.minimum(known, self.upper_bound(self.tree.distances(x, self.tree.pivots[near]), near, need))
        open_ = np.flatnonzero(np.isinf(bound))
        if len(open_):
            every = np.arange(len(self.ids))
            bound[open_] = self.upper_bound(self.tree.distances(x[open_], self.tree.pivots), every, need)
        return bound

    def targets(self, x: np.ndarray, own: int, reach: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(cell, rows of x) where the cell can hold a point within the row's reach."""
        to_heads = self.tree.distances(x, self.tree.heads)
        to_own = self.tree.distances(x, self.tree.pivots[[own]])
        for g, members in enumerate(self.tree.members):
            rows = np.flatnonzero(to_heads[:, g] - self.reach[g] <= reach)
            if not len(rows):
                continue
            row, cell, d = self.tree.in_ring(x, rows, members, to_heads[rows, g], reach[rows], self.high[members])
            ring = np.maximum(d - self.high[cell], self.low[cell] - d)
            least = np.maximum(np.maximum(ring, (d - to_own[row, 0]) / 2), 0.0)
            wanted = (least <= reach[row]) & (self.ids[cell] > 0)
            row, cell = row[wanted], cell[wanted]
            for c in np.unique(cell):
                yield int(c), row[cell == c]


def _own_bound(d2: np.ndarray, n_ids: np.ndarray, need: int) -> np.ndarray:
    """Distance at which the members of the own block supply ``need`` ids."""
    near = min(need, d2.shape[1])
    cols = np.argpartition(d2, near - 1, axis=1)[:, :near]
    rows = np.arange(len(d2))[:, None]
    cols = cols[rows, d2[rows, cols].argsort(axis=1)]
    held = n_ids[cols].cumsum(axis=1)
    at = (held >= need).argmax(axis=1)
    flat = rows[:, 0]
    found = held[flat, at] >= need
    return np.where(found, np.sqrt(d2[flat, cols[flat, at]]), np.inf)


def _best_per_query(d2: np.ndarray, reach: np.ndarray, ids: list, need: int):
    """(query, point, id, tie, squared distance) of the ``need`` nearest ids of every query within
    its reach."""
    limit = np.square(reach)
    many = np.flatnonzero((d2 <= limit[:, None]).sum(axis=1) > need)
    if len(many):
        kth = np.partition(d2[many], need - 1, axis=1)[:, need - 1]
        limit[many] = np.minimum(limit[many], kth + 2 * 10.0**-TIE_DIGITS)
    query, point = np.nonzero(d2 <= limit[:, None])
    times = np.array([len(ids[p]) for p in point], dtype=int)
    picked = [i for p in point for i in ids[p]]
    query, point = np.repeat(query, times), np.repeat(point, times)
    gap = d2[query, point]
    frame = pd.DataFrame({"q": query, "p": point, "id": picked, "tie": np.round(gap, TIE_DIGITS), "d2": gap})
    frame = frame.sort_values(["q", "tie", "id"], kind="stable")
    return frame[frame.groupby("q").cumcount() < need]


@dataclass
class Cuts:
    """Binary tree: rows whose coordinate ``axis`` is at most ``cut`` go to ``left``, others to
    ``right``; a node with axis -1 is the cell numbered ``left``."""

    axis: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def cell(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), int)
        while True:
            inner = np.flatnonzero(self.axis[at] >= 0)
            if not len(inner):
                return self.left[at]
            node = at[inner]
            low = x[inner, self.axis[node]] <= self.cut[node]
            at[inner] = np.where(low, self.left[node], self.right[node])


def _cut(x: np.ndarray, numeric: int, mismatch: float) -> tuple[int, float] | None:
    """(coordinate, value) that halves the points where two of them differ most; none if equal."""
    apart = 2 * x.var(axis=0)
    for i in range(numeric, x.shape[1]):
        shares = np.unique(x[:, i], return_counts=True)[1] / len(x)
        apart[i] = mismatch**2 * (1 - (shares**2).sum())
    for axis in np.argsort(-apart, kind="stable"):
        values, counts = np.unique(x[:, axis], return_counts=True)
        if len(values) > 1:
            at = np.abs(2 * counts.cumsum()[:-1] - len(x)).argmin()
            return int(axis), float(values[at])
    return None


def grown_cuts(sample: np.ndarray, numeric: int, mismatch: float, points: int) -> Cuts:
    """Tree whose cells hold at most ``points`` of the sample, unless these are equal."""
    nodes, cells, todo = [[-1, 0.0, 0, 0]], 0, [(0, sample)]
    while todo:
        at, x = todo.pop()
        found = _cut(x, numeric, mismatch) if len(x) > points else None
        if found is None:
            nodes[at][2], cells = cells, cells + 1
            continue
        low = x[:, found[0]] <= found[1]
        nodes[at] = [*found, len(nodes), len(nodes) + 1]
        todo += [(len(nodes) + 1, x[~low]), (len(nodes), x[low])]
        nodes += [[-1, 0.0, 0, 0], [-1, 0.0, 0, 0]]
    axis, cut, left, right = zip(*nodes)
    return Cuts(np.array(axis), np.array(cut), np.array(left), np.array(right))


@dataclass
class Boxes:
    """Smallest and largest coordinates per box, numbers first; ``compared`` counts box distances."""

    low: np.ndarray
    high: np.ndarray
    numeric: int
    mismatch: float
    compared: int = 0

    @classmethod
    def around(cls, x: np.ndarray, parts: list[np.ndarray], numeric: int, mismatch: float) -> Boxes:
        low, high = (np.array([f(x[p], axis=0) for p in parts]) for f in (np.min, np.max))
        return cls(low, high, numeric, mismatch)

    def least(self, low: np.ndarray, high: np.ndarray, some: np.ndarray) -> np.ndarray:
        """Matrix of the smallest squared distances between boxes and those in ``some``."""
        self.compared += len(low) * len(some)
        out = np.zeros((len(low), len(some)))
        for i in range(self.low.shape[1]):
            gap = np.maximum(self.low[some, i] - high[:, i, None], low[:, i, None] - self.high[some, i])
            out += np.square(np.maximum(gap, 0)) if i < self.numeric else self.mismatch**2 * (gap > 0)
        return out

    def most(self, x: np.ndarray) -> np.ndarray:
        """Matrix of the largest squared distances of points to places in the boxes."""
        out = np.zeros((len(x), len(self.low)))
        for i in range(self.low.shape[1]):
            far = np.maximum(np.abs(x[:, i, None] - self.low[:, i]), np.abs(x[:, i, None] - self.high[:, i]))
            out += np.square(far) if i < self.numeric else self.mismatch**2 * (far > 0)
        return out


@dataclass
class BoxCells:
    """Cells with the ids and blocks of each."""

    boxes: Boxes
    ids: np.ndarray
    blocks: np.ndarray

    def bounds(self, x: np.ndarray, known: np.ndarray, need: int) -> np.ndarray:
        """Upper bound on the k-th distance: ``known``, or that of whole cells that hold as many."""
        bound = known.copy()
        open_ = np.flatnonzero(np.isinf(known))
        if len(open_):
            bound[open_] = _own_bound(self.boxes.most(x[open_]), self.ids, need)
        return bound

    def targets(self, x: np.ndarray, reach: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(cell, rows of x) where the cell's box lies within the row's reach."""
        every = np.arange(len(self.ids))
        near = self.boxes.least(x.min(axis=0)[None], x.max(axis=0)[None], every)[0] <= np.square(reach.max())
        some = every[near]
        pairs = []
        for at in range(0, len(x), STRIP_POINTS):
            strip = slice(at, at + STRIP_POINTS)
            row, place = np.nonzero(self.boxes.least(x[strip], x[strip], some) <= np.square(reach[strip])[:, None])
            pairs.append((row + at, some[place]))
        row, cell = (np.concatenate(p) for p in zip(*pairs))
        order = cell.argsort(kind="stable")
        row, cell = row[order], cell[order]
        for part in np.split(np.arange(len(cell)), np.flatnonzero(np.diff(cell)) + 1):
            if len(part):
                yield int(cell[part[0]]), row[part]


class Block:
    """Points of a block, cut into small boxes."""

    def __init__(self, x: np.ndarray, ids: list, numeric: int, mismatch: float):
        self.x, self.ids, self.numeric, self.mismatch = x, ids, numeric, mismatch
        self.parts, todo = [], [np.arange(len(x))]
        while todo:
            rows = todo.pop()
            found = _cut(x[rows], numeric, mismatch) if len(rows) > LEAF_POINTS else None
            if found is None:
                self.parts.append(rows)
            else:
                low = x[rows, found[0]] <= found[1]
                todo += [rows[low], rows[~low]]
        self.boxes = Boxes.around(x, self.parts, numeric, mismatch)

    def distances(self, asked: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """Squared distances, infinite where the box of the point lies beyond the reach."""
        near = self.boxes.least(asked, asked, np.arange(len(self.parts))) <= np.square(reach)[:, None]
        out = np.full((len(asked), len(self.x)), np.inf)
        for i, part in enumerate(self.parts):
            rows = np.flatnonzero(near[:, i])
            if len(rows):
                out[rows[:, None], part] = squared_distances(asked[rows], self.x[part], self.numeric, self.mismatch)
        return out


def _lists(points: np.ndarray) -> pa.Array:
    """Rows of a matrix as an Arrow column of lists."""
    count, width = points.shape
    return pa.ListArray.from_arrays(np.arange(0, (count + 1) * width, width, dtype=np.int32), pa.array(points.ravel()))


def k_nearest(
    rows: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    mismatch: float,
    k: int = 5,
    key: str = "trans_num",
    block_points: int = BLOCK_POINTS,
    cell_points: int = CELL_POINTS,
) -> DataFrame:
    """One row per input row: ``id``, its point ``x`` (numbers, then codes) and ``vizinhos``, an
    array of (tie, id, d2, x) of its ``k`` nearest other rows, nearest first. ``key`` is unique."""
    n_num, need, mismatch = len(numeric), k + 1, float(mismatch)
    coordinates = [F.col(c).cast("double") for c in [*numeric, *categorical]]
    rows = materialise(
        rows.select(F.col(key).cast("string").alias("id"), F.array(*coordinates).alias("x"))
    )
    points = materialise(_distinct_points(rows, k))
    # Nobody is near a point with a missing coordinate.
    known = points.where(~F.exists("x", lambda v: v.isNull() | F.isnan(v)))
    n_cells = pivot_count(known.count(), cell_points)
    chosen = known.orderBy(F.xxhash64("x"), "x").limit(SAMPLE * n_cells).select("x").collect()
    if not chosen:
        return rows.where(F.lit(False)).withColumn(
            "vizinhos", F.expr("cast(array() as array<struct<tie:double,id:string,d2:double,x:array<double>>>)")
        )
    sample = _matrix([c["x"] for c in chosen])
    # A sample of all points must not be cut finer than the cells.
    cuts = grown_cuts(sample, n_num, mismatch, max(SAMPLE, len(sample) // n_cells))

    @F.pandas_udf("int")
    def cell_of(x: pd.Series) -> pd.Series:
        return pd.Series(cuts.cell(_matrix(x)) if len(x) else np.zeros(0, int))

    # Comparing is heavy work on few bytes, so it is dealt to all cores.
    cores = rows.sparkSession.sparkContext.defaultParallelism
    placed = materialise(known.repartition(cores, "x").withColumn("cell", cell_of("x")))
    width = len(coordinates)
    edges = [f(F.col("x")[i]) for f in (F.min, F.max) for i in range(width)]
    stats = placed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("points"), F.sum(F.size("ids")).alias("ids"), F.array(*edges).alias("edges")
    ).orderBy("cell").collect()
    # Cells are numbered anew without the empty ones.
    number = {s["cell"]: i for i, s in enumerate(stats)}
    edges = np.array([s["edges"] for s in stats])
    boxes = Boxes(edges[:, :width], edges[:, width:], n_num, mismatch)
    sizes = np.array([-(-s["points"] // block_points) for s in stats])
    cells = BoxCells(boxes, np.array([s["ids"] for s in stats]), sizes)
    numbers = F.lit([number.get(c, 0) for c in range(int(cuts.left[cuts.axis < 0].max()) + 1)])
    splits = F.element_at(F.lit([int(b) for b in sizes]), F.col("cell") + 1)
    blocks = (
        placed.withColumn("cell", F.element_at(numbers, F.col("cell") + 1))
        .withColumn("part", F.pmod(F.xxhash64("x"), splits).cast("int"))
        .groupBy("cell", "part")
        .agg(F.collect_list(F.struct("x", "ids")).alias("m"))
        .select("cell", "part", F.flatten("m.x").alias("flat"), F.col("m.ids").alias("ids"))
    )
    # Work per block outweighs its bytes, so the task count follows the blocks. No block can
    # become much hotter than another: each is compared with every point at most once.
    tasks = max(cores, int(sizes.sum()))
    blocks = materialise(blocks.repartition(tasks, "cell", "part"))

    def matrix_of(batch: pa.RecordBatch, i: int) -> np.ndarray:
        return batch.column("flat")[i].values.to_numpy(zero_copy_only=False).reshape(-1, width)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x = matrix_of(batch, i)
                n_ids = batch.column("ids")[i].values.value_lengths().to_numpy(zero_copy_only=False)
                # In strips, so that memory does not grow with points times cells.
                reach = np.empty(len(x))
                for at in range(0, len(x), STRIP_POINTS):
                    strip = slice(at, at + STRIP_POINTS)
                    own = _own_bound(squared_distances(x[strip], x, n_num, mismatch), n_ids, need)
                    reach[strip] = _within(cells.bounds(x[strip], own, need))
                for target, rows in cells.targets(x, reach):
                    packed = np.column_stack([x[rows], reach[rows]]).tobytes()
                    parts = int(cells.blocks[target])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([target] * parts, pa.int32()),
                            pa.array(range(parts), pa.int32()),
                            pa.array([packed] * parts, pa.binary()),
                        ],
                        names=["cell", "part", "queries"],
                    )

    queries = blocks.mapInArrow(send, "cell int, part int, queries binary")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            for i in range(batch.num_rows):
                packed = batch.column("queries")[i].as_buffer()
                if packed is None:
                    block = Block(matrix_of(batch, i), batch.column("ids")[i].as_py(), n_num, mismatch)
                    continue
                every = np.frombuffer(packed).reshape(-1, width + 1)
                for at in range(0, len(every), STRIP_POINTS):
                    asked, reach = every[at : at + STRIP_POINTS, :width], every[at : at + STRIP_POINTS, width]
                    best = _best_per_query(block.distances(asked, reach), reach, block.ids, need)
                    if not len(best):
                        continue
                    yield pa.RecordBatch.from_arrays(
                        [
                            _lists(asked[best["q"]]),
                            pa.array(best["tie"].to_numpy()),
                            pa.array(best["d2"].to_numpy()),
                            pa.array(best["id"].tolist(), pa.string()),
                            _lists(block.x[best["p"]]),
                        ],
                        names=["x", "tie", "d2", "id", "nx"],
                    )

    # A block comes before the points sent to it (nulls first), so neither is repeated.
    met = blocks.unionByName(queries, allowMissingColumns=True).repartition(tasks, "cell", "part")
    met = met.sortWithinPartitions("cell", "part", F.col("queries").isNotNull())
    found = met.mapInArrow(meet, "x array<double>, tie double, d2 double, id string, nx array<double>")
    order = Window.partitionBy("x").orderBy("tie", "id")
    lists = (
        found.withColumn("_r", F.row_number().over(order))
        .filter(F.col("_r") <= need)
        .groupBy("x")
        .agg(F.sort_array(F.collect_list(F.struct("tie", "id", "d2", F.col("nx").alias("x")))).alias("v"))
    )
    others = F.filter("v", lambda n: n["id"] != F.col("id"))
    return rows.join(lists, "x").select("id", "x", F.slice(others, 1, k).alias("vizinhos"))
