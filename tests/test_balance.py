from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import balance, neighbours
from ledgerlens.operators.neighbours import k_nearest

NUM, CAT = ["a", "b"], ["c"]


def brute_force(rows, mismatch, k):
    out = {}
    for i, a, b, c in rows:
        ranked = sorted(
            (round((a - x) ** 2 + (b - y) ** 2 + mismatch**2 * (c != z), 9), j)
            for j, x, y, z in rows
            if j != i
        )
        out[i] = [j for _, j in ranked[:k]]
    return out


def make_rows(n, seed=1):
    """A third of the rows share one point, a third lie in a tight ball, the rest spread out."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            a, b, c = 0.5, 0.5, 1.0
        elif i % 3 == 1:
            a, b = (0.001 * rng.standard_normal(2)).tolist()
            c = float(i % 2)
        else:
            a, b = rng.integers(-3, 4, 2).astype(float).tolist()
            c = float(rng.integers(3))
        rows.append((f"id{i:04d}", a, b, c))
    return rows


@pytest.mark.parametrize("block,cell", [(2048, 512), (16, 40), (5, 7)])
def test_equals_brute_force(spark, block, cell):
    rows = make_rows(300)
    df = spark.createDataFrame(rows, "id string, a double, b double, c double")
    got = k_nearest(df, NUM, CAT, 0.7, 5, "id", block_points=block, cell_points=cell)
    want = brute_force(rows, 0.7, 5)
    found = {r["id"]: [v["id"] for v in r["vizinhos"]] for r in got.collect()}
    assert found == want


def test_pivots_grow_with_the_points():
    counts = [neighbours.pivot_count(n, 512) for n in (1, 1_000, 10**6, 10**8)]
    assert counts == [1, 2, 1_954, 20_000]


def test_fewer_rows_than_neighbours(spark):
    rows = make_rows(3)
    df = spark.createDataFrame(rows, "id string, a double, b double, c double")
    got = k_nearest(df, NUM, CAT, 0.7, 5, "id")
    assert {r["id"]: [v["id"] for v in r["vizinhos"]] for r in got.collect()} == brute_force(rows, 0.7, 5)
    assert k_nearest(df.filter(F.lit(False)), NUM, CAT, 0.7, 5, "id").count() == 0


def test_frequent_point_is_limited_before_the_shuffle(spark):
    df = spark.createDataFrame(make_rows(300), "id string, a double, b double, c double")
    points = neighbours._distinct_points(df.select("id", F.array("a", "b", "c").alias("x")), 5)
    plan = points._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert points.agg(F.max(F.size("ids"))).first()[0] == 6


@pytest.fixture(scope="module")
def train(spark):
    frauds = [(i, a, b, c, 1) for i, a, b, c in make_rows(40)]
    legit = [(f"z{i}", 9.0 + i, 9.0, 5.0, 0) for i in range(301)]
    return spark.createDataFrame(frauds + legit, "id string, a double, b double, c double, is_fraud int")


def test_smotenc_reaches_the_ratio_within_the_minority(train):
    out = balance.smotenc(train, NUM, CAT, 0.5, 5, "id").toPandas()
    assert (out.is_fraud == 1).sum() == 150 and (out.is_fraud == 0).sum() == 301
    made = out[out.sintetico]
    assert len(made) == 110 and (made.is_fraud == 1).all()
    real = out[~out.sintetico & (out.is_fraud == 1)]
    for c in NUM:
        assert made[c].between(real[c].min(), real[c].max()).all()
    assert set(made.c) <= set(real.c)


def test_smotenc_does_not_depend_on_partitioning(train):
    def run(n):
        out = balance.smotenc(train.repartition(n), NUM, CAT, 0.5, 5, "id")
        return sorted(map(tuple, out.collect()))

    assert run(1) == run(6)


def test_smotenc_leaves_a_balanced_set_alone(train):
    frauds = train.filter("is_fraud = 1")
    assert balance.smotenc(frauds, NUM, CAT, 0.5, 5, "id").filter("sintetico").count() == 0


def test_mode_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([([2.0, 1.0, 2.0, 1.0, 3.0],), ([4.0],)], "v array<double>")
    assert [r[0] for r in df.select(balance._most_common(F.col("v"))).collect()] == [1.0, 4.0]


def test_repeated_ids_are_told_apart(spark, train):
    """Frauds that share an id, some of them equal in every column."""
    frauds = train.filter("is_fraud = 1").withColumn("id", F.lit("same"))
    rows = train.filter("is_fraud = 0").unionByName(frauds).unionByName(frauds.limit(5))

    def run(n):
        return balance.smotenc(rows.repartition(n), NUM, CAT, 0.5, 5, "id")

    out = run(3).toPandas()
    assert (out.is_fraud == 1).sum() == 150 and out.sintetico.sum() == 105
    made = out[out.sintetico]
    assert made[NUM].drop_duplicates().shape[0] > 40
    assert sorted(map(tuple, run(1).collect())) == sorted(map(tuple, run(7).collect()))


def _pivot_distances(n):
    """Distances to pivots that placing n clustered points and choosing the cells they meet take."""
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((300, 6)) * 20
    points = centres[rng.integers(0, 300, n)] + rng.standard_normal((n, 6)) * 0.3
    pivots = points[: neighbours.pivot_count(n, 1)]
    tree = neighbours.PivotTree(pivots, 6, 1.0)
    cell, r = tree.nearest(points)
    far = neighbours.squared_distances(points[:500], pivots, 6, 1.0)
    assert np.allclose(np.sqrt(far.min(axis=1)), r[:500]) and (np.sqrt(far[np.arange(500), cell[:500]]) == r[:500]).all()
    stats = pd.DataFrame({"cell": cell, "r": r}).groupby("cell")["r"].agg(["size", "min", "max"]).reset_index()
    stats = [{"cell": s["cell"], "points": s["size"], "ids": s["size"], "low": s["min"], "high": s["max"]} for s in stats.to_dict("records")]
    cells = neighbours._Cells(stats, tree, 2048)
    for c in np.unique(cell):
        x = points[cell == c]
        own = neighbours._own_bound(neighbours.squared_distances(x, x, 6, 1.0), np.ones(len(x)), 6)
        for _ in cells.targets(x, c, neighbours._within(cells.bounds(x, c, own, 6))):
            pass
    return tree.counted


def test_pivot_distances_grow_below_points_times_pivots():
    few, many = _pivot_distances(8_000), _pivot_distances(32_000)
    print("distances to pivots", few, many, many / few)
    assert many < 6 * few
    assert many < 32_000 * neighbours.pivot_count(32_000, 1)


def _met_per_point(n):
    """Points that a point meets, on evenly filled dimensions, where pivots pruned little."""
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.random((n, 5)), rng.integers(0, 4, (n, 2))])
    cuts = neighbours.grown_cuts(x[::4], 5, 0.5, 32)
    parts = [np.flatnonzero(cuts.cell(x) == c) for c in np.unique(cuts.cell(x))]
    sizes = np.array([len(p) for p in parts])
    cells = neighbours.BoxCells(neighbours.Boxes.around(x, parts, 5, 0.5), sizes, np.ones(len(parts), int))
    met, some = 0, parts[:: len(parts) // 20]
    for p in some:
        own = neighbours._own_bound(neighbours.squared_distances(x[p], x[p], 5, 0.5), np.ones(len(p)), 6)
        reach = neighbours._within(cells.bounds(x[p], own, 6))
        for c, rows in cells.targets(x[p], reach):
            block = neighbours.Block(x[parts[c]], [], 5, 0.5)
            d2 = block.distances(x[p][rows], reach[rows])
            met += np.isfinite(d2).sum()
            near = neighbours.squared_distances(x[p][rows], x[parts[c]], 5, 0.5) <= np.square(reach[rows])[:, None]
            assert np.isfinite(d2[near]).all()
    return met / sum(len(p) for p in some)


def test_points_met_grow_slower_than_the_points():
    few, many = _met_per_point(8_000), _met_per_point(64_000)
    print("points met by a point", few, many)
    assert many < 2 * few and many < 64_000 / 20


def test_rows_with_a_missing_coordinate_have_no_neighbours(spark):
    rows = make_rows(60)
    odd = [("odd1", None, 0.5, 1.0), ("odd2", 0.5, float("nan"), 1.0)]
    df = spark.createDataFrame(rows + odd, "id string, a double, b double, c double")
    got = k_nearest(df, NUM, CAT, 0.7, 5, "id", block_points=8, cell_points=10)
    assert {r["id"]: [v["id"] for v in r["vizinhos"]] for r in got.collect()} == brute_force(rows, 0.7, 5)
