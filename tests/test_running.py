from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.running import exact_quantiles, hash_ranks, running_totals


def frame(spark):
    """A third of the rows share one group; values are skewed towards zero."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"),
        F.exp(-(F.col("id") % 701) / 30.0).alias("v"),
    )


@pytest.mark.parametrize("descending", [False, True])
def test_ranges_agree_with_the_plain_window(spark, descending):
    counts = frame(spark).groupBy("g", "v").agg(F.count("*").alias("n"))
    plain = running_totals(counts, "v", ["n"], ["g"], descending)
    cut = running_totals(counts, "v", ["n"], ["g"], descending, rows_per_bucket=100)
    assert "_bucket" not in cut.columns and sorted(cut.columns) == sorted(plain.columns)
    names = plain.columns
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, cut.select(*names).collect()))


def test_ranges_without_groups(spark):
    counts = frame(spark).groupBy("v").agg(F.count("*").alias("n"))
    plain = running_totals(counts, "v", ["n"])
    cut = running_totals(counts, "v", ["n"], rows_per_bucket=50)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, cut.select(*plain.columns).collect()))


@pytest.mark.parametrize("size", [10**6, 70])
def test_quantiles_equal_numpy(spark, size):
    rows = frame(spark)
    values = rows.toPandas()
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.8, "e": 1.0}
    got = exact_quantiles(rows, "v", probs, ["g"], interpolate=True, rows_per_bucket=size)
    for row in got.collect():
        v = values.loc[values.g == row["g"], "v"]
        assert np.allclose([row[k] for k in probs], np.quantile(v, list(probs.values())))
    disc = exact_quantiles(rows, "v", probs, rows_per_bucket=size).first()
    want = np.quantile(values.v, list(probs.values()), method="inverted_cdf")
    assert [disc[k] for k in probs] == list(want)


@pytest.mark.parametrize("size", [10**6, 40])
def test_hash_ranks_are_positions_in_hash_order(spark, size):
    rows = spark.range(700).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("g"))
    digest = F.sha2(F.col("id").cast("string"), 256)
    for by in ([], ["g"]):
        got = hash_ranks(rows, digest, [F.col("id")], by, rows_per_bucket=size).withColumn("d", digest).collect()
        groups = {}
        for r in sorted(got, key=lambda r: r["d"]):
            groups.setdefault(r["g"] if by else "", []).append(r["rank"])
        assert all(g == list(range(1, len(g) + 1)) for g in groups.values()) and len(got) == 700


def test_ranks_are_taken_on_several_cores(spark):
    rows = spark.range(2000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("d"))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    kept = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        ranked = hash_ranks(rows, F.col("d"), [F.col("id")]).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set(setting, kept)
    assert [r["rank"] for r in sorted(ranked, key=lambda r: r["d"])] == list(range(1, 2001))
    assert len({r["task"] for r in ranked}) > 2
