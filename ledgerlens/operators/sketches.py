"""Stored sketches, one row per month, that answer questions about the whole table.

A month's row holds a KLL sketch of its event times, an HLL and a theta sketch of its ids. They merge,
so a new month is added by reading that month alone, and a question reads the small store only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.sources.tables import MONTH_PARTITION

KLL_K = 4000  # ranks are off by less than 0.1 per cent of the rows with 99 per cent confidence
HLL_LG = 14  # relative standard error 0.8 per cent
THETA_LG = 14  # entries of a theta sketch, 2^14: fewer ids are counted exactly
RANK_ERROR = 0.002
DISTINCT_ERROR = 0.04


def month_sketches(rows: DataFrame, key: str = "trans_num", event_time: str = "event_time") -> DataFrame:
    """One row per month of ``rows`` (which has the month as a column): rows, extremes, sketches.
    Combined map-side, so a month with most of the rows sends one sketch per task. Null times and ids
    are left out of the sketches, not of the count."""
    seconds = F.unix_seconds(F.col(event_time))
    return rows.groupBy(MONTH_PARTITION).agg(
        F.count(F.lit(1)).alias("n"),
        F.kll_sketch_agg_bigint(seconds, KLL_K).alias("times"),
        F.hll_sketch_agg(key, HLL_LG).alias("ids"),
        F.theta_sketch_agg(key, THETA_LG).alias("id_set"),
    )


def store_months(spark: SparkSession, table: str, store: str, months: Sequence[str] | None = None) -> None:
    """Writes the sketches of a month-partitioned table, or of some of its months: only their folders
    are read and only their rows replaced, so a repeated run changes nothing."""
    rows = spark.read.option("basePath", table).parquet(table)
    rows = rows.withColumn(MONTH_PARTITION, F.col(MONTH_PARTITION).cast("string"))
    if months is not None:
        rows = rows.where(F.col(MONTH_PARTITION).isin(*months))
    (
        month_sketches(rows)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if months is None else "dynamic")
        .partitionBy(MONTH_PARTITION)
        .parquet(store)
    )


def read_store(spark: SparkSession, store: str) -> DataFrame:
    rows = spark.read.option("basePath", store).parquet(store)
    return rows.withColumn(MONTH_PARTITION, F.col(MONTH_PARTITION).cast("string"))


def merged_cutoff(sketches: DataFrame, percentile: float = 0.8) -> DataFrame:
    """Epoch second below which ``percentile`` of the events lie, by rank within ``RANK_ERROR``."""
    whole = F.kll_merge_agg_bigint("times", KLL_K)
    return sketches.agg(F.kll_sketch_get_quantile_bigint(whole, F.lit(float(percentile))).alias("corte"))


def merged_distinct(sketches: DataFrame) -> DataFrame:
    """Estimated distinct ids of all months, within ``DISTINCT_ERROR``, and the exact row count."""
    estimate = F.hll_sketch_estimate(F.hll_union_agg("ids"))
    return sketches.agg(estimate.alias("ids_estimados"), F.sum("n").alias("linhas"))


def returning_ids(sketches: DataFrame) -> DataFrame:
    """Per month the estimated ids that return in a later one, and the standard error of that."""
    later = Window.orderBy(MONTH_PARTITION).rowsBetween(1, Window.unboundedFollowing)
    after = sketches.select(MONTH_PARTITION, "id_set", F.theta_union_agg("id_set", THETA_LG).over(later).alias("_later"))

    def size(sketch: Column) -> Column:
        return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0))

    both = size(F.theta_intersection("id_set", "_later"))
    union = size(F.theta_union("id_set", "_later", F.lit(THETA_LG)))
    return after.select(
        MONTH_PARTITION, both.alias("voltam"), F.sqrt(both * union / 2.0**THETA_LG).alias("erro_padrao")
    )
