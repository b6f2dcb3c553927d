"""Running totals and exact order statistics without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import materialise

ROWS_PER_BUCKET = 1_000_000


def running_totals(
    df: DataFrame,
    value: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    saved: bool = False,
) -> DataFrame:
    """Add ``cum_<x>`` (total of ``x`` up to and including the row, in ``value`` order within
    ``by``) and ``all_<x>`` (total within ``by``). ``df`` holds one row per ``by`` and ``value``.

    The values are cut into ranges at approximate quantiles, as many as the row count asks for:
    each range is summed on its own and shifted by the totals of the ranges before it. The cut
    points are literals, so both sides of that shift always agree on the ranges, also when tasks
    are run again. ``saved`` rows are not checkpointed first."""
    by, sums = list(by), list(sums)
    df = df if saved else materialise(df)
    rows = df.count()
    buckets = 1 + -(-rows // rows_per_bucket)
    order = F.desc(value) if descending else F.asc(value)
    shares = [i / buckets for i in range(1, buckets)]
    edges = sorted(set(df.approxQuantile(value, shares, 1 / (4 * buckets)))) or [0.0]
    ranges = Bucketizer(
        splits=[float("-inf"), *edges, float("inf")], inputCol="_x", outputCol="_bucket"
    )
    df = ranges.transform(df.withColumn("_x", F.col(value).cast("double"))).drop("_x")
    bucket_order = F.desc("_bucket") if descending else F.asc("_bucket")
    before = Window.partitionBy(*by).orderBy(bucket_order)
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    shifts = (
        df.groupBy(*by, "_bucket")
        .agg(*[F.sum(x).alias(x) for x in sums])
        .select(
            *[F.col(c).alias(f"_by_{c}") for c in by],
            F.col("_bucket").alias("_by_bucket"),
            *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"_before_{x}") for x in sums],
            *[F.sum(x).over(whole).alias(f"all_{x}") for x in sums],
        )
    )
    same = F.col("_bucket") == F.col("_by_bucket")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    upto = Window.partitionBy(*by, "_bucket").orderBy(order)
    upto = upto.rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumns({f"_cum_{x}": F.sum(x).over(upto) for x in sums}).join(shifts, same)
    return out.select(
        *[c for c in df.columns if c != "_bucket"],
        *[(F.col(f"_cum_{x}") + F.col(f"_before_{x}")).alias(f"cum_{x}") for x in sums],
        *[f"all_{x}" for x in sums],
    )


def hash_ranks(
    df: DataFrame,
    digest: Column,
    ties: Sequence[Column],
    by: Sequence[str] = (),
    name: str = "rank",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add the position of each row (from 1) in the order of ``digest``, a hex text, within ``by``;
    equal digests are settled by ``ties``.

    Rows are cut into equal ranges of the digest, one per core at least, ranked inside each, and
    shifted by the sizes of the ranges before. ``df`` should be saved or cheap: it is read twice."""
    by = list(by)
    cores = df.sparkSession.sparkContext.defaultParallelism
    buckets = max(cores, 1 + -(-df.count() // rows_per_bucket))
    head = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    df = df.withColumn("_range", F.floor(head * buckets / F.lit(4294967296)))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_n"))
    shifts = sizes.select(*by, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*by, "_range").orderBy(digest, *ties)
    ranked = df.withColumn("_r", F.row_number().over(inside)).join(shifts, [*by, "_range"])
    return ranked.withColumn(name, F.col("_r") + F.col("_before")).drop("_r", "_before", "_range")


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    by: Sequence[str] = (),
    interpolate: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """One row per ``by`` with one column per entry of ``probs``.

    Counts equal values first (map-side), then finds the ranks in the running count. The
    discrete form returns the smallest value whose cumulative share reaches the probability;
    ``interpolate`` gives the linear form."""
    by = list(by)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counts, value, ["n"], by, rows_per_bucket=rows_per_bucket)
    return ranked.groupBy(*by).agg(*rank_quantiles(value, probs, interpolate))


def rank_quantiles(value: str, probs: dict[str, float], interpolate: bool) -> list[Column]:
    """Quantiles as aggregates over distinct values with ``n``, ``cum_n`` and ``all_n``."""

    def at(rank: Column) -> Column:
        here = (F.col("cum_n") - F.col("n") < rank) & (rank <= F.col("cum_n"))
        return F.max(F.when(here, F.col(value)))

    out = []
    for name, p in probs.items():
        if interpolate:
            place = F.lit(float(p)) * (F.col("all_n") - 1)
            low, high = at(F.floor(place) + 1), at(F.ceil(place) + 1)
            part = F.max(place - F.floor(place))
            out.append((low + (high - low) * part).alias(name))
        else:
            rank = F.greatest(F.lit(1), F.ceil(F.lit(float(p)) * F.col("all_n")))
            out.append(at(rank).alias(name))
    return out
