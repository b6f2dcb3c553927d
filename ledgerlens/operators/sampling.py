"""Time split and samples. Choices depend on ids, never on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import columns as C
from ledgerlens.operators.running import exact_quantiles

HASH_SLICES = 65_536


def time_cutoff_frame(df: DataFrame, p: float = 0.8, ts: str = "event_time") -> DataFrame:
    """Exact discrete percentile of the event time in epoch seconds, as one row."""
    seconds = df.select(C.epoch_seconds(ts).alias("event_ts"))
    return exact_quantiles(seconds, "event_ts", {"corte": p})


def time_cutoff(
    df: DataFrame, p: float = 0.8, ts: str = "event_time", relative_error: float = 0.0
) -> int:
    """The cutoff as a number for the split filters. A positive ``relative_error`` uses the
    bounded quantile sketch instead of exact ranks. 0 where there are no times."""
    if relative_error > 0:
        seconds = df.select(C.epoch_seconds(ts).alias("event_ts"))
        found = seconds.approxQuantile("event_ts", [p], relative_error)
        return int(found[0]) if found else 0
    return int(time_cutoff_frame(df, p, ts).first()["corte"] or 0)


def time_split(df: DataFrame, cutoff: int, ts: str = "event_time") -> tuple[DataFrame, DataFrame]:
    """Rows before the cutoff and rows from it on. The bound is a timestamp literal, so it is
    pushed into the table scan."""
    edge = F.timestamp_seconds(F.lit(int(cutoff)))
    return df.filter(F.col(ts) < edge), df.filter(F.col(ts) >= edge)


def kept(fraction: float, key: str = "trans_num", target: str = "is_fraud") -> Column:
    """Every fraud and the given share of the legitimate rows."""
    return (F.col(target) == 1) | ((F.col(target) == 0) & (C.hash_fraction(key) < fraction))


def stratified_sample(
    df: DataFrame,
    fraction: float,
    key: str = "trans_num",
    target: str = "is_fraud",
    method: str = "hash",
    seed: int = 42,
) -> DataFrame:
    """``hash`` is stable under any partitioning; ``bernoulli`` draws by row position."""
    if method == "bernoulli":
        return df.sampleBy(target, fractions={0: fraction, 1: 1.0}, seed=seed)
    return df.filter(kept(fraction, key, target))


def sample_weights(df: DataFrame, fraction: float, target: str = "is_fraud") -> DataFrame:
    """Weight that restores the original class proportion."""
    weight = F.when(F.col(target) == 0, F.lit(1 / fraction)).otherwise(F.lit(1.0))
    return df.withColumn("sample_weight", weight)


def fixed_n_sample(df: DataFrame, n: int, key: str = "trans_num") -> DataFrame:
    """The ``n`` rows with the smallest id hash; rows that share an id are settled by the other
    columns.

    One pass counts the rows per slice of the hash range. The leading slices that hold fewer than
    ``n`` rows between them are taken whole; only the slice that fills the number is sorted."""
    slices = df.groupBy(F.floor(C.hash_fraction(key) * HASH_SLICES).alias("slice")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    # At most HASH_SLICES rows (and one for missing ids) pass through this window.
    upto = Window.partitionBy().orderBy(F.asc_nulls_last("slice"))
    held = slices.withColumn("held", F.sum("rows").over(upto)).filter(F.col("held") >= n)
    last = held.orderBy(F.asc_nulls_last("slice")).first()
    if last is None:
        return df
    fraction = C.hash_fraction(key)
    if last["slice"] is None:
        whole, edge = df.filter(fraction.isNotNull()), df.filter(fraction.isNull())
    else:
        low, high = last["slice"] / HASH_SLICES, (last["slice"] + 1) / HASH_SLICES
        whole, edge = df.filter(fraction < low), df.filter((fraction >= low) & (fraction < high))
    digest = F.sha2(F.col(key).cast("string"), 256)
    order = [digest, F.col(key), *[F.col(c) for c in df.columns if c != key]]
    room = n - (last["held"] - last["rows"])
    return whole.unionByName(edge.orderBy(*[F.asc_nulls_last(c) for c in order]).limit(room))
