"""Audits of a layer: counts, nulls, ranges, duplicates, reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlens.operators.running import rank_quantiles, running_totals
from ledgerlens.session import materialise


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def class_balance(df: DataFrame, target: str = "is_fraud") -> DataFrame:
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null cells of every column, counted in one pass."""
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "coluna", "nulos")


def time_range(df: DataFrame, ts: str = "event_time") -> DataFrame:
    return df.agg(F.min(ts).alias("inicio"), F.max(ts).alias("fim"))


def approx_distinct_ids(df: DataFrame, key: str = "trans_num", rsd: float = 0.05) -> DataFrame:
    """HyperLogLog++ estimate beside the row count. Never use it as a duplicate test."""
    return df.agg(
        F.approx_count_distinct(key, rsd).alias("ids_distintos"), F.count(F.lit(1)).alias("linhas")
    )


def distinct_ids(df: DataFrame, key: str = "trans_num") -> DataFrame:
    return df.agg(F.count_distinct(key).alias("ids_distintos"), F.count(F.lit(1)).alias("linhas"))


def duplicate_ids(df: DataFrame, key: str = "trans_num") -> DataFrame:
    """How many ids occur more than once."""
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return repeated.agg(F.count(F.lit(1)).alias("ids_duplicados"))


def dedup_latest(
    df: DataFrame, key: str = "trans_num", order: Sequence[str] = ("event_time",)
) -> DataFrame:
    """Keep the latest row of each id; equal times are settled by the remaining columns.

    A grouped maximum of the whole row: every map task sends at most one row per id, so an id
    that holds a large share of the table stays cheap. A maximum of a row is planned as a sort
    aggregate: nearly unique ids pay a sort on both sides of the shuffle for that."""
    rest = [c for c in df.columns if c != key and c not in order]
    latest = df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("_row"))
    return latest.select(
        *[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def describe_long(long: DataFrame, by: Sequence[str], interpolate: bool) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of ``valor`` per group.

    The rows are read once, into counts of equal values; everything else comes from those."""
    by = list(by)
    counts = materialise(long.groupBy(*by, "valor").agg(F.count(F.lit(1)).alias("n")))
    # A group that holds nulls only has a row with count 0.
    groups = counts.select(*by).distinct()
    valued = counts.filter("valor is not null").withColumn("s", F.col("valor") * F.col("n"))
    ranked = running_totals(valued, "valor", ["n", "s"], by, saved=True)
    gap = F.col("valor") - F.col("all_s") / F.col("all_n")
    spread = F.try_divide(F.sum(F.col("n") * gap * gap), F.sum("n") - 1)
    described = ranked.groupBy(*by).agg(
        F.sum("n").alias("n"),
        (F.sum("s") / F.sum("n")).alias("media"),
        F.sqrt(spread).alias("desvio"),
        F.min("valor").alias("minimo"),
        F.max("valor").alias("maximo"),
        *rank_quantiles("valor", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, interpolate),
    )
    return groups.join(described, by, "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def as_long(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    wide = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(keep), list(columns), "coluna", "valor")


def numeric_summary(
    df: DataFrame,
    columns: Sequence[str] = ("amt", "age", "distance_km", "city_pop"),
    exact: bool = True,
) -> DataFrame:
    """One row per column. Quartiles are exact by default; otherwise from a bounded sketch."""
    long = as_long(df, columns)
    if exact:
        return describe_long(long, ["coluna"], interpolate=False)
    quartiles = F.percentile_approx("valor", [0.25, 0.5, 0.75], 10_000)
    return (
        long.groupBy("coluna")
        .agg(
            F.count("valor").alias("n"),
            F.avg("valor").alias("media"),
            F.stddev_samp("valor").alias("desvio"),
            F.min("valor").alias("minimo"),
            F.max("valor").alias("maximo"),
            quartiles.alias("_q"),
        )
        .select(
            "coluna", "n", "media", "desvio", "minimo", "maximo",
            *[F.col("_q")[i].alias(f"p{p}") for i, p in enumerate((25, 50, 75))],
        )
    )


def fraud_count_by_table(tables: dict[str, DataFrame], target: str = "is_fraud") -> DataFrame:
    """Size and fraud count of each layer, one scan per layer."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(target) == 1).alias("fraudes")).select(
            F.lit(name).alias("tabela"), "n", "fraudes"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def reconcile_layers(
    bronze: DataFrame,
    train: DataFrame,
    test: DataFrame,
    cutoff: int,
    tolerance: float = 0.05,
) -> DataFrame:
    """One row: frauds preserved, weighted legitimate count restored, no overlap in time."""
    edge = F.timestamp_seconds(F.lit(int(cutoff)))
    legit = F.sum(F.when(F.col("is_fraud") == 0, F.col("sample_weight")).otherwise(0.0))

    def part(df: DataFrame, name: str, extra: Column) -> DataFrame:
        return df.agg(
            F.count_if(F.col("is_fraud") == 1).alias("fraudes"), legit.alias("legitimas"), extra
        ).select(F.lit(name).alias("parte"), "fraudes", "legitimas", "sem_sobreposicao")

    full = bronze.select("is_fraud", F.lit(1.0).alias("sample_weight"))
    parts = (
        part(full, "bronze", F.lit(True).alias("sem_sobreposicao"))
        .unionByName(part(train, "gold", (F.max("event_time") < edge).alias("sem_sobreposicao")))
        .unionByName(part(test, "gold", (F.min("event_time") >= edge).alias("sem_sobreposicao")))
    )

    def total(column: str, name: str) -> Column:
        return F.sum(F.when(F.col("parte") == name, F.col(column)))

    return parts.agg(
        total("fraudes", "bronze").alias("fraudes_bronze"),
        total("fraudes", "gold").alias("fraudes_gold"),
        total("legitimas", "bronze").alias("legitimas_bronze"),
        total("legitimas", "gold").alias("legitimas_restauradas"),
        F.bool_and("sem_sobreposicao").alias("sem_sobreposicao"),
    ).select(
        "*",
        (F.col("fraudes_bronze") == F.col("fraudes_gold")).alias("fraudes_ok"),
        (
            F.abs(F.col("legitimas_restauradas") - F.col("legitimas_bronze"))
            <= tolerance * F.col("legitimas_bronze")
        ).alias("legitimas_ok"),
    )


class Watched:
    """Audit of a table that its write takes along: rows, nulls per column, time range, classes.

    The counts belong to the stage that writes, whose tasks count once however often they are tried,
    so put it on last."""

    def __init__(self, name: str, columns: Sequence[str], event_time: str = "event_time", target: str = "is_fraud"):
        self.name, self.columns, self.event_time, self.target = name, list(columns), event_time, target
        self.seen = Observation(name)

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.observe(
            self.seen,
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col(self.target) == 1).alias("fraudes"),
            F.count_if(F.col(self.target) == 0).alias("legitimas"),
            F.min(self.event_time).alias("inicio"),
            F.max(self.event_time).alias("fim"),
            *[F.count_if(F.col(c).isNull()).alias(f"nulos {c}") for c in self.columns],
        )

    def row(self) -> tuple:
        """(tabela, n, fraudes, legitimas, inicio, fim, nulos) once the table is written."""
        got = self.seen.get
        plain = tuple(got[k] for k in ("n", "fraudes", "legitimas", "inicio", "fim"))
        return self.name, *plain, {c: got[f"nulos {c}"] for c in self.columns}


AUDIT = "tabela string, n long, fraudes long, legitimas long, inicio timestamp, fim timestamp, nulos map<string,long>"
