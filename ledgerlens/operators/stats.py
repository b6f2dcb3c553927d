"""Correlation, class distributions and density histograms."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import columns as C
from ledgerlens.operators.quality import as_long, describe_long

NUMERIC_AND_TARGET = [
    "amt", "age", "distance_km", "city_pop", "hour", "day_of_week", "month", "is_fraud",
]


def _pearson(x: str, y: str) -> Column:
    """Pearson of two columns that are null on the same rows; null where one is constant."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


PAIR_ROWS = 4


def _pair_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(par, r) for each numbered pair, over the rows where both columns are present.

    One scan: the pairs are dealt to ``PAIR_ROWS`` groups, every row is laid out once per group and
    a group's correlations are summed side by side, map-side. One aggregate over all pairs would
    outgrow generated code; one row per pair would multiply the table by their number."""
    width = -(-len(pairs) // PAIR_ROWS)
    nothing = F.lit(None).cast("double")
    entries = []
    for g in range(-(-len(pairs) // width)):
        fields = [F.lit(g).alias("grupo")]
        for i in range(width):
            x, y = nothing, nothing
            if g * width + i < len(pairs):
                x, y = (F.col(c).cast("double") for c in pairs[g * width + i])
            fields += [F.when(y.isNotNull(), x).alias(f"x{i}"), F.when(x.isNotNull(), y).alias(f"y{i}")]
        entries.append(F.struct(*fields))
    wide = df.select(F.inline(F.array(*entries))).groupBy("grupo")
    found = wide.agg(*[_pearson(f"x{i}", f"y{i}").alias(f"r{i}") for i in range(width)])
    cells = [
        F.struct((F.col("grupo") * width + i).alias("par"), F.col(f"r{i}").alias("r")) for i in range(width)
    ]
    return found.select(F.inline(F.array(*cells))).filter(F.col("par") < len(pairs))


def correlation_matrix(df: DataFrame, columns: Sequence[str] = NUMERIC_AND_TARGET) -> DataFrame:
    """All pairs in one pass over the table, as (linha, coluna, correlacao), both triangles."""
    columns = list(columns)
    pairs = list(combinations(columns, 2))
    by_pair = (
        _pair_correlations(df, pairs)
        .agg(F.map_from_entries(F.collect_list(F.struct("par", "r"))).alias("m"))
    )
    cells = [(c, c, F.lit(1.0)) for c in columns]
    for i, (a, b) in enumerate(pairs):
        r = F.try_element_at("m", F.lit(i))
        cells += [(a, b, r), (b, a, r)]
    rows = [
        F.struct(F.lit(a).alias("linha"), F.lit(b).alias("coluna"), v.alias("correlacao"))
        for a, b, v in cells
    ]
    return by_pair.select(F.inline(F.array(*rows)))


def target_correlation(
    df: DataFrame, columns: Sequence[str] = NUMERIC_AND_TARGET, target: str = "is_fraud"
) -> DataFrame:
    """Correlation of each column with the target, weakest first."""
    others = [c for c in columns if c != target]
    names = F.element_at(F.lit(others), F.col("par") + 1)
    found = _pair_correlations(df, [(c, target) for c in others])
    found = found.select(names.alias("coluna"), F.col("r").alias("correlacao"))
    return found.orderBy(F.abs("correlacao"), "coluna")


def target_distribution(df: DataFrame, target: str = "is_fraud") -> DataFrame:
    """Count, label and percentage of each class."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy()) * 100
    return counts.select(target, "n", C.class_label(target).alias("classe"), share.alias("pct"))


def class_proportion(df: DataFrame, target: str = "is_fraud", digits: int = 4) -> DataFrame:
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy())
    return counts.select(target, F.round(share, digits).alias("proporcao"))


def describe_by_class(
    df: DataFrame, columns: Sequence[str] = ("amt", "distance_km"), target: str = "is_fraud"
) -> DataFrame:
    """Count, mean, deviation, extremes and linear quartiles per class and column."""
    long = as_long(df.withColumn("classe", C.class_label(target)), columns, ["classe"])
    return describe_long(long, ["classe", "coluna"], interpolate=True)


def _density(binned: DataFrame, edges: Column, by: str) -> DataFrame:
    """``binned`` has the class and the bin number; ``edges`` maps both to (inicio, fim)."""
    counts = binned.groupBy(by, "bin").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(by))
    return counts.withColumn("_e", edges).select(
        by,
        "bin",
        F.col("_e.inicio").alias("inicio"),
        F.col("_e.fim").alias("fim"),
        "n",
        F.try_divide(F.col("n"), total * (F.col("_e.fim") - F.col("_e.inicio"))).alias("densidade"),
    )


def log_histogram(
    df: DataFrame, value: str = "amt", edges: int = 50, floor: float = 0.01,
    target: str = "is_fraud",
) -> DataFrame:
    """Density per class over bins of equal ratio, one range for all classes, last bin closed."""
    bins = edges - 1
    df = df.select(C.class_label(target).alias("classe"), F.col(value).cast("double").alias("x"))
    span = df.agg(
        F.struct(
            F.greatest(F.min("x"), F.lit(floor)).alias("lo"), F.max("x").alias("hi")
        ).alias("s")
    ).scalar()
    lo, hi = F.ln(span["lo"]), F.ln(span["hi"])
    place = F.floor(F.try_divide(F.lit(bins) * (F.ln("x") - lo), hi - lo))
    binned = df.filter(F.col("x").between(span["lo"], span["hi"])).withColumn(
        "bin", F.least(F.greatest(F.coalesce(place, F.lit(0)), F.lit(0)), F.lit(bins - 1))
    )
    step = (hi - lo) / bins
    bounds = F.struct(
        F.exp(lo + F.col("bin") * step).alias("inicio"),
        F.exp(lo + (F.col("bin") + 1) * step).alias("fim"),
    )
    return _density(binned, bounds, "classe")


def linear_histogram(
    df: DataFrame, value: str = "distance_km", bins: int = 50, target: str = "is_fraud"
) -> DataFrame:
    """Density per class over bins of equal width, each class with its own range."""
    df = df.select(
        C.class_label(target).alias("classe"), F.col(value).cast("double").alias("x")
    ).filter("classe is not null and x is not null")
    # One entry per class label, so the map has at most as many entries as there are labels.
    spans = (
        df.groupBy("classe")
        .agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("s"))
        .agg(F.map_from_entries(F.collect_list(F.struct("classe", "s"))).alias("m"))
        .scalar()
    )
    span = F.element_at(spans, F.col("classe"))
    width = (span["hi"] - span["lo"]) / bins
    place = F.floor(F.try_divide(F.lit(bins) * (F.col("x") - span["lo"]), span["hi"] - span["lo"]))
    binned = df.withColumn(
        "bin", F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1))
    )
    bounds = F.struct(
        (span["lo"] + F.col("bin") * width).alias("inicio"),
        (span["lo"] + (F.col("bin") + 1) * width).alias("fim"),
    )
    return _density(binned, bounds, "classe")
