"""Oversampling of the fraud class on encoded features (SMOTE for mixed column types)."""

from __future__ import annotations

from collections.abc import Sequence
from statistics import median

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.neighbours import k_nearest
from ledgerlens.operators.running import hash_ranks
from ledgerlens.session import materialise


def mismatch_distance(minority: DataFrame, numeric: Sequence[str]) -> float:
    """Distance of two different categories: the median deviation of the numeric columns."""
    one = minority.agg(*[F.stddev_pop(c).alias(c) for c in numeric]).first()
    return float(median([one[c] or 0.0 for c in numeric]))


def minority_neighbours(
    minority: DataFrame, numeric: Sequence[str], categorical: Sequence[str], k: int = 5,
    key: str = "trans_num",
) -> DataFrame:
    """(id, posicao, vizinho, distancia): the k nearest other minority rows of every row."""
    nearest = k_nearest(
        minority, numeric, categorical, mismatch_distance(minority, numeric), k, key
    )
    return nearest.select("id", F.posexplode("vizinhos").alias("p", "v")).select(
        F.col("id"),
        (F.col("p") + 1).alias("posicao"),
        F.col("v.id").alias("vizinho"),
        F.sqrt("v.d2").alias("distancia"),
    )


def _coordinate(neighbours: str, i: int) -> Column:
    return F.transform(neighbours, lambda v: v["x"][i])


def _most_common(codes: Column) -> Column:
    """Mode of a short array, the smallest value on ties."""
    votes = F.transform(
        codes,
        lambda c: F.struct(F.size(F.filter(codes, lambda d: d == c)).alias("n"), (-c).alias("menos")),
    )
    return -F.array_max(votes)["menos"]


def own_ids(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(id, columns without the first): a distinct id per row. Equal rows are counted first and laid
    out again with numbers, so no window gathers them."""
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    numbered = counted.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    digest = F.sha2(F.concat_ws("|", *parts, F.col("_i").cast("string")), 256)
    return numbered.select(digest.alias("id"), *columns[1:])


def smotenc(
    train: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    ratio: float = 0.5,
    k: int = 5,
    key: str = "trans_num",
    target: str = "is_fraud",
) -> DataFrame:
    """Encoded training rows plus synthetic frauds, until frauds reach ``ratio`` times the
    legitimate rows. Columns: target, codes, numbers, ``sintetico``.

    A synthetic row lies between a fraud and one of its k nearest frauds; its categories are
    the most common ones among those neighbours. Base, neighbour and position come from the
    hash of id and draw number, so the result does not depend on partitioning. Ids may repeat:
    each fraud gets an id of its own from its key, its values and its number among equal rows.
    Use it on the training part only, after the split."""
    kept = [target, *categorical, *numeric]
    real = train.select(*kept, F.lit(False).alias("sintetico"))
    sizes = train.agg(
        F.count_if(F.col(target) == 0).alias("legit"), F.count_if(F.col(target) == 1).alias("fraud")
    ).first()
    missing = int(ratio * sizes["legit"]) - sizes["fraud"]
    if missing <= 0 or sizes["fraud"] < 2:
        return real

    minority = materialise(own_ids(train.filter(F.col(target) == 1), [key, *categorical, *numeric]))
    each, extra = divmod(missing, sizes["fraud"])
    bases = materialise(
        k_nearest(
            minority, numeric, categorical, mismatch_distance(minority, numeric), k, "id"
        )
    )
    draws = bases.withColumn("n", F.lit(each))
    if extra:
        placed = hash_ranks(bases, F.sha2("id", 256), [F.col("id")])
        draws = placed.withColumn("n", F.lit(each) + (F.col("rank") <= extra).cast("int"))
    draws = draws.filter("n > 0").withColumn("draw", F.explode(F.sequence(F.lit(1), F.col("n"))))
    digest = F.sha2(F.concat_ws("|", "id", F.col("draw").cast("string")), 256)

    def number(start: int) -> Column:
        return F.conv(F.substring(digest, start, 8), 16, 10).cast("long")

    pick = (F.pmod(number(1), F.size("vizinhos")) + 1).cast("int")
    step = number(9) / F.lit(4294967296.0)
    draws = draws.withColumn("step", step).withColumn("mate", F.element_at("vizinhos", pick)["x"])
    columns = []
    for i, name in enumerate([*numeric, *categorical]):
        if i < len(numeric):
            base = F.col("x")[i]
            columns.append((base + F.col("step") * (F.col("mate")[i] - base)).alias(name))
        else:
            columns.append(_most_common(_coordinate("vizinhos", i)).alias(name))
    made = draws.select(F.lit(1).alias(target), *columns, F.lit(True).alias("sintetico"))
    return real.unionByName(made)


def balance_before_after(balanced: DataFrame, target: str = "is_fraud") -> DataFrame:
    """Rows per class before and after oversampling, from one scan of the balanced rows."""
    return balanced.groupBy(target).agg(
        F.count_if(~F.col("sintetico")).alias("antes"), F.count(F.lit(1)).alias("depois")
    )
