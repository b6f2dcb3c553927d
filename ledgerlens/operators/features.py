"""Model inputs: ordinal codes, standard scores, one-hot flags, feature vector.

Categories are looked up by a fitted string indexer (a hash map), numbers by a projection with the
learnt values as literals; both are saved and loaded with the model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.schemas import CATEGORICAL, NUMERIC


@dataclass(frozen=True)
class Encoding:
    """Sorted categories per column, and mean with population deviation per number."""

    categories: dict[str, list[str]]
    moments: dict[str, tuple[float, float]]

    @property
    def columns(self) -> list[str]:
        """Encoded columns in model order: codes first, then scaled numbers."""
        return [f"{c}_cod" for c in self.categories] + [f"{c}_pad" for c in self.moments]

    def stages(self) -> list:
        """Code = position among the sorted categories, -1 when unknown or missing. A constant
        number is centred only."""
        names = list(self.categories)
        made = [
            f"IF(`{c}_pos` >= {len(v)}D, -1D, `{c}_pos`) AS `{c}_cod`"
            for c, v in self.categories.items()
        ] + [
            f"(cast(`{c}` as double) - {mean!r}D) / {std or 1.0!r}D AS `{c}_pad`"
            for c, (mean, std) in self.moments.items()
        ]
        places = ", ".join(f"`{c}_pos`" for c in names)
        kept = f"* EXCEPT ({places})" if names else "*"
        table = SQLTransformer(statement=f"SELECT {', '.join([kept, *made])} FROM __THIS__")
        if not names:
            return [table]
        lookup = StringIndexerModel.from_arrays_of_labels(
            list(self.categories.values()), names, [f"{c}_pos" for c in names], handleInvalid="keep"
        )
        return [lookup, table]

    def apply(self, df: DataFrame) -> DataFrame:
        return PipelineModel(stages=self.stages()).transform(df)


def fit_encoding(
    train: DataFrame,
    categorical: Sequence[str] = CATEGORICAL,
    numeric: Sequence[str] = NUMERIC,
) -> Encoding:
    """Learn from the training part only. The sorted category lists are part of the model, as any
    indexer's labels are."""
    pairs = [F.struct(F.lit(c).alias("coluna"), F.col(c).alias("valor")) for c in categorical]
    found = (
        train.select(F.inline(F.array(*pairs))).filter("valor is not null").distinct().collect()
        if pairs
        else []
    )
    lists = {c: sorted(r["valor"] for r in found if r["coluna"] == c) for c in categorical}
    stats = train.agg(
        *[F.avg(c).alias(f"m_{c}") for c in numeric],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in numeric],
    ).first()
    moments = {c: (float(stats[f"m_{c}"] or 0.0), float(stats[f"s_{c}"] or 0.0)) for c in numeric}
    return Encoding(lists, moments)


def assembler(encoding: Encoding, output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=encoding.columns, outputCol=output, handleInvalid="error")


def one_hot_stages(spark: SparkSession, encoding: Encoding, output: str = "features") -> list:
    """Flags for the known codes (an unknown code sets none), then the numbers as they are.

    The encoder learns its sizes from column metadata, so no pass over the data is needed. With
    ``keep`` and ``dropLast`` every known category has a flag and the invalid level has none."""
    names = list(encoding.categories)
    level = {c: f"IF({c}_cod < 0, {len(v)}D, {c}_cod)" for c, v in encoding.categories.items()}
    levels = SQLTransformer(
        statement="SELECT *, "
        + ", ".join(f"{sql} AS {c}_nivel" for c, sql in level.items())
        + " FROM __THIS__"
    )
    sizes = [
        F.lit(0.0).alias(
            f"{c}_nivel", metadata={"ml_attr": {"type": "nominal", "num_vals": max(1, len(v))}}
        )
        for c, v in encoding.categories.items()
    ]
    encoder = OneHotEncoder(
        inputCols=[f"{c}_nivel" for c in names],
        outputCols=[f"{c}_ind" for c in names],
        dropLast=True,
        handleInvalid="keep",
    ).fit(spark.range(1).select(*sizes))
    vector = VectorAssembler(
        inputCols=[f"{c}_ind" for c in names] + [f"{c}_pad" for c in encoding.moments],
        outputCol=output,
        handleInvalid="error",
    )
    return [levels, encoder, vector]
