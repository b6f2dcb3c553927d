"""CSV landing files and their inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schemas
from ledgerlens.session import materialise


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Comma CSV with header. The schema binds by position and a bad cell becomes null."""
    return spark.read.csv(path, schema=schemas.TRANSACTIONS, header=True, enforceSchema=True)


_BROKEN = "_linha"


def read_checked(spark: SparkSession, path: str, schema: T.StructType = schemas.TRANSACTIONS, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows of a CSV with header. Rejected ones have their raw ``linha`` and a
    ``motivo`` per fault: ``coluna: valor`` for a cell that is not of its type, or the number of cells
    where that is wrong. Every row is in exactly one of the two. The files are parsed once, whole, into
    a checkpoint: a reader that is asked for some columns would not look at the others."""
    typed = T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())])
    rows = materialise(
        spark.read.csv(
            path, schema=typed, header=True, sep=sep, enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_BROKEN
        )
    )
    text = ", ".join(f"`{f.name}` string" for f in schema)
    cells = F.from_csv(F.col(_BROKEN), text, {"sep": sep, "mode": "PERMISSIVE"})
    wrong = [
        F.when(
            cells[f.name].isNotNull() & cells[f.name].try_cast(f.dataType).isNull(),
            F.concat(F.lit(f"{f.name}: "), cells[f.name]),
        )
        for f in schema
        if f.dataType != T.StringType()
    ]
    # Text of a type's own form may still be refused by the reader, a lost cell has no form at all.
    reasons = F.array_compact(F.array(*wrong))
    count = F.concat(F.lit("celulas: "), F.size(F.split(F.col(_BROKEN), f"[{sep}]")).cast("string"))
    rejected = rows.where(F.col(_BROKEN).isNotNull()).select(
        F.col(_BROKEN).alias("linha"), F.when(F.size(reasons) > 0, reasons).otherwise(F.array(count)).alias("motivo")
    )
    return rows.where(F.col(_BROKEN).isNull()).drop(_BROKEN), rejected


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-separated CSV with header."""
    return spark.read.csv(path, schema=schemas.CUSTOMERS, header=True, sep="|", enforceSchema=True)


def read_inferred(
    spark: SparkSession, path: str, sep: str = ",", sampling_ratio: float = 1.0
) -> DataFrame:
    """Inspection read. Lower ``sampling_ratio`` to parse fewer lines during inference."""
    return spark.read.csv(
        path, header=True, sep=sep, inferSchema=True, samplingRatio=sampling_ratio
    )


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, filled and empty cells."""
    names = df.columns
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in names]
    )
    entries = [
        F.struct(
            F.lit(i).alias("posicao"),
            F.lit(c).alias("coluna"),
            F.lit(df.schema[c].dataType.simpleString()).alias("tipo"),
            F.col(f"`{c}`").alias("preenchidos"),
            (F.col("_rows") - F.col(f"`{c}`")).alias("nulos"),
        )
        for i, c in enumerate(names)
    ]
    return counted.select(F.inline(F.array(*entries)))


def peek(df: DataFrame, n: int = 1000) -> DataFrame:
    """First rows. Reads only the leading partitions when the schema is explicit."""
    return df.limit(n)


def inventory(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Name and size of each file. File contents are not read: the column is pruned. For rows per
    file see ``rows_per_file``."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(folder)
    )
    return files.select(
        F.regexp_extract("path", "([^/]+)$", 1).alias("arquivo"),
        F.col("length").alias("bytes"),
        F.round(F.col("length") / 1024**3, 3).alias("gb"),
    )


def rows_per_file(rows: DataFrame) -> DataFrame:
    """Rows of each file of a scan, counted map-side."""
    named = rows.select(F.col("_metadata.file_name").alias("arquivo"), F.col("_metadata.file_size").alias("bytes"))
    return named.groupBy("arquivo", "bytes").agg(F.count(F.lit(1)).alias("linhas"))


def missing_files(expected: DataFrame, present: DataFrame, name: str = "arquivo") -> DataFrame:
    """Expected files that have not landed."""
    return expected.select(name).distinct().join(present.select(name).distinct(), name, "left_anti")
