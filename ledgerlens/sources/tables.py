"""Columnar table sinks and scans, metric files, run history."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schemas
from ledgerlens.session import shuffles_dropped

MONTH_PARTITION = "event_month"
CODEC = "zstd"  # halves hexadecimal hashes, which the default leaves as they are


def overwrite(df: DataFrame, path: str) -> None:
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").parquet(path, compression=CODEC)


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())


def replace_file(spark: SparkSession, source: str, target: str) -> None:
    """Moves a file onto another in one step."""
    rename = spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    moved, files = _files(spark, source)
    files.rename(moved, _files(spark, target)[0], options)


def publish(df: DataFrame, path: str) -> str:
    """Writes a new version of a table beside the old ones and then moves its pointer in one step
    (a rename). Until then, and after a write that fails, readers have the version before. Old
    versions stay until ``forget_versions``. Returns the version's folder."""
    spark = df.sparkSession
    version = f"versao-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.parquet(f"{path}/{version}", compression=CODEC)
    draft = f"{path}/_ponteiro-{version}"
    spark.createDataFrame([(version,)], "versao string").coalesce(1).write.text(draft)
    part = next(f for f in spark.read.text(draft).inputFiles() if "part-" in f)
    replace_file(spark, part, f"{path}/atual")
    return f"{path}/{version}"


def published(spark: SparkSession, path: str) -> str:
    """Folder of the version that the pointer names."""
    return f"{path}/{spark.sparkContext.textFile(f'{path}/atual', 1).first()}"


def read_published(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(published(spark, path))


def forget_versions(spark: SparkSession, path: str) -> int:
    """Deletes all versions but the current one; for when no reader holds an older one."""
    current = published(spark, path).rsplit("/", 1)[1]
    folder, files = _files(spark, path)
    found, gone = files.listStatus(folder), 0
    while found.hasNext():
        entry = found.next().getPath()
        name = entry.getName()
        if name not in (current, "atual") and name.removeprefix("_ponteiro-").startswith("versao-"):
            gone += name.startswith("versao-")
            files.delete(entry, True)
    return gone


def overwrite_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def _month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def overwrite_by_month(
    df: DataFrame, path: str, event_time: str = "event_time", watch: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """One folder per month. The rebalance hint splits a month that holds most rows and
    merges small ones, so files come out evenly sized whatever the distribution. ``watch`` is put
    on the rows as they are written, after the shuffle."""
    rows = df.withColumn(MONTH_PARTITION, _month(F.col(event_time))).hint("rebalance", MONTH_PARTITION)
    with shuffles_dropped(df.sparkSession):
        (
            (watch(rows) if watch else rows)
            .write.mode("overwrite")
            .partitionBy(MONTH_PARTITION)
            .parquet(path, compression=CODEC)
        )


CLUSTER_BITS = 4


def _range_rank(value: Column, cuts: list) -> Column:
    """Number of cut points at or below the value; nulls come first."""
    return sum((F.coalesce(value >= F.lit(c), F.lit(False)).cast("int") for c in cuts), F.lit(0))


def _interleaved(a: Column, b: Column, bits: int) -> Column:
    """The bits of two ranks in turn, the first rank's ahead."""
    out = F.lit(0)
    for i in range(bits):
        out = out + F.shiftleft(F.shiftright(a, i).bitwiseAND(1), 2 * i + 1)
        out = out + F.shiftleft(F.shiftright(b, i).bitwiseAND(1), 2 * i)
    return out


def overwrite_clustered(
    df: DataFrame, path: str, key: str = "customer_hash", event_time: str = "event_time", files: int | None = None, bits: int = CLUSTER_BITS
) -> None:
    """Month folders whose files are laid out along the interleaved range ranks of time and of a
    hexadecimal key, so that both a time range and a key reach few row groups by their statistics.

    The ranks' cut points are sketch quantiles of time within its month and equal parts of the key's
    first eight digits, since a hash is spread evenly. Rows are range-partitioned by month, place
    along the curve, key and time: a key that holds any share of the rows is split by time. Null and
    other keys come first. ``files`` is the number of range partitions (the session's if not given)."""
    month = _month(F.col(event_time))
    since = F.unix_seconds(event_time) - F.unix_seconds(F.date_trunc("month", event_time))
    steps = 1 << bits
    shares = [i / steps for i in range(1, steps)]
    cuts = df.agg(F.percentile_approx(since, shares, 1000).alias("c")).first()["c"] or []
    digits = F.conv(F.regexp_extract(key, "^[0-9a-f]{8}", 0), 16, 10).try_cast("long")
    place = _interleaved(
        _range_rank(digits, [(i << 32) // steps for i in range(1, steps)]), _range_rank(since, cuts), bits
    )
    rows = df.withColumn(MONTH_PARTITION, month).withColumn("_lugar", place)
    order = [MONTH_PARTITION, "_lugar", key, event_time]
    spread = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    placed = spread.sortWithinPartitions(*order).drop("_lugar")
    with shuffles_dropped(df.sparkSession):
        placed.write.mode("overwrite").partitionBy(MONTH_PARTITION).parquet(path, compression=CODEC)


def read_by_month(
    spark: SparkSession,
    path: str,
    before: int | None = None,
    since: int | None = None,
    event_time: str = "event_time",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Scan of a month-partitioned table, limited to epoch seconds ``[since, before)``. With a
    ``schema`` (its folder columns but the month included) a table without files is read as empty.

    The bounds prune folders and reach the Parquet scan as timestamp literals."""
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(MONTH_PARTITION, T.StringType())]))
    df = reader.parquet(path)
    df = df.withColumn(MONTH_PARTITION, F.col(MONTH_PARTITION).cast("string"))
    for bound, keep in ((since, "ge"), (before, "lt")):
        if bound is None:
            continue
        edge = F.timestamp_seconds(F.lit(int(bound)))
        if keep == "ge":
            df = df.filter((F.col(MONTH_PARTITION) >= _month(edge)) & (F.col(event_time) >= edge))
        else:
            df = df.filter((F.col(MONTH_PARTITION) <= _month(edge)) & (F.col(event_time) < edge))
    return df.drop(MONTH_PARTITION)


def write_metrics_csv(metrics: DataFrame, path: str) -> None:
    """Small metric table as one sorted CSV file (one row per model)."""
    (
        metrics.orderBy(F.desc("pr_auc_w"), "modelo")
        .coalesce(1)
        .write.mode("overwrite")
        .csv(path, header=True)
    )


def append_history(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Append retrain rows and return the whole history."""
    rows.select(*schemas.HISTORY.names).write.mode("append").json(path)
    return spark.read.schema(schemas.HISTORY).json(path)


def log_runs(spark: SparkSession, path: str, runs: DataFrame) -> DataFrame:
    """Append run parameters and metrics and return the whole log."""
    runs.select(*schemas.RUNS.names).write.mode("append").parquet(path)
    return spark.read.schema(schemas.RUNS).parquet(path)


def query(spark: SparkSession, text: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """SQL text to DataFrame; ``{name}`` refers to a frame, ``:name`` to an argument."""
    return spark.sql(text, args, **frames)
