"""Incremental ingest of arriving CSV files."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens.plans.etl import latest, to_silver, write_silver
from ledgerlens.sources import tables


def arriving_transactions(
    spark: SparkSession, landing: str, max_files: int | None = None
) -> DataFrame:
    """Stream of landing files in the bronze schema; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(schemas.TRANSACTIONS).option("header", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(landing)


@contextmanager
def _adaptive(batch: DataFrame) -> Iterator[None]:
    """Adaptive execution for the writes of a micro-batch. A stream with state turns it off in its own
    session, and without it the month layout is not rebalanced: every task would write a file a month."""
    conf, key = batch.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        yield
    finally:
        conf.set(key, before)


def ingest_available(
    spark: SparkSession,
    landing: str,
    output: str,
    checkpoint: str,
    max_files: int | None = None,
    salt: str | None = None,
    bronze: str | None = None,
    deduplicate: bool = False,
) -> DataFrame:
    """Append every file that has not been ingested yet, then stop: raw rows to ``bronze`` if given,
    silver rows to ``output`` in the month layout of the batch job.

    The checkpoint remembers the files, so a run after a failure goes on where it stopped. Each
    micro-batch has a folder of its own, which a repeated batch overwrites, so no row is written
    twice. ``deduplicate`` keeps the latest row of each id within a micro-batch; for ids that return
    in a later one see ``ingest_first``."""

    def write(batch: DataFrame, number: int) -> None:
        if bronze:
            tables.overwrite(batch, f"{bronze}/lote={number}")
            batch = spark.read.schema(schemas.TRANSACTIONS).parquet(f"{bronze}/lote={number}")
        with _adaptive(batch):
            if deduplicate:
                tables.overwrite_by_month(latest(to_silver(batch, salt=salt)), f"{output}/lote={number}")
            else:
                write_silver(batch, f"{output}/lote={number}", salt)

    query = (
        arriving_transactions(spark, landing, max_files)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return tables.read_by_month(spark, output).select(*schemas.SILVER.names)


def key_digest(rows: DataFrame, keys: Sequence[str]) -> Column:
    """SHA-256 of the keys, each with its length, so that no two lists of values share a text; nulls
    are equal to one another, as are the two zeros."""
    numbers = {f.name for f in rows.schema if f.dataType.typeName() in ("double", "float")}
    texts = [(F.col(k) + 0.0 if k in numbers else F.col(k)).cast("string") for k in keys]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def ingest_first(
    spark: SparkSession,
    landing: str,
    output: str,
    checkpoint: str,
    keys: Sequence[str] = ("trans_num",),
    remembered: str = "30 days",
    max_files: int | None = None,
    salt: str | None = None,
) -> DataFrame:
    """Like ``ingest_available``, but a row whose ``keys`` have arrived before is dropped, also when
    that was in an earlier micro-batch or run: the first arrival stays.

    The keys are keyed state of the stream, remembered for that long after their file's arrival. The
    watermark is on the arrival of files, which are read in that order, so no row comes too late,
    however old its event. State is bounded by the distinct keys that arrive within the time: about
    the bytes of the key and 100 more each, spread over the shuffle partitions; several keys are
    remembered as one SHA-256 of 32 bytes (``key_digest``). Of rows with equal
    keys in one micro-batch any one stays; give all columns as keys to drop equal rows only."""

    def write(batch: DataFrame, number: int) -> None:
        with _adaptive(batch):
            write_silver(batch, f"{output}/lote={number}", salt)

    arriving = arriving_transactions(spark, landing, max_files)
    stamped = arriving.select("*", F.col("_metadata.file_modification_time").alias("_chegada"))
    if len(keys) > 1:
        stamped, keys = stamped.withColumn("_chave", key_digest(stamped, keys)), ["_chave"]
    query = (
        stamped.withWatermark("_chegada", remembered)
        .dropDuplicatesWithinWatermark(list(keys))
        .drop("_chegada", "_chave")
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return tables.read_by_month(spark, output).select(*schemas.SILVER.names)


_MONTHS = "mes timestamp, atrasada boolean, n long, fraudes long, ultimo timestamp"


def monthly_available(
    spark: SparkSession,
    landing: str,
    output: str,
    checkpoint: str,
    delay: str = "31 days",
    max_files: int | None = None,
) -> DataFrame:
    """Fraud rate per month of everything that has arrived: ``mes``, ``n``, ``fraudes``, ``taxa`` and
    ``atrasadas``, the rows whose event lay more than ``delay`` before the latest event of earlier
    micro-batches. Late rows count like any other and are reported apart.

    Each micro-batch adds one small file of sums per month, in a folder of its own that a repeated
    batch overwrites; the report adds them up. A batch reads the latest event of the batches before
    it from those files, so it gives the same sums when it is repeated after a failure. Rows without
    event time have a month of null and are never late."""

    def write(batch: DataFrame, number: int) -> None:
        # Only earlier batches count: later ones may be there when this one is repeated.
        done = _sums(spark, output).where(F.col("lote") < number).agg(F.max("ultimo").alias("u"))
        edge = done.select(F.col("u") - F.expr(f"INTERVAL {delay}")).first()[0]
        rows = to_silver(batch, ["event_time", "is_fraud"])
        late = F.coalesce(F.col("event_time") < F.lit(edge).cast("timestamp"), F.lit(False))
        sums = rows.groupBy(F.date_trunc("month", "event_time").alias("mes"), late.alias("atrasada")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("is_fraud").alias("fraudes"), F.max("event_time").alias("ultimo")
        )
        tables.overwrite(sums.coalesce(1), f"{output}/lote={number}")

    query = (
        arriving_transactions(spark, landing, max_files)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    months = _sums(spark, output).groupBy("mes").agg(
        F.sum("n").alias("n"),
        F.sum("fraudes").alias("fraudes"),
        F.sum(F.when(F.col("atrasada"), F.col("n")).otherwise(0)).alias("atrasadas"),
    )
    rate = F.try_divide("fraudes", "n")
    return months.select("mes", "n", "fraudes", rate.alias("taxa"), "atrasadas").orderBy("mes")


def _sums(spark: SparkSession, output: str) -> DataFrame:
    """Sums of all micro-batches; none before the first."""
    try:
        return spark.read.schema(_MONTHS).option("basePath", output).parquet(f"{output}/lote=*").select(
            "*", F.col("_metadata.file_path").alias("_p")
        ).withColumn("lote", F.regexp_extract("_p", "lote=([0-9]+)", 1).cast("long")).drop("_p")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{_MONTHS}, lote long")
