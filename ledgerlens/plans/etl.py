"""Bronze to silver to gold."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schemas
from ledgerlens.functions import columns as C
from ledgerlens.operators import quality, sampling
from ledgerlens.session import materialise, require_utc
from ledgerlens.sources import landing, ledger, tables

# Raw columns each silver column is made from.
SILVER_INPUTS = {
    "trans_num": ["trans_num"],
    "customer_hash": ["cc_num"],
    "event_time": ["trans_date", "trans_time"],
    "amt": ["amt"],
    "category": ["category"],
    "merchant": ["merchant"],
    "state": ["state"],
    "city_pop": ["city_pop"],
    "gender": ["gender"],
    "job": ["job"],
    "age": ["trans_date", "trans_time", "dob"],
    "distance_km": ["lat", "long", "merch_lat", "merch_long"],
    "hour": ["trans_date", "trans_time"],
    "day_of_week": ["trans_date", "trans_time"],
    "month": ["trans_date", "trans_time"],
    "is_fraud": ["is_fraud"],
}


LANDED = "*.csv{,.gz}"  # names of landing files


@dataclass(frozen=True)
class EtlConfig:
    """Switches and fractions of the job. ``landing_*`` are needed only to rebuild bronze."""

    root: str
    landing_transactions: str | None = None
    landing_customers: str | None = None
    rebuild_bronze: bool = False
    deduplicate: bool = False
    train_fraction: float = 0.02
    test_fraction: float = 0.05
    cutoff_percentile: float = 0.8
    cutoff_error: float = 0.001
    salt: str | None = None

    def path(self, layer: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}"


def to_silver(
    bronze: DataFrame, columns: Sequence[str] = tuple(schemas.SILVER.names), salt: str | None = None
) -> DataFrame:
    """Typed, enriched and de-identified transactions: one projection, no shuffle."""
    columns = list(columns)
    timed = {"event_time", "age", "hour", "day_of_week", "month"} & set(columns)
    if timed:
        bronze = bronze.withColumn("event_time", C.event_time())
    made = {"customer_hash": C.hashed("cc_num", salt)}
    if "age" in columns:
        made["age"] = C.age_at("event_time", "dob")
    if "distance_km" in columns:
        made["distance_km"] = C.haversine_km("lat", "long", "merch_lat", "merch_long")
    if timed:
        made |= C.calendar_features("event_time")
    return bronze.select(*[made[c].alias(c) if c in made else F.col(c) for c in columns])


def unhashed(bronze: DataFrame) -> DataFrame:
    """Silver rows with the card number in place of its hash, which is eight times as long and hardly
    compresses: for rows on their way. ``with_hash`` makes them silver."""
    return to_silver(bronze, ["cc_num" if c == "customer_hash" else c for c in schemas.SILVER.names])


def with_hash(rows: DataFrame, salt: str | None = None) -> DataFrame:
    hashed = C.hashed("cc_num", salt).alias("customer_hash")
    return rows.select(*[hashed if c == "cc_num" else F.col(c) for c in rows.columns])


def latest(rows: DataFrame) -> DataFrame:
    """``dedup_latest`` of silver rows. Card hashes travel as the bytes that their digits stand for: half
    as long, same order."""
    packed = rows.withColumn("customer_hash", F.unhex("customer_hash"))
    return quality.dedup_latest(packed).withColumn("customer_hash", F.lower(F.hex("customer_hash")))


def write_silver(bronze: DataFrame, path: str, salt: str | None = None, watch: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Silver in the month layout; card numbers are hashed after the shuffle, before the write."""

    def finish(rows: DataFrame) -> DataFrame:
        done = with_hash(rows, salt)
        return watch(done) if watch else done

    tables.overwrite_by_month(unhashed(bronze), path, watch=finish)


def to_gold(
    silver: DataFrame, cutoff: int, train_fraction: float = 0.02, test_fraction: float = 0.05
) -> tuple[DataFrame, DataFrame]:
    """Split in time first, then sample each side and add its weights."""
    before, after = sampling.time_split(silver, cutoff)
    train = sampling.stratified_sample(before, train_fraction)
    test = sampling.stratified_sample(after, test_fraction)
    return (
        sampling.sample_weights(train, train_fraction),
        sampling.sample_weights(test, test_fraction),
    )


def build_bronze(spark: SparkSession, cfg: EtlConfig) -> None:
    tables.overwrite(
        landing.read_transactions(spark, cfg.landing_transactions), cfg.path("bronze/transactions")
    )
    if cfg.landing_customers:
        tables.overwrite(
            landing.read_customers(spark, cfg.landing_customers), cfg.path("bronze/customers")
        )


def _publish_gold(cutoff: int, cfg: EtlConfig, rows: Callable[..., DataFrame]) -> list[quality.Watched]:
    """Publishes both gold tables of the silver rows that ``rows(before=, since=)`` reads."""
    halves = {
        "train": (rows(before=cutoff), cfg.train_fraction),
        "test": (rows(since=cutoff), cfg.test_fraction),
    }
    audits = []
    for name, (half, fraction) in halves.items():
        kept = sampling.stratified_sample(half, fraction)
        audits.append(quality.Watched(name, schemas.GOLD.names))
        tables.publish(audits[-1](sampling.sample_weights(kept, fraction)), cfg.path(f"gold/{name}"))
    return audits


def run_etl(spark: SparkSession, cfg: EtlConfig) -> DataFrame:
    """Write every layer and return its audit: rows, frauds, legitimate rows, time range and nulls per
    column, counted by the writes themselves, without a further scan. Each layer is read back from
    its table, so a lost executor repeats one layer at most. The gold tables are published: readers
    keep the version before until the new one is whole."""
    require_utc(spark)
    if cfg.rebuild_bronze:
        build_bronze(spark, cfg)
    bronze = spark.read.schema(schemas.TRANSACTIONS).parquet(cfg.path("bronze/transactions"))
    path = cfg.path("silver/transactions")
    audits = [quality.Watched("silver", schemas.SILVER.names)]
    if cfg.deduplicate:
        tables.overwrite_by_month(latest(to_silver(bronze, salt=cfg.salt)), path, watch=audits[0])
    else:
        write_silver(bronze, path, cfg.salt, watch=audits[0])

    saved = tables.read_by_month(spark, path)
    cutoff = sampling.time_cutoff(
        saved, cfg.cutoff_percentile, relative_error=cfg.cutoff_error
    )
    audits += _publish_gold(cutoff, cfg, lambda **bounds: tables.read_by_month(spark, path, **bounds))
    return spark.createDataFrame([a.row() for a in audits], quality.AUDIT)


def read_gold(spark: SparkSession, cfg: EtlConfig, name: str) -> DataFrame:
    """The published ``train`` or ``test`` table."""
    return tables.read_published(spark, cfg.path(f"gold/{name}"), schemas.GOLD)


def run_incremental(spark: SparkSession, cfg: EtlConfig) -> DataFrame:
    """Loads the landing files that are not in the ledger, or changed since, and returns their ledger
    rows (none when nothing is new, and nothing is written then).

    Only the new files are parsed: bronze and silver get a folder per load. Gold is made anew from all
    silver rows, since the cutoff moves with them. The ledger is published last: a run that breaks
    before leaves rows that no reader counts, and the next run loads the same files again. Files that
    leave the landing folder stay loaded; a file must be whole when it lands. Ids that repeat across
    files are settled where silver is read (``deduplicate``), not in the stored rows."""
    require_utc(spark)
    book = cfg.path("ledger")
    known = ledger.read_ledger(spark, book)
    files = materialise(ledger.pending(ledger.landed(spark, cfg.landing_transactions, LANDED), known))
    paths = [r["arquivo"] for r in files.select("arquivo").toLocalIterator()]
    if not paths:
        return known.limit(0)
    load = ledger.new_load()
    # A condition on the path is settled when the files are listed; the others are not opened.
    raw = (
        spark.read.option("recursiveFileLookup", "true")
        .csv(cfg.landing_transactions, schema=schemas.TRANSACTIONS, header=True, enforceSchema=True, pathGlobFilter=LANDED)
        .select("*", F.col("_metadata.file_path").alias("arquivo"))
        .where(F.col("arquivo").isin(paths))
    )
    bronze = f"{cfg.path('bronze/loads')}/carga={load}"
    raw.write.parquet(bronze)
    kept = spark.read.parquet(bronze)
    origin = kept.select("*", F.lit(load).alias("carga"))
    silver = to_silver(origin, [*schemas.SILVER.names, *ledger.ORIGIN], cfg.salt).drop("carga")
    tables.overwrite_by_month(silver, f"{cfg.path('silver/loads')}/carga={load}")
    lines = kept.groupBy("arquivo").agg(F.count(F.lit(1)).alias("linhas"))
    book_after = materialise(ledger.updated(known, files, lines, load))

    def rows(**bounds) -> DataFrame:
        return _loaded_silver(spark, cfg, book_after, **bounds)

    cutoff = sampling.time_cutoff(rows(), cfg.cutoff_percentile, relative_error=cfg.cutoff_error)
    _publish_gold(cutoff, cfg, rows)
    tables.publish(book_after, book)
    return book_after.where(F.col("carga") == load)


def _loaded_silver(spark: SparkSession, cfg: EtlConfig, book: DataFrame, **bounds) -> DataFrame:
    origin = [f for f in ledger.LEDGER if f.name in ledger.ORIGIN]
    schema = T.StructType([*schemas.SILVER.fields, *origin])
    stored = tables.read_by_month(spark, cfg.path("silver/loads"), schema=schema, **bounds)
    silver = ledger.counted(stored, book).select(*schemas.SILVER.names)
    return latest(silver) if cfg.deduplicate else silver


def read_loaded(spark: SparkSession, cfg: EtlConfig, before: int | None = None, since: int | None = None) -> DataFrame:
    """Silver rows of all loads that the published ledger names, in ``[since, before)``."""
    return _loaded_silver(spark, cfg, ledger.read_ledger(spark, cfg.path("ledger")), before=before, since=since)
