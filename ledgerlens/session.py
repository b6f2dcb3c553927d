"""Session settings and the shared folder used for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ledgerlens", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators expect; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, else a folder beside the tables of the
    warehouse, which executors share too."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        # Beside a warehouse on this machine's disk only this machine's executors would find it.
        shared = warehouse and (":" in warehouse.removeprefix("file:") or sc.master.startswith("local"))
        if not shared:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{warehouse.rstrip('/')}/_intermediate"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, visible to every executor."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Frames that are written inside leave no shuffle files behind: what they are read from next is the
    table. Otherwise these files stay until the driver happens to collect its garbage."""
    conf, key = spark.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        yield
    finally:
        conf.set(key, before)


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: computed once, survives executor loss, cuts the lineage."""
    shared_root(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        # The setting counts for frames that are made under it.
        return df.select("*").checkpoint(eager=True)


# Names of the zone without an offset.
_UTC = {"UTC", "Z", "GMT", "+00:00", "Etc/UTC", "Etc/GMT", "UCT", "Etc/UCT", "Zulu", "Etc/Zulu", "Universal", "Etc/Universal"}


def require_utc(spark: SparkSession) -> None:
    """Event times are read and cut in UTC; a session of another zone is refused, not changed."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in _UTC:
        raise ValueError(f"spark.sql.session.timeZone is {zone}; the jobs need UTC")
