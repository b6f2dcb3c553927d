"""Published versions, stored sketches, quarantine, audits of writes, streams over several runs."""

from __future__ import annotations

import glob
import os
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens.operators import quality, rates, sketches
from ledgerlens.plans import etl, registry
from ledgerlens.session import shared_root
from ledgerlens.sources import fixture, landing, tables
from ledgerlens.streaming import ingest


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_failing_write_leaves_the_published_version(spark, folder):
    path = f"{folder}/t"
    first = tables.publish(spark.range(10), path)
    broken = spark.range(10).select(F.when(F.col("id") > 5, F.raise_error(F.lit("broken half-way"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken half-way"):
        tables.publish(broken, path)
    assert tables.published(spark, path) == first and tables.read_published(spark, path).count() == 10
    # A reader that has begun keeps its version.
    held = tables.read_published(spark, path)
    second = tables.publish(spark.range(3), path)
    assert second != first and tables.read_published(spark, path).count() == 3 and held.count() == 10
    assert tables.forget_versions(spark, path) == 2
    assert tables.read_published(spark, path).count() == 3
    assert sorted(n for n in os.listdir(path) if not n.startswith(".")) == sorted(["atual", second.rsplit("/", 1)[1]])


def test_a_new_month_reads_that_month_only(spark, small, folder):
    table, store = f"{folder}/silver", f"{folder}/store"
    tables.overwrite_by_month(registry.silver(spark, small), table)
    months = sorted(d.split("=")[1] for d in os.listdir(table) if "=" in d)
    sketches.store_months(spark, table, f"{folder}/whole")
    want = sketches.merged_distinct(sketches.read_store(spark, f"{folder}/whole")).first()
    # All months but one, and then that one.
    sketches.store_months(spark, table, store, months[:3] + months[4:])
    assert sketches.read_store(spark, store).count() == len(months) - 1
    kept = {d: os.path.getmtime(f"{store}/{d}") for d in os.listdir(store) if "=" in d}
    rows = spark.read.option("basePath", table).parquet(table).where(F.col("event_month").cast("string").isin(months[3]))
    assert "(event_month#" in (text := plan(sketches.month_sketches(rows))) and f"= {months[3]})], PushedFilters" in text
    sketches.store_months(spark, table, store, [months[3]])
    assert sketches.merged_distinct(sketches.read_store(spark, store)).first() == want
    assert all(os.path.getmtime(f"{store}/{d}") == t for d, t in kept.items())


def test_sketches_of_empty_and_null_rows(spark, folder):
    rows = spark.createDataFrame([(None, None), ("a", None), (None, datetime(2020, 1, 2))], "trans_num string, event_time timestamp")
    tables.overwrite_by_month(rows, f"{folder}/t")
    sketches.store_months(spark, f"{folder}/t", f"{folder}/s")
    store = sketches.read_store(spark, f"{folder}/s")
    assert sketches.merged_distinct(store).first()["ids_estimados"] == 1
    assert sketches.merged_cutoff(store.where("n > 0 and event_month = '2020-01'")).first()["corte"] == 1577923200
    assert {r["voltam"] for r in sketches.returning_ids(store).collect()} == {0}


def test_quarantine_names_the_columns(spark, folder):
    head = ",".join(schemas.TRANSACTIONS.names)
    good = ["1"] * 27
    bad, short = list(good), good[:5]
    bad[schemas.TRANSACTIONS.names.index("amt")] = "much"
    bad[schemas.TRANSACTIONS.names.index("zip")] = "12-3"
    empty = list(good)
    empty[schemas.TRANSACTIONS.names.index("amt")] = ""
    with open(f"{folder}/t.csv", "w") as f:
        f.write("\n".join([head, *(",".join(r) for r in (good, bad, short, empty))]) + "\n")
    accepted, rejected = landing.read_checked(spark, folder)
    assert accepted.columns == schemas.TRANSACTIONS.names and sorted(r["amt"] or 0 for r in accepted.collect()) == [0, 1]
    assert sorted(r["motivo"] for r in rejected.collect()) == [["celulas: 5"], ["zip: 12-3", "amt: much"]]
    # Whatever columns are asked for, the same rows are rejected.
    assert accepted.select("state").count() == 2 and rejected.count() == 2


def test_an_audit_takes_no_further_scan(spark, small, folder):
    rows = registry.silver(spark, small)
    watched = quality.Watched("silver", schemas.SILVER.names)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("audited", "write")
    try:
        tables.overwrite_by_month(rows, f"{folder}/t", watch=watched)
        with_audit = len(tracker.getJobIdsForGroup("audited"))
        name, n, frauds, legit, first, last, nulls = watched.row()
        assert len(tracker.getJobIdsForGroup("audited")) == with_audit
        spark.sparkContext.setJobGroup("bare", "write")
        tables.overwrite_by_month(rows, f"{folder}/u")
        assert len(tracker.getJobIdsForGroup("bare")) == with_audit
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert (name, n, frauds + legit) == ("silver", rows.count(), rows.count())
    assert (first, last) == tuple(quality.time_range(rows).first())
    assert nulls == {r["coluna"]: r["nulos"] for r in quality.null_audit(rows).collect()}


def land(rows, landing_folder):
    rows.coalesce(1).write.mode("append").csv(landing_folder, header=True)


def test_ids_that_return_in_a_later_run_are_dropped(spark, small, folder):
    rows = fixture.transactions(spark, small).dropDuplicates(["trans_num"]).where("row_id % 7 < 2").persist()
    again = rows.withColumn("amt", F.lit(0.5)).where("row_id % 7 = 0")
    paths = f"{folder}/landing", f"{folder}/silver", f"{folder}/checkpoint"
    land(rows.where("row_id % 2 = 0"), paths[0])
    ingest.ingest_first(spark, *paths, max_files=1)
    land(rows.where("row_id % 2 = 1"), paths[0])
    land(again, paths[0])
    for _ in range(2):  # a further run without new files changes nothing
        found = ingest.ingest_first(spark, *paths, max_files=1)
        assert found.count() == rows.count() == found.select("trans_num").distinct().count()
        assert found.where("amt = 0.5").count() == 0
    rows.unpersist()


def test_monthly_sums_survive_a_repeated_batch(spark, small, folder):
    rows = fixture.transactions(spark, small).where("row_id % 5 = 0").persist()
    paths = f"{folder}/landing", f"{folder}/sums", f"{folder}/checkpoint"
    land(rows.where("trans_date >= '1995-01-01'"), paths[0])
    first = ingest.monthly_available(spark, *paths, max_files=1).agg(F.sum("n"), F.sum("atrasadas")).first()
    assert first[1] == 0
    land(rows.where("trans_date < '1995-01-01'"), paths[0])
    want = [tuple(r) for r in ingest.monthly_available(spark, *paths, max_files=1).collect()]
    # The batch's end is forgotten, as after a crash before its commit: it runs again.
    for name in ("1", ".1.crc"):
        os.remove(f"{folder}/checkpoint/commits/{name}")
    assert [tuple(r) for r in ingest.monthly_available(spark, *paths, max_files=1).collect()] == want
    assert sum(r[1] for r in want) == rows.count()
    edge = rows.agg(F.max("trans_date")).first()[0]
    late = rows.where("trans_date < '1995-01-01'").count()
    assert edge > "1995-02-15" and sum(r[4] for r in want) == late
    rows.unpersist()


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return {"spark.sql.warehouse.dir": "file:/tmp/warehouse"}.get(key, default)

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session())


def _cfg(folder, **more):
    return etl.EtlConfig(folder, f"{folder}/landing", cutoff_error=0.0, **more)


def _land(rows, folder, name, where):
    rows.where(where).coalesce(1).write.csv(f"{folder}/landing/{name}", header=True)


def test_a_second_load_reads_new_files_only(spark, small, folder):
    rows, cfg = fixture.transactions(spark, small).cache(), _cfg(folder)
    _land(rows, folder, "um", "row_id % 2 = 0")
    first = {r["arquivo"]: r["linhas"] for r in etl.run_incremental(spark, cfg).collect()}
    assert sum(first.values()) == rows.where("row_id % 2 = 0").count()
    _land(rows, folder, "dois com espaco", "row_id % 2 = 1")
    opened = spark.read.csv(f"{folder}/landing/um", schema=schemas.TRANSACTIONS, header=True).inputFiles()
    for name in opened:  # content that a second reading of the first file would bring in
        path = name.removeprefix("file://")
        at = os.stat(path)
        with open(path, "r+b") as f:
            body = f.read()
            f.seek(0)
            f.write(body.replace(b"adults", b"ADULTS"))
        os.utime(path, ns=(at.st_atime_ns, at.st_mtime_ns))
    second = {r["arquivo"]: r["linhas"] for r in etl.run_incremental(spark, cfg).collect()}
    assert len(second) == 1 and not set(first) & set(second)
    assert spark.read.parquet(f"{folder}/bronze/loads").where("profile = 'ADULTS'").count() == 0
    assert etl.read_loaded(spark, cfg).count() == rows.count()
    assert etl.run_incremental(spark, cfg).count() == 0


def test_a_load_that_breaks_is_not_counted_and_taken_again(spark, small, folder, monkeypatch):
    rows, cfg = fixture.transactions(spark, small).cache(), _cfg(folder)
    _land(rows, folder, "um", "row_id % 2 = 0")
    etl.run_incremental(spark, cfg)
    _land(rows, folder, "dois", "row_id % 2 = 1")
    with monkeypatch.context() as m:
        m.setattr(etl, "_publish_gold", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            etl.run_incremental(spark, cfg)
    assert etl.read_loaded(spark, cfg).count() == rows.where("row_id % 2 = 0").count()
    etl.run_incremental(spark, cfg)
    found = etl.read_loaded(spark, cfg)
    assert found.count() == rows.count() and found.exceptAll(etl.to_silver(rows)).count() == 0


def test_files_without_rows_and_no_files(spark, small, folder):
    rows, cfg = fixture.transactions(spark, small), _cfg(folder)
    os.makedirs(f"{folder}/landing")
    assert etl.run_incremental(spark, cfg).collect() == []
    with open(f"{folder}/landing/vazio.csv", "w") as f:
        f.write(",".join(schemas.TRANSACTIONS.names) + "\n")
    assert [r["linhas"] for r in etl.run_incremental(spark, cfg).collect()] == [0]
    assert etl.read_loaded(spark, cfg).count() == 0 and etl.read_gold(spark, cfg, "train").count() == 0
    _land(rows, folder, "um", "row_id % 9 = 0")
    etl.run_incremental(spark, cfg)
    assert etl.read_loaded(spark, cfg).count() == rows.where("row_id % 9 = 0").count()


def _groups_with(path, column, value):
    """Row groups whose statistics admit the value, and all row groups."""
    hit = total = 0
    for name in glob.glob(f"{path}/*/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        for g in range(meta.num_row_groups):
            stats = next(c.statistics for c in map(meta.row_group(g).column, range(meta.num_columns)) if c.path_in_schema == column)
            total += 1
            hit += stats is None or not stats.has_min_max or stats.min <= value <= stats.max
    return hit, total


def test_the_clustered_layout_reads_fewer_row_groups(spark, folder):
    silver = registry.silver(spark, "/root/testdata/sf0.01").where("event_time >= '1999-01-01' and event_time < '1999-04-01'").cache()
    # One customer holds a third of the rows.
    hot = silver.withColumn("customer_hash", F.when(F.pmod(F.xxhash64("trans_num"), F.lit(3)) == 0, F.lit("8" * 64)).otherwise(F.col("customer_hash")))
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 100)
    try:
        tables.overwrite_by_month(silver, f"{folder}/month")
        tables.overwrite_clustered(silver, f"{folder}/clustered", files=8)
        tables.overwrite_clustered(hot, f"{folder}/hot", files=8)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    hashes = sorted(r[0] for r in silver.select("customer_hash").distinct().collect())
    some = [hashes[len(hashes) * i // 8] for i in range(1, 8)]
    plain = [_groups_with(f"{folder}/month", "customer_hash", value)[0] for value in some]
    few = [_groups_with(f"{folder}/clustered", "customer_hash", value)[0] for value in some]
    print("row groups read", plain, few)
    assert 2 * sum(few) <= sum(plain)
    middle = some[3]
    for name, rows in (("clustered", silver), ("hot", hot)):
        back = tables.read_by_month(spark, f"{folder}/{name}")
        assert back.count() == rows.count() and back.select(rows.columns).exceptAll(rows).count() == 0
    look = rates.customer_history(tables.read_by_month(spark, f"{folder}/clustered"), middle)
    assert "PushedFilters: [IsNotNull(customer_hash), EqualTo(customer_hash" in plan(look)


def test_clustered_nulls_and_empty(spark, folder):
    rows = spark.createDataFrame(
        [(None, None, 1), ("x", datetime(2020, 1, 2), 2), ("a" * 64, None, 3), (None, datetime(2020, 2, 2), 4), ("a" * 64, datetime(2020, 2, 2), 5)],
        "customer_hash string, event_time timestamp, trans_num int",
    )
    tables.overwrite_clustered(rows, f"{folder}/t", files=2)
    assert sorted(r["trans_num"] for r in spark.read.parquet(f"{folder}/t").collect()) == [1, 2, 3, 4, 5]
    tables.overwrite_clustered(rows.limit(0), f"{folder}/e")
    assert tables.read_by_month(spark, f"{folder}/e", schema=rows.schema).count() == 0


def test_key_digests_tell_lists_of_keys_apart(spark):
    rows = [("ab", "c", 0.0), ("a", "bc", 0.0), (None, "-", 0.0), ("-", None, 0.0), (None, "-", -0.0), ("ab", "c", 0.0)]
    df = spark.createDataFrame(rows, "a string, b string, x double")
    found = [bytes(r[0]) for r in df.select(ingest.key_digest(df, df.columns)).collect()]
    assert all(len(f) == 32 for f in found)
    assert len(set(found)) == 4 and found[0] == found[5] and found[2] == found[4]


def test_landing_files_are_written_by_many_tasks(spark, small, monkeypatch):
    """Neither a year of the stream nor the file that grows is written by one task."""
    tasks, land = [], registry.land
    monkeypatch.setattr(registry, "land", lambda rows, path: (tasks.append(rows.rdd.getNumPartitions()), land(rows, path)))
    assert registry.QUERIES["stream_monthly"](spark, small).count() > 0
    assert registry.QUERIES["etl_incremental"](spark, small).count() > 0
    assert len(tasks) > 5 and min(tasks) > 1
