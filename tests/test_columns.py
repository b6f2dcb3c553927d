from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import functions as F

from ledgerlens.functions import columns as C
from ledgerlens.operators import quality, stats


def one(df):
    return df.first()[0]


def test_event_time_is_null_when_text_is_bad_or_missing(spark):
    rows = [("2020-01-02", "03:04:05"), ("bad", "x"), (None, "12:00:00"), ("2020-01-02", None)]
    df = spark.createDataFrame(rows, "trans_date string, trans_time string")
    got = [r[0] for r in df.select(C.event_time()).collect()]
    assert got == [datetime(2020, 1, 2, 3, 4, 5), None, None, None]


def test_hash_null_and_salt(spark):
    df = spark.createDataFrame([(123,), (None,)], "cc_num long")
    plain, missing = [r[0] for r in df.select(C.hashed("cc_num")).collect()]
    assert plain == hashlib.sha256(b"123").hexdigest() and missing is None
    assert one(df.select(C.hashed("cc_num", "s"))) == hashlib.sha256(b"s123").hexdigest()


def test_age_counts_completed_years(spark):
    rows = [
        (datetime(2020, 5, 9, 23, 59), "1990-05-10", 29),
        (datetime(2020, 5, 10), "1990-05-10", 30),
        (datetime(2020, 5, 11), "1990-05-10", 30),
        (datetime(2020, 2, 28), "2000-02-29", 19),
        (datetime(2020, 2, 29), "2000-02-29", 20),
    ]
    df = spark.createDataFrame(rows, "event_time timestamp, dob string, want long")
    assert all(r[0] == r[1] for r in df.select(C.age_at(), "want").collect())
    bad = spark.createDataFrame([(datetime(2020, 1, 1), "x")], "event_time timestamp, dob string")
    assert one(bad.select(C.age_at())) is None


def test_haversine_antipodal_and_same_point(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (1.0, 2.0, 1.0, 2.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(C.haversine_km("a", "b", "c", "d")).collect()]
    assert got == [20015.09, 0.0]


def test_calendar_starts_the_week_on_sunday(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 3, 17),)], "event_time timestamp")
    row = df.select(*[v.alias(k) for k, v in C.calendar_features().items()]).first()
    assert row.asDict() == {"hour": 17, "day_of_week": 1, "month": 3}


def test_bands_close_on_the_left(spark):
    df = spark.createDataFrame([(9.99,), (10.0,), (1000.0,)], "amt double")
    got = [r[0] for r in df.select(C.amount_band()).collect()]
    assert got == ["1. até 10", "2. 10 a 50", "7. acima de 1000"]


def test_class_label_of_unknown_is_null(spark):
    df = spark.createDataFrame([(0,), (1,), (7,), (None,)], "is_fraud int")
    got = [r[0] for r in df.select(C.class_label()).collect()]
    assert got == ["legítima", "fraude", None, None]


def test_epoch_seconds_accepts_ntz(spark):
    df = spark.sql("select timestamp_ntz'1970-01-02 00:00:01' as t")
    assert one(df.select(C.epoch_seconds("t"))) == 86401


def test_correlation_of_constant_is_null_and_pairs_with_nulls_are_ignored(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.0, 5.0), (None, 100.0, 5.0)]
    df = spark.createDataFrame(rows, "x double, y double, k double")
    got = {(r[0], r[1]): r[2] for r in stats.correlation_matrix(df, ["x", "y", "k"]).collect()}
    assert abs(got["x", "y"] - 1) < 1e-12 and got["x", "k"] is None and got["k", "k"] == 1.0
    assert got["y", "x"] == got["x", "y"]


def test_null_audit_and_dedup(spark):
    rows = [("a", 1, 5.0), ("a", 2, 1.0), ("a", 2, 3.0), (None, 1, None), (None, 2, None)]
    df = spark.createDataFrame(rows, "trans_num string, event_time int, v double")
    nulls = {r[0]: r[1] for r in quality.null_audit(df).collect()}
    assert nulls == {"trans_num": 2, "event_time": 0, "v": 2}
    kept = sorted(map(tuple, quality.dedup_latest(df).collect()), key=str)
    assert kept == [("a", 2, 3.0), (None, 2, None)]
    assert one(quality.duplicate_ids(df)) == 2


def test_linear_and_log_histograms_integrate_to_one(spark):
    df = spark.range(1, 2001).select(
        (F.col("id") / 7.0).alias("amt"), (F.col("id") % 2).cast("int").alias("is_fraud")
    )
    for out in (stats.log_histogram(df), stats.linear_histogram(df, "amt")):
        area = out.groupBy("classe").agg(F.sum(F.col("densidade") * (F.col("fim") - F.col("inicio"))))
        assert all(abs(r[1] - 1) < 1e-9 for r in area.collect())
        assert out.agg(F.sum("n")).first()[0] == 2000


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(2.0, 0), (2.0, 1)], "amt double, is_fraud int")
    assert {r["bin"] for r in stats.log_histogram(df).collect()} == {0}
    assert {r["bin"] for r in stats.linear_histogram(df, "amt").collect()} == {0}
