"""Sources, sinks, whole jobs, streaming, plans."""

from __future__ import annotations

import json
import os
import pathlib
import shutil
import time

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens.operators import features, models, quality, sampling, stats
from ledgerlens.plans import etl, registry, retrain
from ledgerlens.session import materialise, new_folder
from ledgerlens.sources import fixture, landing, tables
from ledgerlens.streaming import ingest, scoring


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bad_cells_become_null_and_columns_bind_by_position(spark, folder):
    head = ["Unnamed: 0", *schemas.TRANSACTIONS.names[1:]]
    cells = ["7"] + ["1"] * 26
    bad = ["x"] + ["1"] * 26
    with open(f"{folder}/t.csv", "w") as f:
        f.write("\n".join(",".join(r) for r in (head, cells, bad)) + "\n")
    got = landing.read_transactions(spark, f"{folder}/t.csv")
    assert got.columns[0] == "row_id"
    assert [r["row_id"] for r in got.collect()] == [7, None]


def test_inferred_profile(spark, folder):
    with open(f"{folder}/c.csv", "w") as f:
        f.write("a|b\n1|x\n2|\n")
    rows = landing.schema_profile(landing.read_inferred(spark, folder, "|")).collect()
    assert [tuple(r) for r in rows] == [(0, "a", "int", 2, 0), (1, "b", "string", 1, 1)]


def test_inventory_does_not_read_contents(spark, small):
    files = landing.inventory(spark, small, "*.parquet")
    assert "content" not in plan(files).split("ReadSchema")[1]
    assert files.filter("bytes > 0").count() == 14


def test_missing_files(spark):
    want = spark.createDataFrame([("a",), ("b",)], "arquivo string")
    have = spark.createDataFrame([("b",), ("z",)], "arquivo string")
    assert [r[0] for r in landing.missing_files(want, have).collect()] == ["a"]


def test_named_table_and_sql_arguments(spark, small):
    rows = registry.silver(spark, small, "category", "is_fraud")
    tables.overwrite_table(rows, "silver_check")
    tables.overwrite_table(rows, "silver_check")
    got = tables.query(
        spark, "SELECT count(*) AS n FROM {t} WHERE is_fraud = :v", {"v": 0}, t=spark.table("silver_check")
    )
    assert got.first()["n"] == rows.filter("is_fraud = 0").count()


def test_month_table_prunes_folders_and_pushes_the_bound(spark, small, folder):
    rows = registry.silver(spark, small)
    tables.overwrite_by_month(rows, folder)
    cutoff = sampling.time_cutoff(rows)
    before = tables.read_by_month(spark, folder, before=cutoff)
    text = plan(before)
    assert "PartitionFilters: [isnotnull(event_month" in text
    assert "LessThan(event_time" in text
    since = tables.read_by_month(spark, folder, since=cutoff)
    assert before.count() + since.count() == rows.count()
    assert since.agg(F.min(F.col("event_time").cast("long"))).first()[0] >= cutoff


def test_scans_read_only_wanted_columns(spark, small):
    text = plan(registry.silver(spark, small, "amt", "is_fraud"))
    assert "Join" not in text
    schema = text.split("ReadSchema: ")[1]
    assert "l_tax" not in schema and "l_linestatus" not in schema


def test_one_scan_for_all_correlations_and_nulls(spark, small, folder):
    tables.overwrite(registry.silver(spark, small), folder)
    rows = spark.read.schema(schemas.SILVER).parquet(folder)
    for out in (stats.correlation_matrix(rows), quality.null_audit(rows)):
        assert plan(out).count("FileScan") == 1


def test_split_reaches_the_scan(spark, small, folder):
    tables.overwrite(registry.silver(spark, small), folder)
    rows = spark.read.schema(schemas.SILVER).parquet(folder)
    before, after = sampling.time_split(rows, 961_000_000)
    assert "LessThan(event_time" in plan(before)
    assert "GreaterThanOrEqual(event_time" in plan(after)


def test_samples_do_not_depend_on_partitioning(spark, small):
    rows = registry.silver(spark, small, "trans_num", "amt", "is_fraud")

    def keys(df):
        return sorted(map(tuple, df.collect()))

    assert keys(sampling.stratified_sample(rows, 0.1)) == keys(
        sampling.stratified_sample(rows.repartition(5), 0.1)
    )
    assert keys(sampling.fixed_n_sample(rows, 100)) == keys(
        sampling.fixed_n_sample(rows.repartition(5), 100)
    )
    assert sampling.fixed_n_sample(rows, 10**6).count() == rows.count()


def test_fixed_n_survives_one_frequent_id(spark):
    rows = spark.range(1000).select(
        F.when(F.col("id") < 900, "hot").otherwise(F.col("id").cast("string")).alias("trans_num"), "id"
    )
    assert sampling.fixed_n_sample(rows, 50).count() == 50


def test_fixed_n_takes_the_smallest_hashes(spark):
    import hashlib

    ids = [f"t{i}" for i in range(2000)]
    rows = spark.createDataFrame([(i,) for i in ids] + [(None,)], "trans_num string")
    want = sorted(ids, key=lambda i: hashlib.sha256(i.encode()).hexdigest())
    for n in (1, 37, 1999, 2000):
        got = {r[0] for r in sampling.fixed_n_sample(rows, n).collect()}
        assert got == set(want[:n])
    assert sampling.fixed_n_sample(rows, 2001).count() == 2001


def test_bernoulli_sample_keeps_all_frauds(spark, small):
    rows = registry.silver(spark, small, "trans_num", "is_fraud")
    frauds = rows.filter("is_fraud = 1").count()
    kept = sampling.stratified_sample(rows, 0.2, method="bernoulli")
    assert kept.filter("is_fraud = 1").count() == frauds
    legit, all_legit = kept.filter("is_fraud = 0").count(), rows.count() - frauds
    assert abs(legit - 0.2 * all_legit) < 5 * (0.16 * all_legit) ** 0.5


def test_approximate_cutoff_is_close(spark, small):
    rows = registry.silver(spark, small, "event_time")
    exact, approx = sampling.time_cutoff(rows), sampling.time_cutoff(rows, relative_error=0.001)
    assert abs(exact - approx) < 30 * 86_400


def test_encoding_of_unknown_missing_and_quoted_values(spark):
    train = spark.createDataFrame([("b'x", 1.0), ("a", 3.0), ("a", 5.0)], "k string, v double")
    encoding = features.fit_encoding(train, ["k"], ["v"])
    new = spark.createDataFrame([("a", 3.0), ("b'x", 3.0), ("new", 3.0), (None, 3.0)], train.schema)
    got = [tuple(r) for r in encoding.apply(new).select("k_cod", "v_pad").collect()]
    assert got == [(0.0, 0.0), (1.0, 0.0), (-1.0, 0.0), (-1.0, 0.0)]
    flags = PipelineModel(stages=[*encoding.stages(), *features.one_hot_stages(spark, encoding)])
    vectors = [r[0] for r in flags.transform(new).select(vector_to_array("features")).collect()]
    assert [v[:2] for v in vectors] == [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0], [0.0, 0.0]]


def test_encoding_of_many_categories(spark):
    many = spark.range(12_000).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("k"), F.lit(1.0).alias("v"))
    encoding = features.fit_encoding(many, ["k"], ["v"])
    codes = encoding.apply(many).select(F.col("k").cast("double").alias("k"), "k_cod")
    assert codes.filter("k <> k_cod").count() == 0 and codes.count() == 12_000


def test_etl_with_deduplication(spark, small, folder):
    fixture.transactions(spark, small).write.csv(f"{folder}/in", header=True)
    cfg = etl.EtlConfig(folder, f"{folder}/in", rebuild_bronze=True, deduplicate=True)
    counts = {r["tabela"]: r for r in etl.run_etl(spark, cfg).collect()}
    assert counts["silver"]["n"] == 4599
    assert counts["train"]["fraudes"] + counts["test"]["fraudes"] == counts["silver"]["fraudes"]
    again = {r["tabela"]: r["n"] for r in etl.run_etl(spark, etl.EtlConfig(folder)).collect()}
    assert again["silver"] == 6000


def test_stream_ingests_only_new_files(spark, small, folder):
    rows = fixture.transactions(spark, small)
    rows.limit(100).coalesce(1).write.csv(f"{folder}/a", header=True)
    args = (f"{folder}/landing", f"{folder}/silver", f"{folder}/checkpoint")
    os.makedirs(args[0])

    def land(name):
        (part,) = [f for f in os.listdir(f"{folder}/a") if f.endswith(".csv")]
        shutil.copy(f"{folder}/a/{part}", f"{args[0]}/{name}.csv")

    land("one")
    assert ingest.ingest_available(spark, *args).count() == 100
    assert ingest.ingest_available(spark, *args).count() == 100
    land("two")
    assert ingest.ingest_available(spark, *args).count() == 200


@pytest.fixture(scope="module")
def trained(spark, small):
    train, test = registry.modelling(spark, small)
    encoding, balanced = retrain.prepare(train)
    return encoding, balanced, test


def test_failing_model_does_not_stop_the_others(trained):
    encoding, balanced, test = trained
    fitted, scored, failures = models.train_all(
        ["arvore_decisao", "random_forest", "unknown"], balanced, test, encoding,
        params={"arvore_decisao": {"maxDepth": 3}, "random_forest": {"maxDepth": -1}},
    )
    assert list(fitted) == ["arvore_decisao"]
    assert [name for name, _ in failures] == ["random_forest", "unknown"]
    assert scored.select("modelo").distinct().count() == 1


@pytest.mark.parametrize("name, few", [("regressao_logistica", {"maxIter": 5}), ("random_forest", {"numTrees": 3})])
def test_fitted_models_leave_their_summary_behind(trained, name, few):
    encoding, balanced, test = trained[:3]
    fitted = models.fit_model(name, balanced, encoding, **few)
    assert not fitted.stages[-1].hasSummary
    assert materialise(models.score(encoding.apply(test), fitted, ["is_fraud"])).count() == test.count()


def test_boosted_models_save_and_load(spark, trained, folder):
    encoding, balanced, test = trained
    for name, params in (("adaboost", {"maxIter": 3}), ("xgboost", {"maxIter": 2})):
        full = models.with_encoder(encoding, models.fit_model(name, balanced, encoding, **params))
        full.write().save(f"{folder}/{name}")
        row = models.score_agreement(test, full, PipelineModel.load(f"{folder}/{name}")).first()
        assert row["iguais"] and row["n"] == test.count()
        p = [r[0] for r in models.score(test, full, []).collect()]
        assert len(set(p)) > 1 and min(p) >= 0 and max(p) <= 1


def test_importance_of_an_unused_feature_is_zero(spark, trained):
    encoding, balanced, test = trained
    model = models.fit_model("arvore_decisao", balanced, encoding, maxDepth=1)
    rows = models.permutation_importance(test, model, encoding, repeats=2).collect()
    assert len(rows) == 10
    assert sum(abs(r["importancia"]) > 1e-12 for r in rows) <= 1


def test_requests_in_a_stream_get_the_batch_answer(spark, trained, folder):
    encoding, balanced, test = trained
    model = models.with_encoder(encoding, models.fit_model("arvore_decisao", balanced, encoding))
    os.makedirs(f"{folder}/in")
    sample = {
        "category": "misc_net", "state": "KS", "gender": "M", "amt": 51.08, "city_pop": 370212,
        "age": 36, "distance_km": 62.13, "hour": 8, "day_of_week": 6, "month": 8,
    }
    lines = [json.dumps(sample), "not json", json.dumps({"amt": 1.0})]
    with open(f"{folder}/in/r.txt", "w") as f:
        f.write("\n".join(lines) + "\n")
    out = scoring.score_available(spark, model, f"{folder}/in", f"{folder}/out", f"{folder}/cp", 0.3)
    (answer,) = out.collect()
    batch = models.score_batch(spark.createDataFrame([sample]), model, 0.3).first()
    assert answer["probabilidade_fraude"] == batch["probabilidade_fraude"]
    assert answer["fraude"] == (batch["probabilidade_fraude"] >= 0.3) and answer["limiar"] == 0.3


def test_retrain_keeps_history_and_champion(spark, small, folder):
    train, test = registry.modelling(spark, small)
    cfg = retrain.RetrainConfig(folder, model="arvore_decisao")
    first, second = (retrain.retrain(spark, train, test, cfg).first() for _ in range(2))
    assert first["promovido"] and first["pr_auc_atual"] is None
    assert not second["promovido"] and second["pr_auc_atual"] == first["pr_auc_desafiante"]
    history = spark.read.schema(schemas.HISTORY).json(cfg.path("historico"))
    assert history.count() == 2 and os.listdir(cfg.path("modelos")) == [first["data"]]
    runs = spark.read.schema(schemas.RUNS).parquet(cfg.path("execucoes"))
    assert {r["params"]["promovido"] for r in runs.collect()} == {"true", "false"}


def test_a_broken_history_is_not_taken_for_none(spark, folder):
    cfg = retrain.RetrainConfig(folder)
    assert retrain.champion(spark, cfg) is None
    os.makedirs(cfg.path("historico"))
    with open(cfg.path("historico") + "/part.json", "w") as f:
        f.write('{"data": "x", "promovido": true}\n')
    assert retrain.champion(spark, cfg) is None
    os.replace(cfg.path("historico") + "/part.json", cfg.path("historico") + "/part.json.gz")
    with pytest.raises(Exception):
        retrain.champion(spark, cfg)


def test_jobs_refuse_another_time_zone(spark, small):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Lisbon")
    try:
        with pytest.raises(ValueError):
            registry.silver(spark, small)
        assert spark.conf.get("spark.sql.session.timeZone") == "Europe/Lisbon"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_landing_files_may_be_compressed(spark, folder):
    """Compressed files are loaded like others, and one that grew under its name is loaded anew."""
    rows = fixture.transactions(spark, "/root/testdata/sf0.001")
    cfg = etl.EtlConfig(folder, f"{folder}/landing")
    rows.where("row_id % 2 = 0").write.csv(f"{folder}/landing/a", header=True, compression="gzip")
    rows.where("row_id % 2 = 1").write.csv(f"{folder}/landing/b", header=True)
    etl.run_incremental(spark, cfg)
    assert etl.read_loaded(spark, cfg).count() == rows.count()
    assert etl.run_incremental(spark, cfg).count() == 0


def test_model_gbt_trains_every_booster(monkeypatch):
    monkeypatch.setattr(registry, "_trained", lambda spark, sf, names: names)
    assert sorted(registry.QUERIES["model_gbt"](None, "")) == sorted(models.BOOSTED)


def test_stateful_batches_write_few_files_a_month(spark, folder):
    fields = [F.lit("1").try_cast(f.dataType).alias(f.name) for f in schemas.TRANSACTIONS]
    rows = spark.range(960).select(*fields, "id").withColumns({
        "trans_num": F.col("id").cast("string"), "trans_time": F.lit("00:00:00"), "dob": F.lit("1980-01-01"),
        "trans_date": F.concat(F.lit("2020-"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0"), F.lit("-05")),
    }).drop("id")
    rows.repartition(4).write.csv(f"{folder}/landing", header=True)
    found = ingest.ingest_first(spark, f"{folder}/landing", f"{folder}/silver", f"{folder}/checkpoint", max_files=2)
    assert found.count() == found.select("trans_num").distinct().count() == 960
    files = [p.parent for p in pathlib.Path(folder, "silver").rglob("*.parquet")]
    # Two micro-batches of twelve months; eight tasks with state would each write a file a month.
    assert len(files) <= 48 and len(set(files)) == 24


def _shuffle_files(spark):
    # The folder that the session really uses: the manager's environment may overrule spark.local.dir.
    made = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p for d in made for p in pathlib.Path(d.getPath()).rglob("shuffle_*.data")}


def test_written_frames_leave_no_shuffle_files(spark, folder):
    before = _shuffle_files(spark)
    rows = spark.range(5000).select((F.col("id") % 977).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("customer_hash"))
    kept = quality.dedup_latest(rows, "k", ())
    assert materialise(kept).count() == 977
    tables.overwrite(kept, f"{folder}/a")
    tables.overwrite_by_month(kept.withColumn("event_time", F.timestamp_seconds("k")), f"{folder}/b")
    tables.publish(kept, f"{folder}/c")
    registry.land(kept, f"{folder}/d")
    assert spark.read.parquet(f"{folder}/a").count() == spark.read.csv(f"{folder}/d", header=True).count() == 977
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    # Counting rows that were read back shuffles a few bytes; no written frame is left.
    assert sum(p.stat().st_size for p in left) < 5000


def test_latest_silver_rows_are_those_of_the_plain_maximum(spark):
    at = F.timestamp_seconds(1_600_000_000 + F.col("id") % 3)
    hashed = F.when(F.col("id") % 11 != 0, F.sha2((F.col("id") % 7).cast("string"), 256))
    rows = spark.range(600).select((F.col("id") % 40).alias("trans_num"), hashed.alias("customer_hash"), at.alias("event_time"), (F.col("id") % 5).alias("amt"))
    want = quality.dedup_latest(rows).orderBy("trans_num").collect()
    got = etl.latest(rows)
    assert got.columns == rows.columns and got.orderBy("trans_num").collect() == want
    # The shuffle carries bytes, not digits.
    assert "lower(hex(" in plan(got).split("Exchange hashpartitioning")[0]


def test_landing_files_of_the_source_queries_are_compressed(spark, small, monkeypatch):
    made = []
    monkeypatch.setattr(registry, "new_folder", lambda s, name: made.append(new_folder(s, name)) or made[-1])
    registry.QUERIES["ingest_transactions_csv"](spark, small)
    assert all(f.endswith(".csv.gz") for f in spark.read.text(made[0]).inputFiles())
