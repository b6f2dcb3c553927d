"""One named query per operator, each over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens.functions import columns as C
from ledgerlens.operators import (
    balance, features, metrics, models, quality, rates, sampling, sketches, stats,
)
from ledgerlens.plans import compare, etl, retrain
from ledgerlens.session import materialise, new_folder, shuffles_dropped
from ledgerlens.sources import fixture, landing, tables
from ledgerlens.streaming import ingest, scoring

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Share of legitimate rows in the modelling training set. The test tables hold about 2% frauds;
# this keeps frauds well below half of the legitimate rows, so that oversampling has work.
MODELLING_FRACTION = 0.1


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Hide the last bits of sums, which depend on the order of addition."""
    return df.withColumns({n: F.round(n, digits) for n in names})


def _raw(*names: str) -> dict[str, None]:
    """Raw columns that silver columns need."""
    return dict.fromkeys(r for n in names for r in etl.SILVER_INPUTS[n])


def silver(spark: SparkSession, sf: str, *names: str) -> DataFrame:
    """Silver transactions with the given columns, from only the raw columns they need."""
    names = names or tuple(schemas.SILVER.names)
    return etl.to_silver(fixture.transactions(spark, sf, *_raw(*names)), names)


def gold(spark: SparkSession, sf: str, *names: str) -> tuple[DataFrame, DataFrame]:
    names = names or tuple(schemas.SILVER.names)
    rows = silver(spark, sf, *names)
    return etl.to_gold(rows, sampling.time_cutoff(silver(spark, sf, "event_time")))


def modelling(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Gold train and test with one row per transaction id, from a saved silver table."""
    folder = new_folder(spark, "silver")
    tables.overwrite(etl.latest(silver(spark, sf)), folder)
    rows = spark.read.schema(schemas.SILVER).parquet(folder)
    return etl.to_gold(rows, sampling.time_cutoff(rows), MODELLING_FRACTION, 0.05)


def land(rows: DataFrame, path: str, sep: str = ",") -> None:
    """CSV landing files, compressed: as text they are many times the tables they are made from."""
    with shuffles_dropped(rows.sparkSession):
        rows.write.mode("append").csv(path, header=True, sep=sep, compression="gzip")


def amount_score() -> Column:
    """Amount as a share of 1,100, to two digits. Rounded by arithmetic: decimal rounding would
    settle ties by the printed form of the number."""
    return F.floor(F.col("amt") / 1100.0 * 100 + 0.5) / 100.0


def pseudo_scored(spark: SparkSession, sf: str) -> DataFrame:
    """Four simple scores per transaction, told apart by ``modelo``, from one scan. The last one
    knows the label for part of its range, so that high precision is reached."""
    rows = silver(spark, sf, "amt", "distance_km", "age", "is_fraud")
    whole = F.floor("amt")
    scores = {
        "valor": amount_score(),
        "distancia": F.floor(F.col("distance_km") / 1.5) / 100.0,
        "idade": F.col("age") / 100.0,
        "mista": F.when(F.col("is_fraud") == 1, 50 + whole % 47).otherwise(whole % 60) / 100.0,
    }
    entries = [
        F.struct(F.lit(name).alias("modelo"), p.cast("double").alias("p"))
        for name, p in scores.items()
    ]
    weight = F.when(F.col("is_fraud") == 0, 20.0).otherwise(1.0)
    return rows.select(
        F.col("is_fraud").alias("y"), weight.alias("w"), F.inline(F.array(*entries))
    )


def points(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.score_points(pseudo_scored(spark, sf), ["modelo"])


def predicted(spark: SparkSession, sf: str) -> DataFrame:
    """Decision of each model at its own best-F1 threshold. The thresholds are a one-row map
    with an entry per model, so no join is needed."""
    scored = pseudo_scored(spark, sf)
    chosen = metrics.choose_thresholds(metrics.score_points(scored, ["modelo"]), ["modelo"])
    limits = chosen.agg(
        F.map_from_entries(F.collect_list(F.struct("modelo", "f1"))).alias("m")
    ).scalar()
    limited = scored.withColumn("limiar", F.element_at(limits, F.col("modelo")))
    return metrics.apply_threshold(limited, "limiar")


# Sources and sinks


@query
def ingest_transactions_csv(spark, sf):
    folder = new_folder(spark, "landing")
    land(fixture.transactions(spark, sf), folder)
    return landing.read_transactions(spark, folder)


@query
def ingest_customers_csv(spark, sf):
    folder = new_folder(spark, "landing")
    fixture.customers(spark, sf).write.csv(folder, header=True, sep="|")
    return landing.read_customers(spark, folder)


@query
def ingest_rejected(spark, sf):
    """Landing files with planted bad cells: rows by what became of them, with the columns at fault."""
    folder = new_folder(spark, "landing")
    rows = fixture.transactions(spark, sf)
    bad = {"amt": (F.col("row_id") % 50 == 3, "n/a"), "unix_time": (F.col("row_id") % 70 == 5, "12:30")}
    planted = rows.select(*[
        F.when(bad[c][0], bad[c][1]).otherwise(F.col(c).cast("string")).alias(c) if c in bad else c for c in rows.columns
    ])
    land(planted, folder)
    accepted, rejected = landing.read_checked(spark, folder)
    columns = F.array_join(F.transform("motivo", lambda m: F.substring_index(m, ":", 1)), ",")
    ended = rejected.select(columns.alias("fim"), F.lit(None).cast("double").alias("amt"))
    return accepted.select(F.lit("aceita").alias("fim"), "amt").unionByName(ended).groupBy("fim").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("amt"), 2).alias("valor")
    )


@query
def infer_schema_profile(spark, sf):
    folder = new_folder(spark, "landing")
    fixture.customers(spark, sf).write.csv(folder, header=True, sep="|")
    return landing.schema_profile(landing.read_inferred(spark, folder, sep="|"))


@query
def peek_rows(spark, sf):
    """How many rows a peek gives, and how many of them the table holds."""
    folder = new_folder(spark, "landing")
    land(fixture.transactions(spark, sf), folder)
    rows = materialise(landing.peek(landing.read_transactions(spark, folder)).select("row_id", "amt"))
    known = rows.join(fixture.transactions(spark, sf, "row_id", "amt"), ["row_id", "amt"], "left_semi")
    return rows.agg(F.count(F.lit(1)).alias("linhas")).join(known.agg(F.count(F.lit(1)).alias("conhecidas")))


@query
def table_roundtrip(spark, sf):
    folder = new_folder(spark, "tables")
    etl.write_silver(fixture.transactions(spark, sf, *_raw(*schemas.SILVER.names)), folder)
    return tables.read_by_month(spark, folder).select(*schemas.SILVER.names)


@query
def sql_fraud_rate_by_category(spark, sf):
    return rates.sql_fraud_rate_by_category(silver(spark, sf, "category", "is_fraud"))


@query
def range_source(spark, sf):
    """Order numbers of the key range that no order uses."""
    keys = fixture.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id")).distinct()
    ends = keys.agg(F.min("id").alias("lo"), F.max("id").alias("hi")).first()
    numbers = spark.range(ends["lo"], ends["hi"] + 1)
    joined = numbers.join(keys.withColumn("here", F.lit(1)), "id", "left")
    return joined.agg(
        F.count(F.lit(1)).alias("n_faixa"),
        F.count("here").alias("n_presentes"),
        (F.count(F.lit(1)) - F.count("here")).alias("n_ausentes"),
    )


@query
def file_inventory(spark, sf):
    """Rows of each file of the tables."""
    parts = [landing.rows_per_file(fixture.table(spark, sf, name)) for name in fixture.TABLES]
    return reduce(DataFrame.unionByName, parts).select("arquivo", "linhas")


@query
def missing_files(spark, sf):
    """Monthly files to expect from the shipping dates, less those the order dates supply."""

    def names(table, ts):
        month = F.date_format(ts, "yyyy-MM")
        name = F.concat(F.lit("transactions_"), month, F.lit(".csv")).alias("arquivo")
        return fixture.table(spark, sf, table).select(name)

    return landing.missing_files(names("lineitem", "l_shipdate"), names("orders", "o_orderdate"))


@query
def metrics_sink(spark, sf):
    folder = new_folder(spark, "metricas")
    summary = metrics.metric_summary(points(spark, sf))
    tables.write_metrics_csv(summary, folder)
    saved = spark.read.csv(
        folder, header=True,
        schema="modelo string, pr_auc_w double, roc_auc_w double, recall_p90_w double",
    )
    return rounded(saved, 9, "pr_auc_w", "roc_auc_w", "recall_p90_w")


@query
def append_history(spark, sf):
    """Three rounds of challenger against champion, each appended to the history."""
    folder = new_folder(spark, "historico")
    quality_by_model = materialise(metrics.average_precision(points(spark, sf), ["modelo"]))
    current, history = None, None
    for stamp, name in (("r1", "valor"), ("r2", "distancia"), ("r3", "idade")):
        challenger = quality_by_model.filter(F.col("modelo") == name)
        verdict = metrics.promotion(challenger, current).withColumn("data", F.lit(stamp))
        history = tables.append_history(spark, folder, verdict)
        if history.filter(F.col("data") == stamp).first()["promovido"]:
            current = challenger
    return rounded(history, 9, "pr_auc_desafiante", "pr_auc_atual")


@query
def run_log(spark, sf):
    summary = metrics.metric_summary(points(spark, sf))
    runs = summary.select(
        F.concat("modelo", F.lit("_pontuacao")).alias("run"),
        F.create_map(
            F.lit("modelo"), "modelo", F.lit("balanceamento"), F.lit("nenhum")
        ).alias("params"),
        F.create_map(
            F.lit("pr_auc_w"), "pr_auc_w", F.lit("roc_auc_w"), "roc_auc_w"
        ).alias("metrics"),
    )
    log = tables.log_runs(spark, new_folder(spark, "execucoes"), runs)
    return log.select(
        "run",
        F.col("params")["modelo"].alias("modelo"),
        F.col("params")["balanceamento"].alias("balanceamento"),
        F.round(F.col("metrics")["pr_auc_w"], 9).alias("pr_auc_w"),
        F.round(F.col("metrics")["roc_auc_w"], 9).alias("roc_auc_w"),
    )


# Projections and scalar functions


@query
def parse_event_time(spark, sf):
    return silver(spark, sf, "trans_num", "amt", "event_time")


@query
def hash_pii(spark, sf):
    return silver(spark, sf, "trans_num", "amt", "customer_hash")


@query
def age_at_event(spark, sf):
    return silver(spark, sf, "trans_num", "event_time", "amt", "age")


@query
def haversine_km(spark, sf):
    return silver(spark, sf, "trans_num", "amt", "distance_km")


@query
def calendar_features(spark, sf):
    return silver(spark, sf, "trans_num", "amt", "hour", "day_of_week", "month")


@query
def silver_transactions(spark, sf):
    return silver(spark, sf)


@query
def epoch_seconds(spark, sf):
    rows = silver(spark, sf, "trans_num", "amt", "event_time")
    return rows.select("trans_num", "amt", C.epoch_seconds().alias("event_ts"))


@query
def sample_weights(spark, sf):
    return sampling.sample_weights(silver(spark, sf, "trans_num", "amt", "is_fraud"), 0.02)


@query
def class_label(spark, sf):
    rows = silver(spark, sf, "trans_num", "amt", "is_fraud")
    return rows.withColumn("classe", C.class_label())


@query
def target_distribution(spark, sf):
    return rounded(stats.target_distribution(silver(spark, sf, "is_fraud")), 9, "pct")


# Filters


@query
def time_split(spark, sf):
    rows = silver(spark, sf, "event_time", "is_fraud")
    sides = sampling.time_split(rows, sampling.time_cutoff(rows))
    parts = [
        side.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("is_fraud").alias("fraudes"),
            F.min("event_time").alias("inicio"),
            F.max("event_time").alias("fim"),
        ).select(F.lit(name).alias("parte"), "*")
        for name, side in zip(("train", "test"), sides)
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def fraud_count_by_table(spark, sf):
    names = ("trans_num", "event_time", "is_fraud")
    train, test = gold(spark, sf, *names)
    layers = {"silver": silver(spark, sf, "is_fraud"), "train": train, "test": test}
    return quality.fraud_count_by_table(layers)


@query
def apply_threshold(spark, sf):
    rows = silver(spark, sf, "trans_num", "amt")
    scored = rows.select("trans_num", amount_score().alias("p"))
    return metrics.apply_threshold(scored, 0.5)


# Aggregations and statistics


@query
def row_count(spark, sf):
    return quality.row_count(silver(spark, sf, "is_fraud"))


@query
def class_balance(spark, sf):
    return quality.class_balance(silver(spark, sf, "is_fraud"))


@query
def null_audit(spark, sf):
    return quality.null_audit(silver(spark, sf))


@query
def time_range(spark, sf):
    return quality.time_range(silver(spark, sf, "event_time"))


@query
def approx_distinct_ids(spark, sf):
    """Whether the estimate lies within three standard errors of the exact count."""
    rows = silver(spark, sf, "trans_num")
    guess = quality.approx_distinct_ids(rows).withColumnRenamed("ids_distintos", "estimativa")
    both = quality.distinct_ids(rows).join(guess, "linhas")
    near = F.abs(F.col("estimativa") - F.col("ids_distintos")) <= 0.15 * F.col("ids_distintos")
    return both.select("ids_distintos", "linhas", near.alias("dentro_do_limite"))


@query
def distinct_ids(spark, sf):
    return quality.distinct_ids(silver(spark, sf, "trans_num"))


@query
def duplicate_ids(spark, sf):
    return quality.duplicate_ids(silver(spark, sf, "trans_num"))


@query
def dedup_latest(spark, sf):
    return quality.dedup_latest(silver(spark, sf))


@query
def numeric_summary(spark, sf):
    rows = silver(spark, sf, "amt", "age", "distance_km", "city_pop")
    return rounded(quality.numeric_summary(rows), 6, "media", "desvio", "p25", "p50", "p75")


@query
def rate_by_category(spark, sf):
    return rounded(rates.rate_by_category(silver(spark, sf, "category", "is_fraud")), 9, "taxa")


@query
def rate_by_amount_band(spark, sf):
    return rounded(rates.rate_by_amount_band(silver(spark, sf, "amt", "is_fraud")), 9, "taxa")


@query
def rate_by_hour(spark, sf):
    return rounded(rates.rate_by_hour(silver(spark, sf, "hour", "is_fraud")), 9, "taxa")


@query
def rate_by_age_decade(spark, sf):
    return rounded(rates.rate_by_age_decade(silver(spark, sf, "age", "is_fraud")), 9, "taxa")


@query
def rate_by_state(spark, sf):
    return rounded(rates.rate_by_state(silver(spark, sf, "state", "is_fraud")), 9, "taxa")


@query
def top_states(spark, sf):
    return rounded(rates.top_states(silver(spark, sf, "state", "is_fraud")), 9, "taxa")


@query
def monthly_fraud(spark, sf):
    return rounded(rates.monthly_fraud(silver(spark, sf, "event_time", "is_fraud")), 9, "taxa")


@query
def dow_hour_pivot(spark, sf):
    grid = rates.dow_hour_pivot(silver(spark, sf, "day_of_week", "hour", "is_fraud"))
    return rounded(grid, 9, *[c for c in grid.columns if c != "day_of_week"])


@query
def rate_by_band_period(spark, sf):
    return rates.rate_by_band_period(silver(spark, sf, "amt", "hour", "is_fraud"))


@query
def top_merchants(spark, sf):
    """Merchants of the test tables have about 600 transactions each at every scale."""
    return rates.top_merchants(silver(spark, sf, "merchant", "is_fraud"), min_volume=600)


@query
def top_fraud_customers(spark, sf):
    return rates.top_fraud_customers(silver(spark, sf, "customer_hash", "amt", "is_fraud"))


@query
def overall_rate(spark, sf):
    return rounded(rates.overall_rate(silver(spark, sf, "is_fraud")), 9, "taxa_media", "taxa_razao")


@query
def imbalance_ratio(spark, sf):
    return rounded(rates.imbalance_ratio(silver(spark, sf, "is_fraud")), 9, "razao")


@query
def correlation_matrix(spark, sf):
    rows = silver(spark, sf, *stats.NUMERIC_AND_TARGET)
    return rounded(stats.correlation_matrix(rows), 9, "correlacao")


@query
def target_correlation(spark, sf):
    rows = silver(spark, sf, *stats.NUMERIC_AND_TARGET)
    return rounded(stats.target_correlation(rows), 9, "correlacao")


@query
def describe_by_class(spark, sf):
    rows = silver(spark, sf, "amt", "distance_km", "is_fraud")
    return rounded(stats.describe_by_class(rows), 6, "media", "desvio", "p25", "p50", "p75")


@query
def log_histogram(spark, sf):
    out = stats.log_histogram(silver(spark, sf, "amt", "is_fraud"))
    return rounded(rounded(out, 6, "inicio", "fim"), 9, "densidade")


@query
def linear_histogram(spark, sf):
    out = stats.linear_histogram(silver(spark, sf, "distance_km", "is_fraud"))
    return rounded(rounded(out, 6, "inicio", "fim"), 9, "densidade")


@query
def reconcile_layers(spark, sf):
    rows = silver(spark, sf, "trans_num", "event_time", "is_fraud")
    cutoff = sampling.time_cutoff(silver(spark, sf, "event_time"))
    return quality.reconcile_layers(rows, *etl.to_gold(rows, cutoff), cutoff)


@query
def top_models(spark, sf):
    summary = metrics.metric_summary(points(spark, sf)).select("modelo", "pr_auc_w")
    return rounded(metrics.top_models(summary), 9, "pr_auc_w")


@query
def best_model(spark, sf):
    return rounded(metrics.best_model(metrics.fraud_class_summary(predicted(spark, sf))), 9, "f1")


# Sampling, splitting, balancing


@query
def time_cutoff(spark, sf):
    return sampling.time_cutoff_frame(silver(spark, sf, "event_time"))


@query
def stratified_sample(spark, sf):
    return sampling.stratified_sample(silver(spark, sf), 0.006)


@query
def gold_train(spark, sf):
    return gold(spark, sf)[0]


@query
def gold_test(spark, sf):
    return gold(spark, sf)[1]


@query
def fixed_n_sample(spark, sf):
    rows = silver(spark, sf)
    _, after = sampling.time_split(rows, sampling.time_cutoff(silver(spark, sf, "event_time")))
    return sampling.fixed_n_sample(after, 1000)


@query
def smotenc_neighbors(spark, sf):
    """Nearest frauds of every fraud, over all transactions with a unique id."""
    rows = materialise(quality.dedup_latest(silver(spark, sf)))
    encoding = features.fit_encoding(rows)
    frauds = encoding.apply(rows.filter("is_fraud = 1"))
    codes = [f"{c}_cod" for c in encoding.categories]
    numbers = [f"{c}_pad" for c in encoding.moments]
    return rounded(balance.minority_neighbours(frauds, numbers, codes), 6, "distancia")


@query
def smotenc(spark, sf):
    """Rows by kind, and whether every synthetic fraud lies within the real ones in each number."""
    train, _ = modelling(spark, sf)
    encoding, balanced = retrain.prepare(train)
    numbers = [f"{c}_pad" for c in encoding.moments]
    frauds = balanced.filter("is_fraud = 1 and not sintetico")
    ends = frauds.agg(*[F.min(c).alias(f"lo_{c}") for c in numbers], *[F.max(c).alias(f"hi_{c}") for c in numbers]).first()
    inside = reduce(
        lambda a, b: a & b, [F.col(c).between(ends[f"lo_{c}"] - 1e-9, ends[f"hi_{c}"] + 1e-9) for c in numbers]
    )
    return balanced.groupBy("is_fraud", "sintetico").agg(
        F.count(F.lit(1)).alias("n"), F.min(inside | ~F.col("sintetico")).alias("dentro")
    )


@query
def smotenc_repeated_ids(spark, sf):
    """Rows by kind after oversampling a training table whose ids repeat."""
    rows = silver(spark, sf)
    cutoff = sampling.time_cutoff(silver(spark, sf, "event_time"))
    train, _ = etl.to_gold(rows, cutoff, MODELLING_FRACTION, 0.05)
    return retrain.prepare(materialise(train))[1].groupBy("is_fraud", "sintetico").agg(F.count(F.lit(1)).alias("n"))


@query
def balance_before_after(spark, sf):
    train, _ = modelling(spark, sf)
    return balance.balance_before_after(retrain.prepare(train)[1])


@query
def class_proportion(spark, sf):
    return stats.class_proportion(gold(spark, sf, "trans_num", "event_time", "is_fraud")[0])


# Encoding: learnt from train, applied to test


@query
def ordinal_encode(spark, sf):
    train, test = modelling(spark, sf)
    encoding = features.fit_encoding(train)
    return encoding.apply(test).select("trans_num", *[f"{c}_cod" for c in encoding.categories])


@query
def standard_scale(spark, sf):
    train, test = modelling(spark, sf)
    encoding = features.fit_encoding(train)
    names = [f"{c}_pad" for c in encoding.moments]
    return rounded(encoding.apply(test).select("trans_num", *names), 9, *names)


@query
def one_hot(spark, sf):
    """Sum of every position of the one-hot vectors of the test rows."""
    train, test = modelling(spark, sf)
    encoding = features.fit_encoding(train)
    stages = features.one_hot_stages(spark, encoding)
    vectors = PipelineModel(stages=[*encoding.stages(), *stages]).transform(test)
    cells = vectors.select(F.posexplode(vector_to_array("features")).alias("posicao", "v"))
    return cells.groupBy("posicao").agg(F.round(F.sum("v"), 6).alias("soma"))


@query
def feature_vector(spark, sf):
    """The assembled vector, one column per position."""
    train, test = modelling(spark, sf)
    encoding = features.fit_encoding(train)
    stages = [*encoding.stages(), features.assembler(encoding)]
    vectors = PipelineModel(stages=stages).transform(test)
    cells = vectors.select("trans_num", vector_to_array("features").alias("v"))
    return cells.select(
        "trans_num",
        *[F.round(F.col("v")[i], 9).alias(c) for i, c in enumerate(encoding.columns)],
    )


# Training, scoring, evaluation


def _trained(spark, sf, names):
    """Per model, with its full rounds: rows and frauds it was measured on, whether all scores are
    probabilities, and whether it beats chance on the untouched test rows in both areas."""
    train, test = modelling(spark, sf)
    encoding, balanced = retrain.prepare(train)
    _, scored, failures = models.train_all(names, balanced, test, encoding)
    if failures:
        raise RuntimeError(f"models failed: {failures}")
    scored = materialise(scored)
    summary = metrics.metric_summary(metrics.score_points(scored, ["modelo"]))
    sizes = scored.groupBy("modelo").agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count_if(F.col("y") == 1).alias("fraudes"),
        F.min(F.col("p").between(0, 1)).alias("probabilidades"),
        F.try_divide(F.sum(F.col("y") * F.col("w")), F.sum("w")).alias("_acaso"),
    )
    return sizes.join(summary, "modelo").select(
        "modelo", "linhas", "fraudes", "probabilidades",
        (F.col("roc_auc_w") > 0.5).alias("roc_acima_do_acaso"),
        (F.col("pr_auc_w") > F.col("_acaso")).alias("pr_acima_do_acaso"),
    )


@query
def model_logreg(spark, sf):
    return _trained(spark, sf, ["regressao_logistica"])


@query
def model_tree(spark, sf):
    return _trained(spark, sf, ["arvore_decisao"])


@query
def model_forest(spark, sf):
    return _trained(spark, sf, ["random_forest"])


@query
def model_gbt(spark, sf):
    return _trained(spark, sf, list(models.BOOSTED))


@query
def model_gbt_depth(spark, sf):
    return _trained(spark, sf, ["xgboost"])


@query
def model_gbt_hist(spark, sf):
    return _trained(spark, sf, ["hist_gradient_boosting"])


@query
def model_adaboost(spark, sf):
    return _trained(spark, sf, ["adaboost"])


@query
def compare_models(spark, sf):
    """The comparison job over all learners: ranked, logged, explained, winner saved."""
    train, test = modelling(spark, sf)
    cfg = compare.CompareConfig(new_folder(spark, "comparacao"))
    ranked = materialise(compare.compare_models(spark, train, test, cfg))
    runs = spark.read.parquet(cfg.path("execucoes")).select(F.col("params")["modelo"].alias("modelo")).distinct()
    saved = spark.read.csv(cfg.path("metricas"), header=True, inferSchema=True)
    best = PipelineModel.load(cfg.path("melhor"))
    explained = spark.read.parquet(cfg.path("importancia")).count()
    size = models.score(test, best, ["is_fraud"]).filter("p between 0 and 1").count()
    return ranked.join(runs.withColumn("registrado", F.lit(True)), "modelo", "left").join(
        saved.select("modelo", (F.col("segundos") > 0).alias("medido")), "modelo", "left"
    ).select(
        "modelo",
        F.coalesce("registrado", F.lit(False)).alias("registrado"),
        F.coalesce("medido", F.lit(False)).alias("medido"),
        (F.col("roc_auc_w") > 0.5).alias("acima_do_acaso"),
        F.lit(size).cast("long").alias("linhas_pontuadas"),
        F.lit(explained).cast("long").alias("variaveis"),
    )


def _tree(spark, sf):
    train, test = modelling(spark, sf)
    encoding, balanced = retrain.prepare(train)
    return encoding, models.fit_model("arvore_decisao", balanced, encoding), test


def _checked(answers, keep):
    p = F.col("probabilidade_fraude")
    return answers.select(
        *keep,
        "limiar",
        p.between(0, 1).alias("probabilidade"),
        (F.col("fraude") == (p >= F.col("limiar"))).alias("decisao_coerente"),
    )


@query
def score_batch(spark, sf):
    """Every test row has a probability, and a decision that follows from it."""
    encoding, model, test = _tree(spark, sf)
    return _checked(models.score_batch(test, models.with_encoder(encoding, model), 0.5, ["trans_num"]), ["trans_num"])


@query
def score_agreement(spark, sf):
    encoding, model, test = _tree(spark, sf)
    full = models.with_encoder(encoding, model)
    folder = new_folder(spark, "modelo")
    full.write().save(folder)
    return models.score_agreement(test, full, PipelineModel.load(folder))


@query
def permutation_importance(spark, sf):
    """Each variable has one importance, a drop of an area; shuffling the best one costs some."""
    encoding, model, test = _tree(spark, sf)
    drops = materialise(models.permutation_importance(test, model, encoding))
    best = drops.agg(F.max("importancia").alias("maior"))
    return drops.join(best).select(
        "variavel",
        (F.abs("importancia") <= 1).alias("no_intervalo"),
        (F.col("maior") > 0).alias("alguma_positiva"),
    )


@query
def pr_curve(spark, sf):
    return rounded(metrics.pr_curve(points(spark, sf), ["modelo"]), 9, "precisao", "recall")


@query
def average_precision(spark, sf):
    return rounded(metrics.average_precision(points(spark, sf), ["modelo"]), 9, "pr_auc_w")


@query
def roc_curve(spark, sf):
    return rounded(metrics.roc_curve(points(spark, sf), ["modelo"]), 9, "fpr", "tpr")


@query
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(points(spark, sf), ["modelo"]), 9, "roc_auc_w")


@query
def recall_at_p90(spark, sf):
    return rounded(metrics.recall_at_precision(points(spark, sf), ["modelo"]), 9, "recall_p90_w")


@query
def choose_thresholds(spark, sf):
    return metrics.choose_thresholds(points(spark, sf), ["modelo"])


@query
def classification_report(spark, sf):
    report = metrics.classification_report(predicted(spark, sf), ["modelo"])
    return rounded(report, 9, "precisao", "recall", "f1")


@query
def fraud_class_summary(spark, sf):
    summary = metrics.fraud_class_summary(predicted(spark, sf))
    return rounded(summary, 9, "precisao", "recall", "f1", "alarme_falso")


@query
def confusion_matrix(spark, sf):
    return rounded(metrics.confusion_matrix(predicted(spark, sf), ["modelo"]), 9, "pct")


@query
def no_skill_rate(spark, sf):
    rows = sampling.sample_weights(silver(spark, sf, "is_fraud"), 0.05)
    return rounded(metrics.no_skill_rate(rows, "is_fraud", "sample_weight"), 9, "taxa_real")


@query
def mean_importance(spark, sf):
    """Features by their mean share of the positive correlation with fraud in each state."""
    rows = silver(spark, sf, "state", *schemas.NUMERIC, "is_fraud")
    by_state = rows.groupBy("state").agg(
        *[
            F.coalesce(
                F.try_divide(
                    F.covar_pop(c, "is_fraud"), F.stddev_pop(c) * F.stddev_pop("is_fraud")
                ),
                F.lit(0.0),
            ).alias(c)
            for c in schemas.NUMERIC
        ]
    )
    long = by_state.unpivot(["state"], schemas.NUMERIC, "variavel", "importancia")
    return rounded(metrics.mean_importance(long.withColumnRenamed("state", "modelo")), 9, "media")


@query
def promote_if_better(spark, sf):
    quality_by_model = materialise(metrics.average_precision(points(spark, sf), ["modelo"]))
    verdict = metrics.promotion(
        quality_by_model.filter("modelo = 'distancia'"), quality_by_model.filter("modelo = 'valor'")
    )
    return rounded(verdict, 9, "pr_auc_desafiante", "pr_auc_atual")


# Streaming


@query
def stream_silver(spark, sf):
    root = new_folder(spark, "stream")
    land(fixture.transactions(spark, sf), f"{root}/landing")
    return ingest.ingest_available(
        spark, f"{root}/landing", f"{root}/silver", f"{root}/checkpoint", max_files=4
    )


@query
def stream_bronze(spark, sf):
    """Raw rows as the stream keeps them, beside the silver rows of the same batches."""
    root = new_folder(spark, "stream")
    land(fixture.transactions(spark, sf), f"{root}/landing")
    ingest.ingest_available(
        spark, f"{root}/landing", f"{root}/silver", f"{root}/checkpoint", 4, bronze=f"{root}/bronze"
    )
    return spark.read.schema(schemas.TRANSACTIONS).parquet(f"{root}/bronze").select(*schemas.TRANSACTIONS.names)


@query
def stream_rejected(spark, sf):
    """Requests of which every tenth order lacks its amount or is no JSON: how each kind ended."""
    encoding, model, test = _tree(spark, sf)
    root = new_folder(spark, "stream")
    slot = F.pmod(F.substring_index("trans_num", "-", 1).cast("long"), F.lit(10))
    text = F.to_json(F.struct(F.col("trans_num").alias("id"), *schemas.FEATURES))
    bare = F.to_json(F.struct(F.col("trans_num").alias("id"), *[c for c in schemas.FEATURES if c != "amt"]))
    lines = test.select(F.when(slot == 3, bare).when(slot == 7, F.concat(F.lit("?"), text)).otherwise(text).alias("value"))
    lines.write.text(f"{root}/requests")
    answers = scoring.score_available(
        spark, models.with_encoder(encoding, model), f"{root}/requests", f"{root}/answers",
        f"{root}/checkpoint", rejected=f"{root}/rejected", max_files=4,
    )
    bad = spark.read.parquet(f"{root}/rejected")
    ended = answers.select(F.lit("answered").alias("fim")).unionByName(bad.select(F.col("motivo").alias("fim")))
    return ended.groupBy("fim").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_score(spark, sf):
    encoding, model, test = _tree(spark, sf)
    root = new_folder(spark, "stream")
    test.select(F.to_json(F.struct(*schemas.FEATURES)).alias("value")).write.text(f"{root}/requests")
    answers = scoring.score_available(
        spark, models.with_encoder(encoding, model),
        f"{root}/requests", f"{root}/answers", f"{root}/checkpoint",
    )
    return _checked(answers, schemas.FEATURES)


@query
def stream_dedup(spark, sf):
    """Files of which every fifth row is delivered again in later micro-batches and a later run: the
    table has each row once."""
    root = new_folder(spark, "stream")
    rows = fixture.transactions(spark, sf)
    saved = f"{root}/rows"
    tables.overwrite(rows, saved)
    rows = spark.read.schema(schemas.TRANSACTIONS).parquet(saved)
    again = rows.where("row_id % 5 = 0")
    for run in ([rows.where("row_id % 2 = 0"), again], [rows.where("row_id % 2 = 1"), again]):
        for part in run:
            land(part, f"{root}/landing")
        found = ingest.ingest_first(
            spark, f"{root}/landing", f"{root}/silver", f"{root}/checkpoint", schemas.TRANSACTIONS.names, max_files=6
        )
    return found


@query
def stream_monthly(spark, sf):
    """Monthly rates of files that arrive by year, then one with rows of all years that come late."""
    root = new_folder(spark, "stream")
    saved = f"{root}/rows"
    tables.overwrite(fixture.transactions(spark, sf), saved)
    rows = spark.read.schema(schemas.TRANSACTIONS).parquet(saved)
    years = rows.agg(F.min("trans_date").alias("a"), F.max("trans_date").alias("b")).first()
    late = F.col("row_id") % 20 == 0
    arrivals = [
        rows.where(~late & F.col("trans_date").startswith(str(year)))
        for year in range(int(years["a"][:4]), int(years["b"][:4]) + 1)
    ]
    # A run after each arrival takes its files, however many, as one micro-batch.
    for part in [*arrivals, rows.where(late)]:
        land(part, f"{root}/landing")
        found = ingest.monthly_available(spark, f"{root}/landing", f"{root}/sums", f"{root}/checkpoint")
    return rounded(found, 9, "taxa")


# Stored sketches


def _sketches(spark, sf) -> DataFrame:
    root = new_folder(spark, "sketches")
    tables.overwrite_by_month(silver(spark, sf), f"{root}/silver")
    sketches.store_months(spark, f"{root}/silver", f"{root}/store")
    return sketches.read_store(spark, f"{root}/store")


@query
def sketch_cutoff(spark, sf):
    """The cutoff of the merged monthly sketches against its exact rank."""
    cut = sketches.merged_cutoff(_sketches(spark, sf)).first()["corte"]
    rank = F.count_if(F.unix_seconds("event_time") <= cut) / F.count(F.lit(1))
    return silver(spark, sf, "event_time").agg(
        F.count(F.lit(1)).alias("linhas"), (F.abs(rank - 0.8) <= sketches.RANK_ERROR).alias("dentro_do_erro")
    )


@query
def sketch_distinct(spark, sf):
    """Distinct ids of the merged monthly sketches beside the exact count."""
    estimate = sketches.merged_distinct(_sketches(spark, sf))
    exact = quality.distinct_ids(silver(spark, sf, "trans_num"))
    gap = F.abs(F.col("ids_estimados") - F.col("ids_distintos"))
    return estimate.withColumnRenamed("linhas", "linhas_somadas").join(exact).select(
        "ids_distintos", "linhas", (F.col("linhas_somadas") == F.col("linhas")).alias("linhas_iguais"),
        (gap <= sketches.DISTINCT_ERROR * F.col("ids_distintos")).alias("dentro_do_limite"),
    )


@query
def sketch_returning(spark, sf):
    """Ids of each month that return in a later one: the exact number, and whether the intersection of
    the sketches is within four standard errors of it."""
    found = sketches.returning_ids(_sketches(spark, sf))
    month = F.date_format("event_time", "yyyy-MM").alias("event_month")
    seen = silver(spark, sf, "trans_num", "event_time").select("trans_num", month).distinct()
    last = seen.groupBy("trans_num").agg(F.max("event_month").alias("ultimo"))
    exact = seen.join(last, "trans_num").groupBy("event_month").agg(
        F.count_if(F.col("event_month") < F.col("ultimo")).alias("ids")
    )
    near = F.abs(F.col("voltam") - F.col("ids")) <= 4 * F.greatest(F.col("erro_padrao"), F.sqrt("ids")) + 1
    return exact.join(found, "event_month").select("event_month", "ids", near.alias("dentro_do_limite"))


# Whole jobs


def _run_etl(spark, sf):
    """Settings of a full job from landing files with the exact cutoff, and the audit it returned."""
    root = new_folder(spark, "etl")
    land(fixture.transactions(spark, sf), f"{root}/landing/transactions")
    land(fixture.customers(spark, sf), f"{root}/landing/customers", sep="|")
    cfg = etl.EtlConfig(
        root, f"{root}/landing/transactions", f"{root}/landing/customers",
        rebuild_bronze=True, cutoff_error=0.0,
    )
    return cfg, etl.run_etl(spark, cfg)


@query
def etl_silver(spark, sf):
    cfg, _ = _run_etl(spark, sf)
    saved = tables.read_by_month(spark, cfg.path("silver/transactions"))
    return saved.select(*schemas.SILVER.names)


@query
def etl_gold(spark, sf):
    cfg, _ = _run_etl(spark, sf)
    parts = [
        etl.read_gold(spark, cfg, name).select(F.lit(name).alias("parte"), "*")
        for name in ("train", "test")
    ]
    return parts[0].unionByName(parts[1])


def _replace_files(spark, source, target) -> None:
    """Moves the files of a folder onto those of another that the same tasks wrote from fewer rows;
    files of tasks that had no such rows land under new names."""
    found = [spark.read.text(f).inputFiles() for f in (source, target)]
    new, old = ({f.rsplit("/part-", 1)[1].split("-")[0]: f for f in files} for files in found)
    if not old.keys() <= new.keys():
        raise RuntimeError("a landed file has no successor")
    for task, file in new.items():
        tables.replace_file(spark, file, old.get(task, f"{target}/{file.rsplit('/', 1)[1]}"))


@query
def etl_incremental(spark, sf):
    """Silver and gold after two incremental runs, a third that finds nothing new, and files that
    grew under their names before the second."""
    root = new_folder(spark, "etl")
    saved = f"{root}/rows"
    tables.overwrite(fixture.transactions(spark, sf), saved)
    rows = spark.read.schema(schemas.TRANSACTIONS).parquet(saved)
    cfg = etl.EtlConfig(root, f"{root}/landing", cutoff_error=0.0)
    land(rows.where("row_id % 3 = 0"), f"{root}/landing/a")
    land(rows.where("row_id % 3 = 1 and row_id % 2 = 0"), f"{root}/landing/b")
    etl.run_incremental(spark, cfg)
    land(rows.where("row_id % 3 = 1"), f"{root}/later")
    _replace_files(spark, f"{root}/later", f"{root}/landing/b")
    land(rows.where("row_id % 3 = 2"), f"{root}/landing/c")
    etl.run_incremental(spark, cfg)
    again = etl.run_incremental(spark, cfg).count()
    parts = [etl.read_loaded(spark, cfg).select(F.lit("silver").alias("parte"), "*", F.lit(None).cast("double").alias("sample_weight"))]
    parts += [etl.read_gold(spark, cfg, n).select(F.lit(n).alias("parte"), "*") for n in ("train", "test")]
    return reduce(DataFrame.unionByName, parts).withColumn("novos", F.lit(again).cast("long"))


@query
def customer_history(spark, sf):
    """All transactions of the customer with the most (ties: the smaller hash), looked up in the
    clustered layout, with the running number."""
    root = new_folder(spark, "clustered")
    # The clustered layout reads its rows three times, so they are joined and saved once before.
    rows = new_folder(spark, "rows")
    tables.overwrite(etl.unhashed(fixture.transactions(spark, sf)), rows)
    tables.overwrite_clustered(etl.with_hash(spark.read.parquet(rows)), root)
    saved = tables.read_by_month(spark, root)
    busiest = saved.groupBy("customer_hash").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "customer_hash").first()
    return rates.customer_history(saved, busiest["customer_hash"] if busiest else None)


@query
def retrain_summary(spark, sf):
    """Two retrains in a row: the first has no champion, the second challenges it with an equal."""
    train, test = modelling(spark, sf)
    cfg = retrain.RetrainConfig(new_folder(spark, "retreino"))
    runs = [retrain.retrain(spark, train, test, cfg).withColumn("rodada", F.lit(i)) for i in (1, 2)]
    return runs[0].unionByName(runs[1]).select(
        "rodada",
        "promovido",
        F.col("pr_auc_atual").isNotNull().alias("havia_campeao"),
        F.col("pr_auc_desafiante").between(0, 1).alias("area_valida"),
    )


@query
def etl_audit(spark, sf):
    """What the writes of the full job counted: one row per table and null count."""
    _, audit = _run_etl(spark, sf)
    cells = audit.select("*", F.explode("nulos").alias("coluna", "n_nulos"))
    return cells.drop("nulos").withColumnRenamed("n_nulos", "nulos")
