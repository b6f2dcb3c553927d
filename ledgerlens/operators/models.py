"""Training, scoring, boosting and permutation importance on Spark ML."""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence
from dataclasses import replace
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.columns import decision
from ledgerlens.operators import boosting, metrics
from ledgerlens.operators.boosting import Growth
from ledgerlens.operators.features import Encoding, assembler, one_hot_stages
from ledgerlens.operators.running import hash_ranks
from ledgerlens.operators.sampling import fixed_n_sample
from ledgerlens.session import materialise, new_folder

SEED = 42
FITS = 4  # learners that are fitted at the same time

# Hyper-parameters of each model.
LOGISTIC = {"maxIter": 300, "standardization": False}
TREE = {"maxDepth": 12, "minInstancesPerNode": 50, "maxBins": 64, "seed": SEED}
FOREST = {
    "numTrees": 100, "maxDepth": 12, "minInstancesPerNode": 20, "maxBins": 64,
    "featureSubsetStrategy": "sqrt", "seed": SEED, "maxMemoryInMB": 1024, "cacheNodeIds": True,
}
BOOSTED = {
    "hist_gradient_boosting": Growth(maxIter=200, stepSize=0.1, leaves=31, min_rows=20, min_hessian=1e-3, seed=SEED),
    "lightgbm": Growth(
        maxIter=300, stepSize=0.05, leaves=63, min_rows=20, min_hessian=1e-3, row_share=0.8, feature_share=0.8, seed=SEED
    ),
    "xgboost": Growth(
        maxIter=300, stepSize=0.1, leaves=256, depth=8, min_hessian=1.0, l2=1.0, row_share=0.8, feature_share=0.8, seed=SEED
    ),
}
ADABOOST = Growth(maxIter=100, leaves=8, depth=3, seed=SEED)
MODELS = [
    "regressao_logistica", "arvore_decisao", "random_forest", *BOOSTED, "adaboost",
]


def _columns(target: str) -> dict[str, str]:
    return {"labelCol": target, "featuresCol": "features"}


def _fit_vector(train: DataFrame, stages: list, estimator: Estimator) -> PipelineModel:
    ready = PipelineModel(stages=stages).transform(train)
    model = estimator.fit(ready)
    if getattr(model, "hasSummary", False):
        # The summary holds the training frame and would go with every scoring task, if it can be
        # shipped at all; the saved form is the model alone.
        folder = new_folder(train.sparkSession, "fitted")
        model.write().save(folder)
        model = type(model).load(folder)
    return PipelineModel(stages=[*stages, model])


def fit_logistic(train: DataFrame, encoding: Encoding, target: str, **params) -> PipelineModel:
    """Unit L2 penalty on the summed loss, hence 1/n on Spark's mean loss."""
    stages = one_hot_stages(train.sparkSession, encoding)
    penalty = 1.0 / max(1, train.count())
    estimator = LogisticRegression(**_columns(target), regParam=penalty, **(LOGISTIC | params))
    return _fit_vector(train, stages, estimator)


def fit_tree(train: DataFrame, encoding: Encoding, target: str, **params) -> PipelineModel:
    estimator = DecisionTreeClassifier(**_columns(target), **(TREE | params))
    return _fit_vector(train, [assembler(encoding)], estimator)


def fit_forest(train: DataFrame, encoding: Encoding, target: str, **params) -> PipelineModel:
    estimator = RandomForestClassifier(**_columns(target), **(FOREST | params))
    return _fit_vector(train, [assembler(encoding)], estimator)


def fit_boosted(
    train: DataFrame, encoding: Encoding, target: str, kind: str = "lightgbm", **params
) -> PipelineModel:
    """Gradient boosting of leaf-wise trees on the logistic loss; ``params`` are fields of Growth."""
    growth = replace(BOOSTED[kind], **params)
    base, trees, edges = boosting.fit_gradient(train, encoding.columns, target, growth)
    weights, size = [1.0] * len(trees), len(encoding.columns)
    # Spark's probability is the logistic function of twice the sum.
    model = boosting.spark_model(train.sparkSession, trees, weights, edges, 0.5, size, target, base)
    return PipelineModel(stages=[assembler(encoding), model])


def fit_adaboost(train: DataFrame, encoding: Encoding, target: str, **params) -> PipelineModel:
    """Discrete boosting of shallow trees: after each round the rows it got wrong gain weight. The
    probability is the logistic function of the mean vote, weighted by the trees' votes."""
    growth = replace(ADABOOST, **params)
    votes, trees, edges = boosting.fit_votes(train, encoding.columns, target, growth)
    weights, size = [v / (2 * sum(votes)) for v in votes], len(encoding.columns)
    model = boosting.spark_model(train.sparkSession, trees, weights, edges, 1.0, size, target)
    return PipelineModel(stages=[assembler(encoding), model])


def fit_model(name: str, train: DataFrame, encoding: Encoding, target: str = "is_fraud", **params):
    if name in BOOSTED:
        return fit_boosted(train, encoding, target, name, **params)
    fit = {
        "regressao_logistica": fit_logistic,
        "arvore_decisao": fit_tree,
        "random_forest": fit_forest,
        "adaboost": fit_adaboost,
    }[name]
    return fit(train, encoding, target, **params)


def with_encoder(encoding: Encoding, model: PipelineModel) -> PipelineModel:
    """Full pipeline from raw feature columns to probability, ready to save."""
    return PipelineModel(stages=[*encoding.stages(), *model.stages])


def without_encoder(encoding: Encoding, model: PipelineModel) -> PipelineModel:
    """The part of a full pipeline that takes encoded columns."""
    return PipelineModel(stages=model.stages[len(encoding.stages()) :])


def probability(df: DataFrame, column: str = "probability") -> Column:
    """Probability of the positive class, whether the model wrote a vector or an array."""
    stored = F.col(column)
    is_array = df.schema[column].dataType.typeName() == "array"
    return F.get(stored if is_array else vector_to_array(stored), 1)


def score(df: DataFrame, model: PipelineModel, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns and the fraud probability ``p``."""
    scored = model.transform(df)
    return scored.select(*keep, probability(scored).alias("p"))


def score_batch(
    df: DataFrame, model: PipelineModel, threshold: float = 0.5, keep: Sequence[str] = ()
) -> DataFrame:
    """Scoring response for every row: probability, decision and the threshold used."""
    return score(df, model, keep).select(
        *keep,
        F.col("p").alias("probabilidade_fraude"),
        (decision("p", threshold) == 1).alias("fraude"),
        F.lit(float(threshold)).alias("limiar"),
    )


def train_all(
    names: Iterable[str],
    balanced: DataFrame,
    test: DataFrame,
    encoding: Encoding,
    target: str = "is_fraud",
    weight: str = "sample_weight",
    params: dict[str, dict] | None = None,
) -> tuple[dict[str, PipelineModel], DataFrame | None, list[tuple[str, str]]]:
    """Fit each model on the balanced rows and score the untouched test rows. A failing model
    is recorded and does not stop the others. Boosting is many small steps in turn, which leave cores
    free, so ``FITS`` models are fitted at the same time.

    Returns the full pipelines, the scores of all models (``modelo, p, y, w, segundos``) and
    the failures. Scoring is lazy, so it is part of the job that uses the scores; ``segundos`` is
    the time of the fit alone, beside the others."""

    def fit(name: str) -> tuple[PipelineModel | Exception, float]:
        start = time.time()
        try:
            model = fit_model(name, balanced, encoding, target, **(params or {}).get(name, {}))
        except Exception as error:
            model = error
        return model, time.time() - start

    names = list(names)
    with ThreadPool(max(1, min(FITS, len(names)))) as pool:
        done = pool.map(inheritable_thread_target(balanced.sparkSession)(fit), names, chunksize=1)
    fitted, scores, failures = {}, [], []
    for name, (model, seconds) in zip(names, done):
        if isinstance(model, Exception):
            failures.append((name, str(model)))
            continue
        fitted[name] = with_encoder(encoding, model)
        scores.append(
            score(test, fitted[name], [target, weight]).select(
                F.lit(name).alias("modelo"),
                "p",
                F.col(target).alias("y"),
                F.col(weight).alias("w"),
                F.lit(seconds).alias("segundos"),
            )
        )
    return fitted, reduce(DataFrame.unionByName, scores) if scores else None, failures


def score_agreement(
    df: DataFrame, first: PipelineModel, second: PipelineModel, tolerance: float = 1e-8
) -> DataFrame:
    """Largest score difference of two pipelines on the same rows, both run on one scan."""
    one = first.transform(df)
    one = one.select(*df.columns, probability(one).alias("_p_first"))
    both = second.transform(one)
    gap = F.abs(F.col("_p_first") - probability(both))
    return both.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.max(gap), F.lit(0.0)).alias("maior_diferenca")
    ).withColumn("iguais", F.col("maior_diferenca") <= tolerance)


def permutation_importance(
    df: DataFrame,
    model: PipelineModel,
    encoding: Encoding,
    key: str = "trans_num",
    target: str = "is_fraud",
    weight: str = "sample_weight",
    sample: int | None = None,
    repeats: int = 3,
) -> DataFrame:
    """Mean drop in weighted average precision when one feature is shuffled.

    ``model`` takes encoded columns. All copies of the sample (one per feature and repeat, and
    the untouched one) are tagged, scored by one transform and measured by one set of running
    totals. A shuffled feature takes its values from the row of equal position in another hash
    order of the same rows. All rows are used unless ``sample`` asks for that many."""
    features = encoding.columns
    raw = [*encoding.categories, *encoding.moments]
    rows = df.select(key, target, weight, *raw)
    rows = encoding.apply(rows if sample is None else fixed_n_sample(rows, sample, key))
    rows = materialise(rows.select(key, target, weight, *features))
    place = F.sha2(F.col(key).cast("string"), 256)
    rows = materialise(hash_ranks(rows, place, [F.xxhash64(key, *features)], name="_i"))
    tags = [
        F.struct(F.lit(r).alias("repeticao"), F.lit(c).alias("variavel"))
        for r in range(repeats)
        for c in features
    ]
    copies = rows.select("*", F.inline(F.array(*tags)))
    digest = F.sha2(F.concat_ws("|", F.col(key), "repeticao", "variavel", F.col("_i")), 256)
    own = F.coalesce(*[F.when(F.col("variavel") == c, F.col(c)) for c in features])
    drawn = copies.select("repeticao", "variavel", own.alias("_v"), digest.alias("_d"), F.col("_i").alias("_own"))
    donors = hash_ranks(drawn, F.col("_d"), [F.col("_own")], ["repeticao", "variavel"], "_i")
    donors = donors.drop("_d", "_own")
    shuffled = copies.join(donors, ["repeticao", "variavel", "_i"]).select(
        "repeticao",
        "variavel",
        target,
        weight,
        *[F.when(F.col("variavel") == c, F.col("_v")).otherwise(F.col(c)).alias(c) for c in features],
    )
    whole = rows.select(
        F.lit(0).alias("repeticao"), F.lit("").alias("variavel"), target, weight, *features
    )
    scored = score(
        shuffled.unionByName(whole), model, ["repeticao", "variavel", target, weight]
    )
    by = ["repeticao", "variavel"]
    points = metrics.score_points(scored, by, "p", target, weight)
    quality = metrics.average_precision(points, by)
    base = F.max(F.when(F.col("variavel") == "", F.col("pr_auc_w"))).over(Window.partitionBy())
    names = dict(zip(features, raw))
    plain = F.create_map(*[F.lit(x) for item in names.items() for x in item])
    return (
        quality.withColumn("queda", base - F.col("pr_auc_w"))
        .filter("variavel <> ''")
        .groupBy(F.element_at(plain, F.col("variavel")).alias("variavel"))
        .agg(F.avg("queda").alias("importancia"))
    )
