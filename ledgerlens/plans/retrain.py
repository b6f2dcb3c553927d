"""Weekly retrain: encode, balance, fit, evaluate, promote, record."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens.operators import balance, metrics, models
from ledgerlens.operators.features import Encoding, fit_encoding
from ledgerlens.session import materialise
from ledgerlens.sources import tables


@dataclass(frozen=True)
class RetrainConfig:
    """``root`` holds the model folders, the history and the run log."""

    root: str
    model: str = "lightgbm"
    margin: float = 0.002
    ratio: float = 0.5
    neighbours: int = 5
    params: dict = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def prepare(
    train: DataFrame, ratio: float = 0.5, k: int = 5, key: str = "trans_num"
) -> tuple[Encoding, DataFrame]:
    """Encoding learnt from the training rows, and those rows encoded and oversampled."""
    encoding = fit_encoding(train)
    encoded = materialise(encoding.apply(train).select(key, "is_fraud", *encoding.columns))
    codes = [f"{c}_cod" for c in encoding.categories]
    numbers = [f"{c}_pad" for c in encoding.moments]
    balanced = balance.smotenc(encoded, numbers, codes, ratio, k, key)
    return encoding, materialise(balanced)


def champion(spark: SparkSession, cfg: RetrainConfig) -> PipelineModel | None:
    """The model of the latest promoted run; none without a history, or if the model does not load.
    Any other fault is raised, so that it cannot promote a challenger."""
    try:
        history = spark.read.schema(schemas.HISTORY).json(cfg.path("historico"))
        latest = history.filter("promovido").agg(F.max("data")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    try:
        return PipelineModel.load(cfg.path(f"modelos/{latest}")) if latest else None
    except Exception as error:
        print("champion does not load:", str(error).splitlines()[0])
        return None


def retrain(
    spark: SparkSession, train: DataFrame, test: DataFrame, cfg: RetrainConfig,
    key: str = "trans_num",
) -> DataFrame:
    """Fit a challenger and promote it when it beats the champion by more than the margin.

    A promoted model gets a folder of its own named after the run; earlier champions stay as
    dated backups, and the history says which one is current. Returns the new history row."""
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
    encoding, balanced = prepare(train, cfg.ratio, cfg.neighbours, key)
    fitted = models.fit_model(cfg.model, balanced, encoding, **cfg.params)
    challenger = models.with_encoder(encoding, fitted)
    current = champion(spark, cfg)

    contestants = {"desafiante": challenger} | ({"atual": current} if current else {})
    scored = None
    for role, model in contestants.items():
        part = models.score(test, model, ["is_fraud", "sample_weight"])
        part = part.select(F.lit(role).alias("papel"), "p", "is_fraud", "sample_weight")
        scored = part if scored is None else scored.unionByName(part)
    points = metrics.score_points(scored, ["papel"], "p", "is_fraud", "sample_weight")
    quality = materialise(metrics.average_precision(points, ["papel"]))
    verdict = metrics.promotion(
        quality.filter("papel = 'desafiante'"), quality.filter("papel = 'atual'"), cfg.margin
    )
    row = materialise(verdict.select(F.lit(stamp).alias("data"), *verdict.columns))
    if row.first()["promovido"]:
        challenger.write().overwrite().save(cfg.path(f"modelos/{stamp}"))

    tables.append_history(spark, cfg.path("historico"), row)
    size = train.count()
    tables.log_runs(
        spark,
        cfg.path("execucoes"),
        row.select(
            F.lit(f"retreino_{cfg.model}_{stamp}").alias("run"),
            F.create_map(
                F.lit("balanceamento"), F.lit("smotenc"),
                F.lit("treino_linhas"), F.lit(str(size)),
                F.lit("promovido"), F.col("promovido").cast("string"),
            ).alias("params"),
            F.create_map(
                F.lit("pr_auc_desafiante"), F.col("pr_auc_desafiante"),
                F.lit("pr_auc_atual"), F.coalesce(F.col("pr_auc_atual"), F.lit(-1.0)),
            ).alias("metrics"),
        ),
    )
    return row
