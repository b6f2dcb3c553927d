"""Model comparison: fit all learners, measure, rank, log, explain and save the winner."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import metrics, models
from ledgerlens.plans.retrain import prepare
from ledgerlens.session import materialise
from ledgerlens.sources import tables


@dataclass(frozen=True)
class CompareConfig:
    """``root`` holds the ranking, the run log, the reports and the saved winner."""

    root: str
    names: Sequence[str] = tuple(models.MODELS)
    ratio: float = 0.5
    neighbours: int = 5
    explained: int = 3
    importance_rows: int | None = None
    params: dict = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def compare_models(
    spark: SparkSession, train: DataFrame, test: DataFrame, cfg: CompareConfig
) -> DataFrame:
    """Ranked summary (modelo, pr_auc_w, roc_auc_w, recall_p90_w, segundos), best first.

    Writes ``metricas`` (CSV), ``execucoes`` (one run per model with parameters and metrics),
    ``limiares``, ``relatorio`` (per class at the best-F1 threshold), ``importancia`` (mean
    permutation importance of the best ``explained`` models) and ``melhor`` (the winning pipeline).
    A model that fails is logged with its message and does not stop the others."""
    encoding, balanced = prepare(train, cfg.ratio, cfg.neighbours)
    fitted, scored, failures = models.train_all(cfg.names, balanced, test, encoding, params=cfg.params)
    failed = [(f"{name}_smotenc", {"modelo": name, "falha": why}, {}) for name, why in failures]
    if failed:
        schema = "run string, params map<string,string>, metrics map<string,double>"
        tables.log_runs(spark, cfg.path("execucoes"), spark.createDataFrame(failed, schema))
    if scored is None:
        raise RuntimeError(f"no model was fitted: {failures}")
    scored = materialise(scored)
    points = materialise(metrics.score_points(scored, ["modelo"]))
    summary = metrics.metric_summary(points).join(metrics.fit_seconds(scored), "modelo")
    summary = materialise(summary)
    tables.write_metrics_csv(summary, cfg.path("metricas"))
    measured = [F.lit(x) if i % 2 == 0 else F.col(x) for c in summary.columns[1:] for i, x in enumerate((c, c))]
    tables.log_runs(
        spark,
        cfg.path("execucoes"),
        summary.select(
            F.concat("modelo", F.lit("_smotenc")).alias("run"),
            F.create_map(F.lit("modelo"), "modelo", F.lit("balanceamento"), F.lit("smotenc")).alias("params"),
            F.create_map(*measured).alias("metrics"),
        ),
    )
    limits = materialise(metrics.choose_thresholds(points, ["modelo"]))
    tables.overwrite(limits, cfg.path("limiares"))
    decided = metrics.apply_threshold(scored.join(limits.select("modelo", F.col("f1").alias("limiar")), "modelo"), "limiar")
    tables.overwrite(metrics.classification_report(decided, ["modelo"]), cfg.path("relatorio"))
    best = [r["modelo"] for r in metrics.top_models(summary, cfg.explained).collect()]
    drops = None
    for name in best:
        # The first stages of a full pipeline encode; importance shuffles encoded columns.
        bare = models.without_encoder(encoding, fitted[name])
        part = models.permutation_importance(test, bare, encoding, sample=cfg.importance_rows)
        part = part.withColumn("modelo", F.lit(name))
        drops = part if drops is None else drops.unionByName(part)
    tables.overwrite(metrics.mean_importance(drops), cfg.path("importancia"))
    fitted[best[0]].write().overwrite().save(cfg.path("melhor"))
    return summary.orderBy(F.desc("pr_auc_w"), "modelo")
