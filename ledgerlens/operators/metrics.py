"""Weighted ranking metrics, thresholds and reports for a 0/1 target.

A scored frame has a score, a target and a weight column, and may hold several models told
apart by the ``by`` columns. Scores are first grouped to one row per distinct value, so only
those rows take part in the running totals. Rows without score or target are left out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import decision
from ledgerlens.operators.running import ROWS_PER_BUCKET, running_totals


def _ratio(a: Column, b: Column, empty: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(empty))


def score_points(
    scored: DataFrame,
    by: Sequence[str] = (),
    score: str = "p",
    target: str = "y",
    weight: str = "w",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """One row per distinct score, highest first, with the weighted hits and false alarms of
    predicting positive from that score on, and the precision and recall that follow."""
    by = list(by)
    usable = scored.filter(F.col(score).isNotNull() & F.col(target).isNotNull())
    w = F.col(weight).cast("double")
    points = usable.groupBy(*by, F.col(score).cast("double").alias("limiar")).agg(
        F.sum(F.when(F.col(target) == 1, w).otherwise(0.0)).alias("tp"),
        F.sum(F.when(F.col(target) == 1, 0.0).otherwise(w)).alias("fp"),
    )
    totals = running_totals(
        points, "limiar", ["tp", "fp"], by, descending=True, rows_per_bucket=rows_per_bucket
    )
    hits, alarms = F.col("cum_tp"), F.col("cum_fp")
    return totals.withColumns(
        {
            "precisao": _ratio(hits, hits + alarms),
            "recall": _ratio(hits, F.col("all_tp"), empty=1.0),
            "fpr": _ratio(alarms, F.col("all_fp")),
        }
    )


def _one_per_group(points: DataFrame, by: list[str]) -> DataFrame:
    return points.select(*by).distinct() if by else points.sparkSession.range(1)


def pr_curve(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One point per distinct score, and the end point (precision 1, recall 0)."""
    by = list(by)
    end = _one_per_group(points, by).select(
        *by,
        F.lit(None).cast("double").alias("limiar"),
        F.lit(1.0).alias("precisao"),
        F.lit(0.0).alias("recall"),
    )
    return points.select(*by, "limiar", "precisao", "recall").unionByName(end)


def roc_curve(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One point per distinct score, and the start point (0, 0) without a threshold."""
    by = list(by)
    start = _one_per_group(points, by).select(
        *by,
        F.lit(None).cast("double").alias("limiar"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    curve = points.select(*by, "limiar", "fpr", F.col("recall").alias("tpr"))
    return curve.unionByName(start)


def _average_precision() -> Column:
    """Step form: each rise in recall counts with the precision reached there."""
    return F.sum(_ratio(F.col("tp"), F.col("all_tp")) * F.col("precisao"))


def _roc_auc() -> Column:
    area = F.col("fp") * ((F.col("cum_tp") - F.col("tp")) + F.col("tp") / 2)
    return F.try_divide(F.sum(area), F.max("all_tp") * F.max("all_fp"))


def _recall_at(precision: float) -> Column:
    reached = F.max(F.when(F.col("precisao") >= precision, F.col("recall")))
    return F.coalesce(reached, F.lit(0.0))


def average_precision(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return points.groupBy(*by).agg(_average_precision().alias("pr_auc_w"))


def roc_auc(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return points.groupBy(*by).agg(_roc_auc().alias("roc_auc_w"))


def recall_at_precision(
    points: DataFrame, by: Sequence[str] = (), precision: float = 0.9
) -> DataFrame:
    return points.groupBy(*by).agg(_recall_at(precision).alias("recall_p90_w"))


def fit_seconds(scored: DataFrame) -> DataFrame:
    """Fit time of each model, from the column its scores carry."""
    return scored.groupBy("modelo").agg(F.max("segundos").alias("segundos"))


def metric_summary(points: DataFrame, by: Sequence[str] = ("modelo",)) -> DataFrame:
    """The three headline metrics of every model in one aggregation."""
    return points.groupBy(*by).agg(
        _average_precision().alias("pr_auc_w"),
        _roc_auc().alias("roc_auc_w"),
        _recall_at(0.9).alias("recall_p90_w"),
    )


def choose_thresholds(
    points: DataFrame, by: Sequence[str] = (), precision: float = 0.9
) -> DataFrame:
    """``p90``: lowest score that keeps the precision, else 0.5. ``f1``: score with the best F1,
    the lowest one on ties."""
    both = F.greatest(F.col("precisao") + F.col("recall"), F.lit(1e-12))
    f1 = 2 * F.col("precisao") * F.col("recall") / both
    p90 = F.min(F.when(F.col("precisao") >= precision, F.col("limiar")))
    best = F.max(F.struct(f1.alias("f1"), (-F.col("limiar")).alias("menos")))
    return points.groupBy(*by).agg(
        F.coalesce(p90, F.lit(0.5)).alias("p90"), (-best["menos"]).alias("f1")
    )


def no_skill_rate(scored: DataFrame, target: str = "y", weight: str = "w") -> DataFrame:
    """Precision of guessing: the weighted share of positives."""
    w = F.col(weight)
    return scored.agg(F.try_divide(F.sum(F.col(target) * w), F.sum(w)).alias("taxa_real"))


def apply_threshold(scored: DataFrame, threshold: float | str, score: str = "p") -> DataFrame:
    """Add ``pred``; a text ``threshold`` names a column."""
    limit = F.col(threshold) if isinstance(threshold, str) else threshold
    return scored.withColumn("pred", decision(score, limit))


def _cells(
    predicted: DataFrame, by: Sequence[str], target: str, weight: str, pred: str
) -> DataFrame:
    """The four weighted cells of the confusion table on one row per ``by``."""
    w = F.col(weight).cast("double")

    def cell(real: int, said: int) -> Column:
        here = (F.col(target) == real) & (F.col(pred) == said)
        return F.sum(F.when(here, w).otherwise(0.0)).alias(f"c{real}{said}")

    return predicted.groupBy(*by).agg(cell(0, 0), cell(0, 1), cell(1, 0), cell(1, 1))


def _class_scores(real: int) -> dict[str, Column]:
    other = 1 - real
    hit = F.col(f"c{real}{real}")
    missed, alarms = F.col(f"c{real}{other}"), F.col(f"c{other}{real}")
    precision, recall = _ratio(hit, hit + alarms), _ratio(hit, hit + missed)
    return {
        "precisao": precision,
        "recall": recall,
        "f1": _ratio(2 * precision * recall, precision + recall),
        "suporte": hit + missed,
    }


def classification_report(
    predicted: DataFrame,
    by: Sequence[str] = (),
    target: str = "y",
    weight: str = "w",
    pred: str = "pred",
) -> DataFrame:
    """Rows ``legítima``, ``fraude``, ``accuracy``, ``macro avg`` and ``weighted avg``; a ratio
    without a denominator counts as 0."""
    legit, fraud = _class_scores(0), _class_scores(1)
    total = legit["suporte"] + fraud["suporte"]
    names = ["precisao", "recall", "f1"]
    accuracy = _ratio(F.col("c00") + F.col("c11"), total)
    rows = {
        "legítima": [legit[n] for n in names] + [legit["suporte"]],
        "fraude": [fraud[n] for n in names] + [fraud["suporte"]],
        "accuracy": [accuracy] * 3 + [total],
        "macro avg": [(legit[n] + fraud[n]) / 2 for n in names] + [total],
        "weighted avg": [
            _ratio(legit[n] * legit["suporte"] + fraud[n] * fraud["suporte"], total) for n in names
        ]
        + [total],
    }
    entries = [
        F.struct(
            F.lit(label).alias("classe"),
            *[v.alias(n) for n, v in zip([*names, "suporte"], values)],
        )
        for label, values in rows.items()
    ]
    cells = _cells(predicted, by, target, weight, pred)
    return cells.select(*by, F.inline(F.array(*entries)))


def fraud_class_summary(
    predicted: DataFrame,
    by: Sequence[str] = ("modelo",),
    target: str = "y",
    weight: str = "w",
    pred: str = "pred",
) -> DataFrame:
    """Fraud-class scores and false-alarm rate of each model, best F1 first."""
    legit, fraud = _class_scores(0), _class_scores(1)
    return (
        _cells(predicted, by, target, weight, pred)
        .select(
            *by,
            fraud["precisao"].alias("precisao"),
            fraud["recall"].alias("recall"),
            fraud["f1"].alias("f1"),
            (1 - legit["recall"]).alias("alarme_falso"),
        )
        .orderBy(F.desc("f1"), *by)
    )


def confusion_matrix(
    predicted: DataFrame,
    by: Sequence[str] = (),
    target: str = "y",
    weight: str = "w",
    pred: str = "pred",
) -> DataFrame:
    """Weighted count and percentage of the real class for all four cells."""
    entries = []
    for real in (0, 1):
        row = F.col(f"c{real}0") + F.col(f"c{real}1")
        for said in (0, 1):
            cell = F.col(f"c{real}{said}")
            entries.append(
                F.struct(
                    F.lit(real).alias("real"),
                    F.lit(said).alias("previsto"),
                    cell.alias("peso"),
                    F.try_divide(cell * 100, row).alias("pct"),
                )
            )
    cells = _cells(predicted, by, target, weight, pred)
    return cells.select(*by, F.inline(F.array(*entries)))


def top_models(metrics: DataFrame, k: int = 3) -> DataFrame:
    return metrics.orderBy(F.desc("pr_auc_w"), "modelo").limit(k)


def best_model(summary: DataFrame) -> DataFrame:
    """Model with the best F1; the first name on ties."""
    best = F.min(F.struct((-F.col("f1")).alias("menos"), F.col("modelo").alias("modelo")))
    return summary.agg(best.alias("b")).select(
        F.col("b.modelo").alias("modelo"), (-F.col("b.menos")).alias("f1")
    )


def mean_importance(
    importances: DataFrame, model: str = "modelo", feature: str = "variavel",
    value: str = "importancia",
) -> DataFrame:
    """Negative drops count as 0; each model is scaled to sum 1 (models without any drop are
    skipped), then features are averaged over the models."""
    clipped = importances.select(
        F.col(model).alias("modelo"),
        F.col(feature).alias("variavel"),
        F.greatest(F.col(value), F.lit(0.0)).alias("v"),
    )
    totals = clipped.groupBy("modelo").agg(F.sum("v").alias("total"))
    scaled = clipped.join(totals, "modelo").withColumn("v", F.try_divide("v", "total"))
    return scaled.groupBy("variavel").agg(F.avg("v").alias("media")).orderBy(
        F.desc_nulls_last("media"), "variavel"
    )


def promotion(
    challenger: DataFrame, champion: DataFrame | None, margin: float = 0.002
) -> DataFrame:
    """Compare two one-row ``pr_auc_w`` frames. Promote when there is no champion, or when the
    challenger lies above the champion by more than the margin."""
    new = challenger.select(F.lit("desafiante").alias("papel"), "pr_auc_w")
    both = new
    if champion is not None:
        both = new.unionByName(champion.select(F.lit("atual").alias("papel"), "pr_auc_w"))

    def of(role: str) -> Column:
        return F.max(F.when(F.col("papel") == role, F.col("pr_auc_w")))

    return both.agg(of("desafiante").alias("pr_auc_desafiante"), of("atual").alias("pr_auc_atual")).select(
        "*",
        (
            F.col("pr_auc_atual").isNull()
            | (F.col("pr_auc_desafiante") > F.col("pr_auc_atual") + F.lit(float(margin)))
        ).alias("promovido"),
    )
