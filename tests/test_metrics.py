"""Ranking metrics against a direct computation on rows with ties and weights."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import metrics

ROWS = [
    (0.9, 1, 1.0), (0.9, 0, 20.0), (0.6, 1, 1.0), (0.6, 1, 50.0), (0.3, 0, 20.0), (0.3, 1, 1.0),
]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(ROWS, "p double, y int, w double")


def by_hand():
    out, hits, alarms = [], 0.0, 0.0
    pos = sum(w for _, y, w in ROWS if y)
    neg = sum(w for _, y, w in ROWS if not y)
    for cut in sorted({p for p, _, _ in ROWS}, reverse=True):
        hits = sum(w for p, y, w in ROWS if y and p >= cut)
        alarms = sum(w for p, y, w in ROWS if not y and p >= cut)
        out.append((cut, hits / (hits + alarms), hits / pos, alarms / neg))
    return out


@pytest.mark.parametrize("size", [10**6, 1])
def test_curves_have_one_point_per_score(scored, size):
    points = metrics.score_points(scored, rows_per_bucket=size)
    curve = {tuple(r) for r in metrics.pr_curve(points).collect()}
    assert curve == {(t, p, r) for t, p, r, _ in by_hand()} | {(None, 1.0, 0.0)}
    roc = {tuple(r) for r in metrics.roc_curve(points).collect()}
    assert roc == {(t, f, r) for t, _, r, f in by_hand()} | {(None, 0.0, 0.0)}


def test_areas(scored):
    points = metrics.score_points(scored)
    recalls = [0.0] + [r for _, _, r, _ in by_hand()]
    step = sum((b - a) * p for a, b, (_, p, _, _) in zip(recalls, recalls[1:], by_hand()))
    assert np.isclose(metrics.average_precision(points).first()[0], step)
    x = [0.0] + [f for *_, f in by_hand()]
    assert np.isclose(metrics.roc_auc(points).first()[0], np.trapezoid(recalls, x))


def test_thresholds_and_recall(spark, scored):
    row = metrics.choose_thresholds(metrics.score_points(scored)).first()
    f1 = {t: 2 * p * r / (p + r) for t, p, r, _ in by_hand()}
    assert row["f1"] == max(f1, key=lambda t: (f1[t], -t)) and row["p90"] == 0.5
    sure = spark.createDataFrame([(0.8, 1, 1.0), (0.7, 1, 1.0), (0.2, 0, 20.0)], scored.schema)
    points = metrics.score_points(sure)
    assert metrics.choose_thresholds(points).first()["p90"] == 0.7
    assert metrics.recall_at_precision(points).first()[0] == 1.0


def test_no_score_reaches_the_precision(spark, scored):
    flat = spark.createDataFrame([(0.9, 0, 1.0), (0.1, 1, 1.0)], scored.schema)
    points = metrics.score_points(flat)
    assert metrics.recall_at_precision(points).first()[0] == 0.0
    assert metrics.choose_thresholds(points).first()["p90"] == 0.5


def test_no_positives_and_missing_scores(spark, scored):
    none = spark.createDataFrame([(0.9, 0, 1.0), (0.1, 0, 1.0), (None, 1, 1.0)], scored.schema)
    points = metrics.score_points(none)
    assert metrics.average_precision(points).first()[0] == 0.0
    assert metrics.roc_auc(points).first()[0] is None


def test_report_counts_missing_ratios_as_zero(spark, scored):
    pred = metrics.apply_threshold(scored, 2.0)
    rows = {r["classe"]: r for r in metrics.classification_report(pred).collect()}
    assert rows["fraude"]["precisao"] == 0.0 and rows["fraude"]["f1"] == 0.0
    assert rows["legítima"]["recall"] == 1.0
    assert np.isclose(rows["accuracy"]["f1"], 40 / 93)
    matrix = {(r["real"], r["previsto"]): r["peso"] for r in metrics.confusion_matrix(pred).collect()}
    assert matrix == {(0, 0): 40.0, (0, 1): 0.0, (1, 0): 53.0, (1, 1): 0.0}


def test_same_result_under_any_partitioning(scored):
    once = metrics.metric_summary(metrics.score_points(scored.repartition(1)), [])
    many = metrics.metric_summary(metrics.score_points(scored.repartition(7)), [])
    assert once.first() == many.first()


def test_mean_importance_skips_models_without_any_drop(spark):
    rows = [("a", "x", 3.0), ("a", "y", 1.0), ("b", "x", -1.0), ("b", "y", 0.0), ("c", "x", -5.0), ("c", "y", 2.0)]
    df = spark.createDataFrame(rows, "modelo string, variavel string, importancia double")
    got = {r[0]: r[1] for r in metrics.mean_importance(df).collect()}
    assert got == {"x": 0.375, "y": 0.625}


def test_promotion_needs_more_than_the_margin(spark):
    def one(v):
        return spark.createDataFrame([(v,)], "pr_auc_w double")

    def verdict(new, old):
        return metrics.promotion(one(new), None if old is None else one(old)).first()["promovido"]

    assert verdict(0.5 + 0.002, 0.5) is False
    assert verdict(0.5 + 0.0021, 0.5) is True
    assert verdict(0.1, None) is True
    empty = one(0.1).filter(F.lit(False))
    assert metrics.promotion(one(0.1), empty).first()["promovido"] is True


def test_best_and_top_models(spark):
    df = spark.createDataFrame([("b", 0.5, 0.2), ("a", 0.5, 0.2), ("c", 0.1, 0.9), ("d", 0.3, 0.0)], "modelo string, f1 double, pr_auc_w double")
    assert metrics.best_model(df).first()["modelo"] == "a"
    assert [r["modelo"] for r in metrics.top_models(df).collect()] == ["c", "a", "b"]
