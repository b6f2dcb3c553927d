"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores (default
8). Query names may be given as arguments instead. ``fits`` holds the seconds of each learner's fit
alone, on rows prepared beforehand; BENCH_ALL=1 adds the two other boosters."""

from __future__ import annotations

import json
import os
import sys
import time

from ledgerlens.operators import models
from ledgerlens.plans import registry, retrain
from ledgerlens.plans.registry import QUERIES
from ledgerlens.session import build_session

HEADLINE = [
    "silver_transactions", "etl_gold", "stream_silver", "null_audit", "distinct_ids",
    "duplicate_ids", "dedup_latest", "numeric_summary", "rate_by_category", "rate_by_amount_band",
    "rate_by_state", "monthly_fraud", "dow_hour_pivot", "rate_by_band_period", "top_merchants",
    "top_fraud_customers", "correlation_matrix", "describe_by_class", "log_histogram",
    "linear_histogram", "time_cutoff", "gold_train", "gold_test", "fixed_n_sample",
    "smotenc_neighbors", "smotenc", "ordinal_encode", "standard_scale", "pr_curve", "roc_auc",
    "choose_thresholds", "classification_report", "confusion_matrix", "mean_importance",
    "model_logreg", "model_tree", "model_forest", "score_batch", "stream_score",
    "permutation_importance",
]
FITS = ["regressao_logistica", "arvore_decisao", "random_forest", "lightgbm", "adaboost"]


def fits(spark, folder: str) -> dict[str, float]:
    """Seconds of each fit on the balanced training rows, which are made and saved first."""
    encoding, balanced = retrain.prepare(registry.modelling(spark, folder)[0])
    out = {}
    for name in models.MODELS if os.environ.get("BENCH_ALL") else FITS:
        start = time.perf_counter()
        models.fit_model(name, balanced, encoding)
        out[name] = round(time.perf_counter() - start, 3)
        print("fit", name, out[name], file=sys.stderr, flush=True)
    return out


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "fits": {} if sys.argv[1:] else fits(spark, folder),
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
