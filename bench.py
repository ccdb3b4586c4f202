"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the threads, BENCH_QUERIES (comma
separated, or 'all') the queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark.plans.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "src_customer360",
    "row_violations",
    "describe_numeric",
    "outliers_iqr",
    "corr_matrix",
    "histogram_by_class",
    "rate_by_category",
    "iv_rank",
    "feature_table",
    "f_risk",
    "stratified_split",
    "scale_robust",
    "class_metrics",
    "roc_curve",
    "best_threshold",
    "business_threshold",
    "financial_impact",
    "loss_sweep",
    "drift_report",
    "drift_report_documents",
    "drift_by_window",
    "top_contributors",
    "rank_agreement",
    "knn_minority",
    "knn_bucketed",
    "tomek_links",
    "smote",
    "train_logistic",
    "tree_attribution",
    "stream_drift",
    "drift_report_stored",
    "cross_validate",
    "oof_scores",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else [q for q in asked.split(",") if q] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
