"""Benchmark: run the headline queries and print ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma list, default the headline set below), BENCH_PASSES (default 2).
Each query is executed in full through the ``noop`` sink (no collect).  The whole
set runs BENCH_PASSES times in one session: ``value``/``queries`` are the last
(warm) pass, ``cold_value``/``cold_queries`` the first pass, which also carries
JIT/codegen and Python-worker start-up.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    # preparation
    "normalize_minmax", "normalize_zscore", "cast_int", "split_hash", "bins_quantile", "clip_percentile",
    # evaluation
    "binary_metrics", "roc_pr_curve", "multiclass_metrics", "regression_metrics", "silhouette",
    # reshaping
    "categories_freq", "categories_apply", "join_inner", "group_by", "fill_missing", "add_id", "dedupe_first",
    "rfm_scores", "fir_filter", "median_filter", "iir_filter",
    # features and models
    "pca", "anomaly_iqr", "assign_cluster", "kmeans", "rf_binary", "frequent_itemsets", "knn_vote", "dbscan",
]


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("prepframe-bench")
        .config("spark.sql.shuffle.partitions", str(max(8, 2 * cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="prepframe-bench-ckpt-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from prepframe.plans import QUERIES

    QUERIES["normalize_params"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # JVM warm-up
    passes = max(1, int(os.environ.get("BENCH_PASSES", "2")))
    runs: list[dict[str, float]] = []
    errors: dict[str, str] = {}
    for _ in range(passes):
        times: dict[str, float] = {}
        for name in names:
            t0 = time.perf_counter()
            try:
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                times[name] = round(time.perf_counter() - t0, 3)
            except Exception as e:  # noqa: BLE001 - report and continue
                errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
        runs.append(times)
    warm, cold = runs[-1], runs[0]
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "passes": passes,
        "cold_value": round(sum(cold.values()), 3),
        "cold_queries": cold,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
