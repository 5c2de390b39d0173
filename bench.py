"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line.  Each query is forced to completion with the ``noop``
sink (full computation, nothing collected to the driver).  ``load_star`` is
the one-time load (raw extract -> staging -> star schema written to the
shared folder); every later query reads the loaded star.  A warm-up run on
a smaller fixture precedes timing (JVM start, JIT and code generation).
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "churn_by_contract", "churn_by_tenure_band", "revenue_at_risk",
    "churn_by_internet_service", "churn_by_addon_count", "training_view",
    "label_share_by_contract", "null_counts_top", "describe_numeric",
    "describe_categorical", "box_stats_monthly_charges", "impute_median_fit",
    "pr_curve", "roc_auc", "best_threshold_080", "classification_report",
    "stratified_split", "validate_requests", "monitoring_summary", "surrogate_keys",
    "engineered_features", "dim_customer_merge",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from churnframe.session import get_spark
    spark = get_spark(f"local[{cpus}]", app="churnframe-bench",
                      shuffle_partitions=int(cpus) * 2,
                      extra_conf={"spark.driver.memory": "16g"})
    from churnframe.plans.catalog import QUERIES
    from churnframe.plans.datasets import datasets

    def run(name: str, folder: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    warm = os.path.join(os.path.dirname(sf_dir), "sf0.01")
    if os.path.isdir(warm) and warm != sf_dir:
        datasets(spark, warm).star.fact.write.format("noop").mode("overwrite").save()
        for q in ("churn_by_contract", "pr_curve", "describe_numeric", "engineered_features"):
            run(q, warm)

    times = {}
    t0 = time.perf_counter()
    star = datasets(spark, sf_dir).star
    star.fact.write.format("noop").mode("overwrite").save()
    times["load_star"] = time.perf_counter() - t0
    for q in HEADLINE:
        times[q] = run(q, sf_dir)
    if os.environ.get("BENCH_ML", "1") == "1":
        t0 = time.perf_counter()
        datasets(spark, sf_dir).model("rf")
        times["fit_random_forest_300"] = time.perf_counter() - t0
        times["score_batch"] = run("score_batch", sf_dir)
    total = sum(times.values())
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": round(total, 3), "unit": "sec",
                      "queries": {k: round(v, 3) for k, v in times.items()},
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
