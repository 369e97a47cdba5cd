"""Time the headline queries. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) picks the data, BENCH_CPUS the local cores. Every
query starts from the raw tables: the loan panel is derived again each time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = [
    "a1_delinquency_timeseries", "a2_vintage_outcomes", "l6_feature_panel", "l1_forward_label",
    "l4_prepay_label", "m1_woe_bins", "m4_ranking_metrics", "q9_drift", "q11_quality_suite",
    "r11_schedule_backtest", "a19_loss_summary", "v10_sensitivity_grid", "v14_monitoring_run",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("lossloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from workload.catalog import QUERIES

    names = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()  # start the executors
    times = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
