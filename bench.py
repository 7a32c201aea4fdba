"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the data
and the local cores. Each query runs once to warm up and then BENCH_RUNS times (default 3);
the median counts. The time covers building the plan and computing every row.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from siftmark.catalog.queries import QUERIES

HEADLINE = [
    "pivot_fact", "growth_metrics_monthly", "entity_period_metrics", "snapshot_latest", "global_trends",
    "market_attractiveness", "market_attractiveness_distributed", "percent_rank_scores", "top_candidates",
    "recommend_by_region", "weight_scenarios", "region_scenarios", "clean_long_fact", "duplicate_grain",
    "pivot_reconcile", "layer_reconcile", "balance_gap",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("siftmark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINE:
        measured = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            measured.append(time.perf_counter() - start)
        times[name] = round(statistics.median(measured[1:]), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
