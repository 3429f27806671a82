"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the number of local cores. All
queries run once to warm up, then each three times for the clock; the median counts.
The time covers building the query, its size checks and its settled totals included.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from workload.queries import QUERIES

HEADLINE = [
    "fund_redemptions",
    "redemption_moving_avg",
    "anomaly_labels",
    "fund_flow_series",
    "flows_all",
    "base_features",
    "trailing_avg",
    "fill_gaps",
    "advisor_assets",
    "advisor_sales",
]
RUNS = 3


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names, times = sys.argv[1:] or HEADLINE, {}
    for name in names:
        seconds(spark, name, sf_dir)
    for name in names:
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
