"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) select the tables
and the number of local cores. Each query runs to completion BENCH_RUNS times after one
warm-up; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from ordermetrics.plans import query_catalog
from ordermetrics.session import RECOMMENDED_CONF

HEADLINES = [
    "json_parse", "tumbling_window", "window_sku_list", "sku_rank", "live_metrics",
    "latest_windows", "daily_summary_all", "hourly_anomalies", "daily_report",
    "part_daily_top", "merge_live_metrics", "stream_live_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    catalog = query_catalog()
    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            catalog[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
