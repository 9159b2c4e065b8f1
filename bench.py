"""Headline queries, timed one after the other; prints one JSON line.

Each query runs once to warm up and then five times; the median counts, and the least and
greatest time are printed beside it. Results go
to the ``noop`` sink, so every row and column is computed. Stored intermediate
tables are part of the time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spendtide.plans import catalog  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))

HEADLINE = [
    "flatten_cost_pages",
    "compact_distinct",
    "rollup_svc_tag_day_lineitem",
    "zscore_svc_tag_day_events",
    "spike_alerts_svc",
    "spike_alerts_tag_events",
    "signal_service",
    "trend_testing",
    "trend_alerts",
    "enriched_fact",
    "daily_spend_lineitem",
    "mtd_by_service",
    "daily_by_service",
    "series_macd_events",
    "series_spike",
    "message_blocks",
    "stored_merge",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("spendtide-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spendtide-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    spark, queries, times, spread = session(), catalog.queries(), {}, {}
    for name in HEADLINE:
        taken = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            queries[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 4)
        spread[name] = [round(min(taken[1:]), 4), round(max(taken[1:]), 4)]
    print(json.dumps({
        "metric": "headline queries, sum of medians",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "spread": spread,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "shuffle_partitions": int(CPUS),
        "runs": RUNS,
    }))


if __name__ == "__main__":
    main()
