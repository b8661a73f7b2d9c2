"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: directory of the test tables; BENCH_CPUS: local cores; BENCH_RUNS: timed runs
per query after one warm-up, of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from riskfeatures.session import tune
from riskfeatures.workload import QUERIES

HEADLINE = (
    "latest_by_value",
    "rolling_mean",
    "next_event_periods",
    "interval_join_periods",
    "running_total_daily",
    "caro_scores",
    "audit_scorecard",
    "conditional_distinct_sums",
    "disqualified_active",
    "disqualified_resigned",
    "two_hop_rating",
    "two_hop_default",
    "ef_history",
    "fs_ratios",
    "court_scorecard",
    "scorecard",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        # call sites are only kept for error messages, and cost a call per column
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def seconds(spark: SparkSession, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = session(cpus)
    times = {}
    for name in names:
        seconds(spark, sf_dir, name)
        times[name] = round(statistics.median(seconds(spark, sf_dir, name) for _ in range(runs)), 3)
        print(f"{name}: {times[name]} s", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
