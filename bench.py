"""Time the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from forgepulse.session import SETTINGS
from workload.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# Whole pipelines, each some thirty jobs that write and check tables: timed once.
ONCE = {
    "window_run", "incremental_run", "incremental_actor_activity", "incremental_summary",
    "served_kpis", "served_event_types", "served_top_contributors", "raw_refresh_redelivered",
}

# Run before anything is timed, so that the first queries do not pay for class loading.
WARM_UP = ("flatten_event", "mart_repo_summary", "top_contributors")


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("forgepulse-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, build) -> float:
    """Build the query and compute all its rows, without keeping them."""
    start = time.perf_counter()
    result: DataFrame = build(spark, SF_DIR)
    result.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    for _ in range(3):
        for name in WARM_UP:
            seconds(spark, QUERIES[name])
    timings, failed = {}, {}
    for name, build in QUERIES.items():
        runs = 1 if name in ONCE else RUNS
        try:
            if runs > 1:
                seconds(spark, build)
            timings[name] = round(statistics.median(seconds(spark, build) for _ in range(runs)), 3)
        except Exception as error:  # one broken query must not cost the others their figures
            failed[name] = f"{type(error).__name__}: {error}".splitlines()[0]
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "failed": failed,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()
    if failed:
        sys.exit(1)


if __name__ == "__main__":
    main()
