"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of the test tables, BENCH_CPUS the threads, BENCH_RUNS the timed runs
per query after one warm-up run (the median counts). A query's rows are computed in full and handed
to a sink that drops them; what a query writes on its way is part of its time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lazaret.catalog import QUERIES  # noqa: E402

HEADLINE = (
    "loop_resolve",
    "loop_iterate",
    "verdict_split",
    "row_reasons",
    "rule_failures",
    "valid_scan",
    "fan_out_routes",
    "json_round_trip",
    "decode_text",
    "repair_numbers",
    "manual_overlay",
    "contract_dedupe",
    "topic_publish",
    "batch_load",
    "stream_validate",
    "stream_loop",
    "topic_depth",
    "failure_alerts",
)


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lazaret-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxConcurrentOutputFileWriters", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in HEADLINE:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of the median seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
