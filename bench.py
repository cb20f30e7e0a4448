"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of local threads. Each query runs
once to warm up and then three times; its time is the median. With arguments, only those queries run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tagloom.settings import apply_settings  # noqa: E402
from tagloom.sinks.scratch import drop_scratch  # noqa: E402
from workload.queries import PREPARED, QUERIES  # noqa: E402

HEADLINE = [
    "base_labels",
    "base_labels_repeated",
    "station_label_json",
    "user_markets",
    "resident_attributes",
    "label_tags",
    "match_range",
    "invert_membership",
    "labels_append",
    "labels_add",
    "doc_upsert",
    "run_log_latest",
    "kv_string",
    "kv_list",
    "kv_zset",
    "str_map",
    "save_period",
]
RUNS = 3


def seconds(spark: SparkSession, name: str, folder: str) -> float:
    """The time of a query; what a sink needs to find is written before."""
    run = PREPARED[name](spark, folder) if name in PREPARED else lambda: QUERIES[name](spark, folder)
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tagloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    apply_settings(spark)
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        seconds(spark, name, folder)
        times[name] = round(statistics.median(seconds(spark, name, folder) for _ in range(RUNS)), 3)
    drop_scratch(spark)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": f"median of {RUNS} after one warm-up",
            }
        )
    )


if __name__ == "__main__":
    main()
