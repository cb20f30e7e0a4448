"""Times queries on the given tables and on a copy in which one user holds a third of the rows.

Usage: python -m workload.skew FOLDER SCRATCH QUERY...   (SCRATCH: a new folder for the copy)

Both sides are run once to warm up and then alternately three times; the medians are printed.
"""

from __future__ import annotations

import os
import shutil
import statistics
import sys
import time

from pyspark.sql import functions as F

from workload.check import TABLES, session
from workload.queries import QUERIES

USERS = {"orders": "o_custkey", "events": "user_id"}
RUNS = 3


def skewed_copy(spark, folder: str, target: str) -> None:
    os.makedirs(target)
    for name in TABLES:
        if name in USERS:
            user = USERS[name]
            hot = F.xxhash64(*spark.read.parquet(f"{folder}/{name}.parquet").columns) % 3 == 0
            rows = spark.read.parquet(f"{folder}/{name}.parquet")
            rows.withColumn(user, F.when(hot, F.lit(1).cast(rows.schema[user].dataType)).otherwise(F.col(user))).write.parquet(f"{target}/{name}.parquet")
        else:
            shutil.copy(f"{folder}/{name}.parquet", f"{target}/{name}.parquet")


def main(folder: str, target: str, names: list[str]) -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    skewed_copy(spark, folder, target)
    for name in names:
        times: dict[str, list[float]] = {folder: [], target: []}
        for run in range(RUNS + 1):
            for side, taken in times.items():
                start = time.perf_counter()
                QUERIES[name](spark, side).write.format("noop").mode("overwrite").save()
                if run:
                    taken.append(time.perf_counter() - start)
        even, hot = (statistics.median(t) for t in times.values())
        print(f"{name:24s} even {even:6.2f} s, skewed {hot:6.2f} s", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], sys.argv[3:])
