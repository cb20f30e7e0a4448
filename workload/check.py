"""Compare a query with its SQL: columns, types and rows, in any order.

Usage: python -m workload.check FOLDER [QUERY...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Types that carry the same values in both engines.
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    ours = df.columns
    result = con.execute(sql)
    theirs = [d[0] for d in result.description]
    rows = result.fetchall()
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} and {sorted(theirs)}"
    types = {r[0]: str(r[1]) for r in con.execute(f"describe {sql}").fetchall()}
    for f in df.schema.fields:
        expected = TYPES[f.dataType.simpleString()]
        if types[f.name] != expected:
            return f"type of {f.name}: {expected} and {types[f.name]}"
    at = [theirs.index(c) for c in ours]
    left = Counter(tuple(r) for r in df.collect())
    right = Counter(tuple(r[i] for i in at) for r in rows)
    if left != right:
        only_left, only_right = left - right, right - left
        return f"rows: {only_left.total()} only here {list(only_left)[:3]}, {only_right.total()} only there {list(only_right)[:3]}"
    return None


def session(master: str = "local[8]") -> SparkSession:
    return (
        SparkSession.builder.master(master)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def main(folder: str, names: list[str]) -> int:
    from tagloom.sinks.scratch import drop_scratch
    from workload.oracles import oracle_sql
    from workload.queries import QUERIES

    spark, con, sql, failed = session(), connect(folder), oracle_sql(), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name in names or list(QUERIES):
        start = time.time()
        try:
            wrong = difference(QUERIES[name](spark, folder), con, sql[name])
        except Exception as e:  # report and go on with the next query
            wrong = f"{type(e).__name__}: {str(e)[:500]}"
        failed += wrong is not None
        print(f"{name:24s} {time.time() - start:6.2f}s {'ok' if wrong is None else wrong}", flush=True)
    drop_scratch(spark)
    print(f"{failed} of {len(names or QUERIES)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
