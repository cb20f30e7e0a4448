"""Runtime settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot never compiles a method of more than 8000 bytes. A projection of about 40 labels or more
    # is larger when fused with its stage; below this limit Spark splits it, and it runs 20 times faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A repeated key of a text map keeps its last value.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark
