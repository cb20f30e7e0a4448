"""A shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

PREFIX = "tagloom_"
_stored: dict[str, list[str]] = {}  # by application


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    Without that setting it lies below the warehouse, which the driver and all executors share too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return f"{base.rstrip('/')}/tagloom-{uuid.uuid4().hex}"


def shared_database(spark: SparkSession) -> str:
    """A fresh database whose managed tables lie in a `shared_folder`."""
    name = f"{PREFIX}{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(spark)}'")
    return name


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to a `shared_folder` and read back: computed once, and no lost executor takes it along."""
    spark = df.sparkSession
    path = shared_folder(spark)
    _stored.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Drop all databases of `shared_database` and all folders that this application has `stored`.

    Call it when what was made from them is read or written elsewhere.
    """
    for row in spark.sql(f"SHOW DATABASES LIKE '{PREFIX}*'").collect():
        spark.sql(f"DROP DATABASE IF EXISTS {row[0]} CASCADE")
    hadoop = spark._jsc.hadoopConfiguration()
    for path in _stored.pop(spark.sparkContext.applicationId, []):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(hadoop).delete(folder, True)
