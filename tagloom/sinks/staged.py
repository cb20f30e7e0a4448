"""Publishing a period in two steps: staged and checked beside the table, then put in place at once."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.sinks.period import ensure_table
from tagloom.operators.changes import row_digest

MANIFEST_SCHEMA = "period string, location string, rows bigint, checksum string"


@dataclass(frozen=True)
class Manifest:
    """What a staged folder holds: the number of its rows and a checksum that does not depend on their order."""

    location: str
    rows: int
    checksum: str


def content(df: DataFrame) -> tuple[int, str]:
    """Rows and checksum: the sum of a digest of each row, so repeated rows count and order does not."""
    digest = row_digest(df.columns)
    parts = [F.sum(digest[c].cast("decimal(38,0)")) for c in ("a", "b")]
    row = df.agg(F.count(F.lit(1)), *parts).first()
    return row[0], "/".join(str(int(v or 0)) for v in row[1:])


def _manifests(table: str) -> str:
    return f"{table}__manifest"


def published(spark: SparkSession, table: str, period: str) -> Manifest | None:
    """The manifest of the last publication of a period, if there is one."""
    if not spark.catalog.tableExists(_manifests(table)):
        return None
    rows = spark.read.table(_manifests(table)).where(F.col("period") == period)
    last = rows.orderBy(F.desc("published")).first()
    return last and Manifest(last["location"], last["rows"], last["checksum"])


def _location(spark: SparkSession, table: str) -> str:
    return next(r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r[0] == "Location")


def stage(df: DataFrame, table: str, period: str, *, partition_field: str = "month_id", file_format: str = "orc") -> Manifest:
    """The first step: write the period's rows to a folder of their own beside the table, and read them back for the manifest.

    Nothing that a reader of the table sees changes. A staged folder that is never put in place is only space.
    """
    spark = df.sparkSession
    ensure_table(df, table, partition_field, file_format)
    columns = [c for c in spark.read.table(table).columns if c != partition_field]
    folder = f"{_location(spark, table).rstrip('/')}__staged/{period}-{uuid.uuid4().hex}"
    df.select(*columns).write.format(file_format).save(folder)
    rows = spark.read.format(file_format).schema(spark.read.table(table).select(*columns).schema).load(folder)
    return Manifest(folder, *content(rows))


def put_in_place(spark: SparkSession, table: str, period: str, staged: Manifest, *, partition_field: str = "month_id") -> DataFrame:
    """The second step: the period's partition gets the staged folder as its location, in one change of the catalog.

    If the manifest of the published period has the same rows and checksum, the table is left as it is. The manifest
    is written last: if that fails, the next run publishes the same rows again.
    """
    before = published(spark, table, period)
    if before and (before.rows, before.checksum) == (staged.rows, staged.checksum):
        return spark.read.table(table)
    partition = f"PARTITION (`{partition_field}` = '{period}')"
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {partition} LOCATION '{staged.location}'")
    spark.sql(f"ALTER TABLE {table} {partition} SET LOCATION '{staged.location}'")
    spark.catalog.refreshTable(table)
    entry = spark.createDataFrame([(period, staged.location, staged.rows, staged.checksum)], MANIFEST_SCHEMA)
    entry.withColumn("published", F.current_timestamp()).coalesce(1).write.mode("append").saveAsTable(_manifests(table))
    return spark.read.table(table)


def publish_period(df: DataFrame, table: str, period: str, *, partition_field: str = "month_id", file_format: str = "orc") -> DataFrame:
    """Both steps; returns the table. A failure between them leaves the old period readable."""
    staged = stage(df, table, period, partition_field=partition_field, file_format=file_format)
    return put_in_place(df.sparkSession, table, period, staged, partition_field=partition_field)
