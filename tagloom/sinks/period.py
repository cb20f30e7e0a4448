"""Month-partitioned catalog tables with retention."""

from __future__ import annotations

import datetime as dt
from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.dates import previous_period, shift_month

RETENTION_MONTHS = 12


def ensure_table(df: DataFrame, table: str, partition_field: str, file_format: str = "orc") -> None:
    """Create the partitioned table with the columns of ``df`` unless it exists."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != partition_field
    )
    df.sparkSession.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, `{partition_field}` STRING) "
        f"USING {file_format} PARTITIONED BY (`{partition_field}`)"
    )


def drop_period(spark: SparkSession, table: str, partition_field: str, period: str) -> None:
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{partition_field}` = '{period}')")


def periods(spark: SparkSession, table: str, partition_field: str) -> list[str]:
    """The stored periods, from the table's metadata."""
    prefix = partition_field + "="
    return sorted(row[0].removeprefix(prefix) for row in spark.sql(f"SHOW PARTITIONS {table}").collect())


def write_period(df: DataFrame, table: str, period: str, partition_field: str, overwrite: bool) -> None:
    """Write one period into a static partition: other periods are not touched and nothing is sorted."""
    spark = df.sparkSession
    columns = [F.col(c) for c in spark.table(table).columns if c != partition_field]
    verb = "INSERT OVERWRITE" if overwrite else "INSERT INTO"
    spark.sql(
        f"{verb} TABLE {table} PARTITION (`{partition_field}` = '{period}') SELECT * FROM {{rows}}",
        rows=df.select(*columns),
    )


def save_period(
    df: DataFrame,
    table: str,
    period: str,
    *,
    partition_field: str = "month_id",
    retention_months: int = RETENTION_MONTHS,
    retain: Literal["exact", "at_least"] = "exact",
    file_format: str = "orc",
) -> DataFrame:
    """Replace one period of a table, then drop the one that is ``retention_months`` older.

    A partition column in ``df`` is replaced by ``period``. ``retain="at_least"`` drops every older
    period too. Old data goes only after the new period is in place. Returns the table.
    """
    spark = df.sparkSession
    ensure_table(df, table, partition_field, file_format)
    write_period(df, table, period, partition_field, overwrite=True)
    expired = shift_month(period, -retention_months)
    drops = [expired]
    if retain == "at_least":
        drops = [p for p in periods(spark, table, partition_field) if p <= expired]
    for old in drops:
        drop_period(spark, table, partition_field, old)
    return spark.table(table)


def save_default_period(df: DataFrame, table: str, today: dt.date, **options) -> DataFrame:
    """`save_period` for the month before ``today``, dropping the month one year before ``today``."""
    return save_period(df, table, previous_period(today), retention_months=RETENTION_MONTHS - 1, **options)
