"""Rolling appends to a relational target."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.dates import shift_month
from tagloom.sinks.period import drop_period, ensure_table, write_period

KEEP_MONTHS = 2
BATCH_ROWS = 10_000


def rolling_append(
    df: DataFrame,
    table: str,
    period: str,
    *,
    partition_field: str = "month_id",
    keep_months: int = KEEP_MONTHS,
    idempotent: bool = False,
    file_format: str = "parquet",
) -> DataFrame:
    """Append the rows of ``period``, then drop those of exactly ``period - keep_months``.

    A second run appends them again; ``idempotent=True`` replaces the period instead.
    """
    rows = df.where(F.col(partition_field) == F.lit(period))
    ensure_table(df, table, partition_field, file_format)
    write_period(rows, table, period, partition_field, overwrite=idempotent)
    drop_period(df.sparkSession, table, partition_field, shift_month(period, -keep_months))
    return df.sparkSession.table(table)


def jdbc_write_options(url: str, table: str, batch_rows: int = BATCH_ROWS, partitions: int = 10) -> dict[str, str]:
    """Options of a batched insert by the executors; ``partitions`` bounds the connections."""
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_rows),
        "numPartitions": str(partitions),
        "isolationLevel": "READ_COMMITTED",
    }


def append_relational(df: DataFrame, options: Mapping[str, str]) -> None:
    """Insert all rows through JDBC. Every task commits by itself, so clear the period before a re-run."""
    df.write.format("jdbc").options(**options).mode("append").save()
