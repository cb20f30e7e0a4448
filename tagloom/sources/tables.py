"""Period snapshots and relational tables as DataFrames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.dates import period_parameters


def table_scan(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.table(table)


def period_scan(df: DataFrame, partition_field: str, period: str) -> DataFrame:
    """One period. The literal is text like the partition column, so the partition filter is exact."""
    return df.where(F.col(partition_field) == F.lit(period))


def default_period_scan(df: DataFrame, partition_field: str, today: dt.date) -> DataFrame:
    """The period that the partition field stands for on ``today``."""
    return period_scan(df, partition_field, period_parameters(today)[partition_field])


def jdbc_read_options(
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a relational read; with a partition column, executors read the ranges side by side."""
    options = {"url": url, "dbtable": f"({query}) q", "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partitioned read needs bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": bounds[0],
            "upperBound": bounds[1],
            "numPartitions": str(partitions),
        }
    return options


# The column classes of a relational result and their types here.
RELATIONAL_TYPES = {
    "java.lang.String": T.StringType(),
    "java.lang.Integer": T.IntegerType(),
    "java.lang.Long": T.LongType(),
    "java.lang.Boolean": T.BooleanType(),
    "java.lang.Double": T.DoubleType(),
    "java.lang.Float": T.FloatType(),
    "java.sql.Date": T.DateType(),
    "java.sql.Time": T.TimestampType(),
    "java.sql.Timestamp": T.TimestampType(),
    "java.math.BigDecimal": T.DecimalType(10, 0),
}


def relational_schema(columns: Mapping[str, str]) -> T.StructType:
    """The schema of a result with these column classes, all nullable; an unknown class is an error."""
    unknown = sorted(set(columns.values()) - set(RELATIONAL_TYPES))
    if unknown:
        raise ValueError(f"no type for {', '.join(unknown)}")
    return T.StructType([T.StructField(name, RELATIONAL_TYPES[kind]) for name, kind in columns.items()])


def as_relational(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``df`` with exactly these columns and their types, as a relational result has them."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in relational_schema(columns).fields])


def read_relational(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """The distinct rows of a relational query, read by the executors."""
    return distinct_rows(spark.read.format("jdbc").options(**options).load())


def distinct_rows(*frames: DataFrame) -> DataFrame:
    """All frames together without repeated rows: one union, one distinct."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result.distinct()
