"""Id-keyed states in bucketed tables: an update meets its state bucket by bucket, and the state is never shuffled."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

DocumentStore = Callable[[DataFrame], DataFrame]


def _next(table: str) -> str:
    return f"{table}__next"


def _last(table: str) -> str:
    return f"{table}__last"


def _replace(spark: SparkSession, table: str) -> DataFrame:
    """Put the new table in the place of the old one; a failure in between is mended by `recover`."""
    spark.sql(f"DROP TABLE IF EXISTS {_last(table)}")
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {_last(table)}")
    spark.sql(f"ALTER TABLE {_next(table)} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {_last(table)}")
    return spark.read.table(table)


def recover(spark: SparkSession, table: str) -> None:
    """Finish a replacement that broke off after the old table was taken away."""
    if not spark.catalog.tableExists(table):
        for other in (_next(table), _last(table)):
            if spark.catalog.tableExists(other):
                spark.sql(f"ALTER TABLE {other} RENAME TO {table}")
                return


def replace_table(df: DataFrame, table: str, file_format: str = "parquet") -> DataFrame:
    """Replace a table by ``df`` and return it. The rows are written beside the old table, which ``df`` may read."""
    spark = df.sparkSession
    recover(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {_next(table)}")
    df.write.format(file_format).saveAsTable(_next(table))
    return _replace(spark, table)


def save_bucketed(df: DataFrame, table: str, buckets: int, id_column: str = "id", file_format: str = "parquet") -> DataFrame:
    """`replace_table` in ``buckets`` buckets by id, sorted by it.

    Rows that do not come dealt by the id already are shuffled once, so that a bucket is one file.
    """
    spark = df.sparkSession
    recover(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {_next(table)}")
    df.repartition(buckets, id_column).write.format(file_format).bucketBy(buckets, id_column).sortBy(id_column).saveAsTable(_next(table))
    return _replace(spark, table)


def merge_bucketed(merged: DataFrame, table: str, buckets: int, id_column: str = "id", file_format: str = "parquet") -> DataFrame:
    """Replace the bucketed ``table`` by ``merged``, the result of a join of its rows with others on the id.

    A task of such a join has the rows of one bucket and writes one file, so nothing is shuffled again. Any other
    frame gives right rows too, in more files.
    """
    spark = merged.sparkSession
    recover(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {_next(table)}")
    merged.write.format(file_format).bucketBy(buckets, id_column).sortBy(id_column).saveAsTable(_next(table))
    return _replace(spark, table)


def bucketed_store(table: str, buckets: int, id_column: str = "id") -> DocumentStore:
    """A store for the jobs that replaces a bucketed table by documents made from it, and returns it."""
    return lambda documents: merge_bucketed(documents, table, buckets, id_column)


def table_store(table: str, file_format: str = "parquet") -> DocumentStore:
    """A store for the jobs that replaces a plain table and returns it."""
    return lambda rows: replace_table(rows, table, file_format)
