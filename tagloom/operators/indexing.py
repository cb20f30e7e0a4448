"""Positions in one global order, without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MIN_BUCKETS = 16
# Sampled rows per cut: with so many, the largest of some hundred buckets is about 1.6 times the mean.
ROWS_PER_CUT = 32


def default_buckets(spark: SparkSession) -> int:
    """As many buckets as a shuffle has partitions; that number follows the data."""
    return max(MIN_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _with_bucket(df: DataFrame, cuts: Column, columns: Sequence[str], count: int) -> DataFrame:
    """Add ``_bucket``: how many of the at most ``count`` sorted cuts are not after the row.

    A binary search, one projection per step, so that a step reads the result of the one before.
    """
    df = df.withColumn("_row", F.struct(*columns)).withColumn("_bucket", F.lit(0))
    for step in (2**i for i in reversed(range(count.bit_length()))):
        not_after = F.get(cuts, F.col("_bucket") + (step - 1)) <= F.col("_row")
        df = df.withColumn("_bucket", F.col("_bucket") + F.when(not_after, step).otherwise(0))
    return df.drop("_row")


def sample_cuts(rows: DataFrame, columns: Sequence[str], buckets: int) -> Column:
    """The sorted cuts between ``buckets`` even parts of the distinct ``rows``, at most as many, as one array.

    The rows with the smallest hashes are the sample, `ROWS_PER_CUT` for each cut. Only rows whose hash is below the
    share of them that is needed, and a fifth more, take part in that order: a task sends its part of the sample,
    however many tasks there are.
    """
    wanted = buckets * ROWS_PER_CUT
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    # Of so many rows about 1.2 times the wanted ones lie below; all rows, if there are not many more than wanted.
    spread = F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") / F.lit(float(2**53))
    few = rows.withColumn("_hash", spread).where(F.col("_hash") * total <= 1.2 * wanted + 4 * wanted**0.5)
    sample = few.select(F.struct(*columns).alias("_row"), "_hash").orderBy("_hash", "_row").limit(wanted)
    return (
        sample.agg(F.sort_array(F.collect_list("_row")).alias("sample"))
        .select(F.filter("sample", lambda _, i: i % ROWS_PER_CUT == ROWS_PER_CUT - 1).alias("cuts"))
        .scalar()
    )


def global_positions(df: DataFrame, order: Sequence[str], buckets: int | None = None) -> DataFrame:
    """The distinct rows of ``df`` with ``copies``, ``start`` and ``total``.

    Sorted by ``order`` and then by the other columns, a row's copies take the positions ``start`` to
    ``start + copies - 1`` out of ``0`` to ``total - 1``.

    Equal rows are counted before the shuffle, so a row that is repeated very often is one row from
    then on. The distinct rows are cut into buckets at every 32nd row of a sample: the rows with the
    smallest hashes, the same however often a task is retried. The sample, some 40 rows per bucket, and the
    bucket sizes meet in one place, and nothing else.
    """
    buckets = buckets or default_buckets(df.sparkSession)
    columns = [*order, *[c for c in df.columns if c not in order]]
    rows = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    # Every branch below uses the counts, so all of them read one and the same shuffle of the rows.
    cuts = sample_cuts(rows.where(F.col("copies") > 0), columns, buckets)
    rows = _with_bucket(rows, cuts, columns, buckets)
    sizes = rows.groupBy("_bucket").agg(F.sum("copies").alias("_size"))  # at most buckets + 1 rows
    ends = W.orderBy("_bucket")
    offsets = sizes.select(
        "_bucket",
        (F.sum("_size").over(ends) - F.col("_size")).alias("_offset"),
        F.sum("_size").over(ends.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("total"),
    )
    in_bucket = W.partitionBy("_bucket").orderBy(*columns).rowsBetween(W.unboundedPreceding, W.currentRow)
    before = F.sum("copies").over(in_bucket) - F.col("copies")
    return (
        rows.withColumn("_before", before)
        .join(F.broadcast(offsets), "_bucket", "left")
        .select(*columns, "copies", (F.col("_offset") + F.col("_before")).alias("start"), "total")
    )


def last_position(start: Column, copies: Column) -> Column:
    return start + copies - 1
