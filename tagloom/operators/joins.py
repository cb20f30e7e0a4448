"""Joins on user id that stay balanced when one id holds a large share of the rows.

A left join cannot be split on its right side, and repeated right rows multiply the left ones. So:

* repeated right rows are counted before the join (`count_repeats`) and the copies are put back
  after it (`repeat_rows`), which keeps a hot id on the right as small as its distinct rows;
* rows of a hot id on the left are spread over salts, and only the right rows of those few ids are
  repeated once per salt (`Salt`).

Inner joins of two plain inputs need neither: adaptive execution splits them on both sides.
"""

from __future__ import annotations

import math
from collections.abc import Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# An id with more rows than this part of an even partition is spread over salts.
PART = 0.25
# Rows of the sample that a value at the limit is expected to have.
SAMPLED = 64
MAX_COPIES_PER_ARRAY = 1_000_000

_SALT = "_salt"
_SALTS = "_salts"
_HOT = "_hot_key"
_COPIES = "_copies"


def hot_keys(df: DataFrame, key: str, share: float) -> dict[str, float]:
    """The values that fill at least ``share`` of the rows that have one, with their shares.

    Values are named by a sample in which such a value is expected `SAMPLED` times, and named from half as often on: at
    most ``2 / share`` of them, and one at the share itself is missed once in some two thousand cases, one with
    twice the share practically never. A pass over the key column then counts the named ones exactly. The sample
    has ``SAMPLED / share`` rows whatever the size of ``df``; a smaller ``df`` is counted whole.
    """
    keys = df.select(F.col(key).alias("k")).where(F.col("k").isNotNull())
    total = keys.count()
    if not total:
        return {}
    part = SAMPLED / share / total
    rows = keys if part >= 1 else keys.sample(fraction=part, seed=1)
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    named = counts.where(F.col("n") >= (share * total if part >= 1 else SAMPLED / 2))
    if part < 1:
        found = named.select("k").collect()
        if not found:
            return {}
        known = keys.sparkSession.createDataFrame([(r[0],) for r in found], keys.schema)
        exact = keys.join(F.broadcast(known), "k", "left_semi").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        named = exact.where(F.col("n") >= share * total)
    return {r["k"]: r["n"] / total for r in named.collect()}


@dataclass(frozen=True)
class Salt:
    """Spreads the hot keys of the left side of a join.

    ``salts`` is the number of salts of each hot key, decided once: both sides of every join read the same
    list, which is part of the plan, so no match depends on how or when something is computed again.
    """

    salts: Mapping[str, int]
    partitions: int

    @staticmethod
    def of(df: DataFrame, key: str, partitions: int | None = None) -> Salt:
        """Keys with over a quarter of an even partition, in pieces of about that size.

        At most ``4 * partitions`` keys are that large, and all their salts together are at most twice as many, so
        the list may be broadcast.
        """
        partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        shares = hot_keys(df, key, PART / partitions)
        return Salt({k: math.ceil(x * partitions / PART) for k, x in shares.items()}, partitions)

    def _marked(self, df: DataFrame, key: str) -> DataFrame:
        if not self.salts:
            return df.withColumn(_SALTS, F.lit(None).cast("int"))
        schema = T.StructType([T.StructField(_HOT, df.schema[key].dataType), T.StructField(_SALTS, T.IntegerType())])
        hot = df.sparkSession.createDataFrame(list(self.salts.items()), schema)
        return df.join(F.broadcast(hot), df[key] == hot[_HOT], "left").drop(_HOT)

    def left(self, df: DataFrame, key: str) -> DataFrame:
        """Rows of hot and null keys get a salt by the task that reads them, all others salt 0."""
        task = F.spark_partition_id()
        spread = F.when(F.col(key).isNull(), F.lit(self.partitions)).otherwise(F.col(_SALTS))
        # A task has rows of many hot keys: where each begins to count tells their salts apart.
        salt = F.pmod(task + F.coalesce(F.hash(key), F.lit(0)), spread)
        return self._marked(df, key).withColumn(_SALT, F.coalesce(salt, F.lit(0))).drop(_SALTS)

    def right(self, df: DataFrame, key: str) -> DataFrame:
        """Rows of hot keys once per salt, all others with salt 0."""
        salts = F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1)
        return self._marked(df, key).withColumn(_SALT, F.explode(salts)).drop(_SALTS)


def left_join(left: DataFrame, right: DataFrame, key: str, salt: Salt | None = None) -> DataFrame:
    """Left equi join on one shared key column; with ``salt`` both sides must already be salted."""
    return left.join(right, [key] if salt is None else [key, _SALT], "left")


def count_repeats(df: DataFrame, copies: str = _COPIES) -> DataFrame:
    """The distinct rows and how often each occurs, combined before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(copies))


def repeat_rows(df: DataFrame, copies: Column, columns: list[Column], position: str | None = None) -> DataFrame:
    """Each row ``copies`` times, in blocks so that no array grows with the count.

    ``position`` names a column for the number of the copy, from 0.
    """
    zero, block = F.lit(0).cast("bigint"), F.lit(MAX_COPIES_PER_ARRAY).cast("bigint")
    blocks = F.sequence(zero, F.floor((F.col(_COPIES) - 1) / block).cast("bigint"))
    in_block = F.least(block, F.col(_COPIES) - F.col("_block") * block)
    repeated = (
        df.select(*columns, copies.alias(_COPIES))
        .withColumn("_block", F.explode(blocks))
        .withColumn("_copy", F.explode(F.sequence(zero, in_block - 1)))
    )
    if position is not None:
        repeated = repeated.withColumn(position, F.col("_block") * block + F.col("_copy"))
    return repeated.drop(_COPIES, "_block", "_copy")


def join_tags(
    main: DataFrame,
    others: Mapping[str, DataFrame],
    salt: Salt | None = None,
    unique: Collection[str] = (),
) -> DataFrame:
    """Left-join label strings of many sources to the main one and concatenate them.

    Every input is ``(id, labels)``. The result has one row per main row and combination of matching
    rows of the others; labels follow the order of ``others`` and are ``''`` where there are none.
    All joins share one key, so each input is shuffled to the join once and the running result never
    again. Sources named in ``unique`` are known to hold an id once and skip the counting.
    """
    joined = main.withColumnRenamed("labels", "_main")
    joined = joined if salt is None else salt.left(joined, "id")
    parts, counts = [F.col("_main")], []
    for i, (name, other) in enumerate(others.items()):
        part = f"_part{i}"
        right = other.where(F.col("id").isNotNull()).select("id", F.nullif("labels", F.lit("")).alias(part))
        if name not in unique:
            right = count_repeats(right, f"_n{i}")
            counts.append(F.coalesce(F.col(f"_n{i}"), F.lit(1)))
        right = right if salt is None else salt.right(right, "id")
        joined = left_join(joined, right, "id", salt)
        parts.append(F.col(part))
    columns = [F.col("id"), F.concat_ws(",", F.nullif(parts[0], F.lit("")), *parts[1:]).alias("labels")]
    if not counts:
        return joined.select(*columns)
    copies = counts[0]
    for count in counts[1:]:
        copies = copies * count
    return repeat_rows(joined, copies, columns)
