"""Audiences as bitmaps of dense user numbers: distinct users and overlaps without another join on users.

A bitmap has 32,768 users of one bucket, 4 kB whatever their number; an audience is one bitmap for each bucket that has
a user of it. Bitmaps of parts combine by `bitmap_or_agg`, so distinct users of any set of places or labels come from the
bitmaps alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators.indexing import global_positions


def user_numbers(users: DataFrame, id_column: str = "id") -> DataFrame:
    """``(id, number)``: the distinct ids numbered 1, 2, 3, ... in their order, so that bitmaps are dense."""
    ids = users.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias("id"))
    return global_positions(ids.distinct(), ["id"]).select("id", (F.col("start") + 1).alias("number"))


def audience_bitmaps(members: DataFrame, numbers: DataFrame, keys: Sequence[str], id_column: str = "id") -> DataFrame:
    """``(keys, bucket, bitmap)``: who is a member of each audience, from rows of keys and a user.

    Repeated rows set the same bit and bits are set before the shuffle, so a hot audience or user costs nothing more.
    """
    numbered = members.join(numbers.withColumnRenamed("id", "_id"), members[id_column] == F.col("_id"))
    return (
        numbered.select(*keys, F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("_bit"))
        .groupBy(*keys, "bucket")
        .agg(F.bitmap_construct_agg("_bit").alias("bitmap"))
    )


def audience_sizes(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, users)``: the distinct users of audiences, also of coarser keys than the bitmaps were made for."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).alias("users"))


def audience_overlaps(bitmaps: DataFrame, keys: Sequence[str], label: str, labels: Sequence[str]) -> DataFrame:
    """``(keys, first, second, users)``: the users that have both labels, for each pair of ``labels`` that has some.

    Both sizes less the size of the union, for every bucket; a bitmap takes part in one pair for each other label.
    """
    ordered = sorted(set(labels))
    others: Column = F.filter(F.array(*[F.lit(i) for i in ordered]), lambda i: i != F.col(label))
    pairs = bitmaps.where(F.col(label).isin(ordered)).select(*keys, "bucket", "bitmap", label, F.explode(others).alias("_other"))
    pairs = pairs.select(*keys, "bucket", "bitmap", F.least(label, "_other").alias("first"), F.greatest(label, "_other").alias("second"))
    both = F.sum(F.bitmap_count("bitmap")) - F.bitmap_count(F.bitmap_or_agg("bitmap"))
    in_bucket = pairs.groupBy(*keys, "first", "second", "bucket").agg(both.alias("users"))
    return in_bucket.groupBy(*keys, "first", "second").agg(F.sum("users").alias("users")).where(F.col("users") > 0)
