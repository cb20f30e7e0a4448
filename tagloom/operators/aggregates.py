"""Aggregates over labelled users."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.text import LABEL_PREFIX, literal_pattern
from tagloom.operators.tags import multi_hot_columns, tokens


def collect_distinct(df: DataFrame, key: str, value: str, separator: str = ",") -> DataFrame:
    """Per key the distinct non-null values, sorted and joined to one text.

    The pairs are made distinct first, partly before the shuffle and spread by key *and* value. A key
    with very many rows therefore reaches its own group with each of its values only once.
    """
    pairs = df.select(key, value).where(F.col(value).isNotNull()).distinct()
    return pairs.groupBy(key).agg(F.array_join(F.sort_array(F.collect_list(value)), separator).alias(value))


def explode_members(df: DataFrame, list_column: str, value: str, separator: str = ",") -> DataFrame:
    """One ``(list_column, value)`` row per item of a delimited list; empty items are kept."""
    items = F.split(F.col(list_column), literal_pattern(separator))
    return df.select(F.explode(items).alias(list_column), F.col(value).cast("string").alias(value))


def invert_membership(df: DataFrame, list_column: str, value: str, separator: str = ",") -> DataFrame:
    """From "value, list of members" to "member, list of values"."""
    return collect_distinct(explode_members(df, list_column, value, separator), list_column, value, separator)


def label_counts(joined: DataFrame, label_ids: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Per group the number of rows that carry each label, as doubles."""
    names = [LABEL_PREFIX + i for i in label_ids]
    return (
        joined.select(*keys, *multi_hot_columns(F.col("labels"), label_ids))
        .groupBy(*keys)
        .agg(*[F.sum(n).cast("double").alias(n) for n in names])
    )


def label_counts_by_join(
    places: DataFrame, user_labels: DataFrame, label_ids: Sequence[str], keys: Sequence[str], user_column: str
) -> DataFrame:
    """`label_counts` of the inner join of places and user labels, with both sides reduced first.

    Sums distribute over the join, so user labels shrink to one row of flag sums per user and places to
    one counted row per user and group. Neither a user that fills much of one side nor one that is
    frequent on both sides can blow up the join.
    """
    names = [LABEL_PREFIX + i for i in label_ids]
    flags = (
        user_labels.where(F.col("id").isNotNull())
        .select("id", *multi_hot_columns(F.col("labels"), label_ids))
        .groupBy("id")
        .agg(*[F.sum(n).alias(n) for n in names])
    )
    visits = places.groupBy(user_column, *keys).agg(F.count(F.lit(1)).alias("_n"))
    return (
        visits.join(flags, visits[user_column] == flags["id"], "inner")
        .groupBy(*keys)
        .agg(*[F.sum(F.col(n) * F.col("_n")).cast("double").alias(n) for n in names])
    )


def report_json(counts: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """The keys as text, the whole row as JSON in ``result``, and the period."""
    return counts.select(
        *[F.col(k).cast("string").alias(k) for k in keys],
        F.to_json(F.struct(*counts.columns)).alias("result"),
        F.lit(period).alias("month_id"),
    )


def explode_labels(df: DataFrame, id_column: str = "id", labels_column: str = "labels") -> DataFrame:
    """One row per label."""
    return df.select(id_column, F.explode(tokens(F.col(labels_column))).alias("label"))
