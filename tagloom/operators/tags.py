"""Label strings and their encodings."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.text import LABEL_PREFIX
from tagloom.operators.rules import Rule, RulesById, label_columns


def tokens(labels: Column) -> Column:
    return F.split(labels, ",")


def label_matrix(source: DataFrame, label_ids: Sequence[str], rules: Iterable[Rule] | RulesById, id_column: str) -> DataFrame:
    """``id`` and one nullable column per label, all in a single projection."""
    return source.select(F.col(id_column).cast("string").alias("id"), *label_columns(label_ids, rules))


def tag_source(source: DataFrame, label_ids: Sequence[str], rules: Iterable[Rule] | RulesById, id_column: str) -> DataFrame:
    """``id`` and the comma-separated labels of each row, empty where none matches."""
    return source.select(
        F.col(id_column).cast("string").alias("id"),
        F.concat_ws(",", *label_columns(label_ids, rules)).alias("labels"),
    )


def composite_attribute(
    source: DataFrame,
    label_ids: Sequence[str],
    rules: Iterable[Rule] | RulesById,
    id_column: str,
    place_column: str,
) -> DataFrame:
    """``id`` and ``place_labelN_..._label1``: the place first, then the labels from last to first."""
    columns = [F.col(place_column).cast("string"), *reversed(label_columns(label_ids, rules))]
    return source.select(
        F.col(id_column).cast("string").alias("id"),
        F.concat_ws("_", *columns).alias("labels"),
    )


def multi_hot_columns(labels: Column, label_ids: Sequence[str]) -> list[Column]:
    """One 0/1 integer per label id, by exact token."""
    has = tokens(labels)
    return [
        F.coalesce(F.array_contains(has, i), F.lit(False)).cast("int").alias(LABEL_PREFIX + i) for i in label_ids
    ]


def multi_hot_text(labels: Column, label_ids: Sequence[str]) -> Column:
    """The 0/1 flags as one comma-separated text."""
    return F.concat_ws(",", *[c.cast("string") for c in multi_hot_columns(labels, label_ids)])


def spread_text(text: Column, label_ids: Sequence[str]) -> list[Column]:
    """Split a comma-separated text into one ``label_<id>`` column per position."""
    items = tokens(text)
    return [F.get(items, F.lit(i)).alias(LABEL_PREFIX + label) for i, label in enumerate(label_ids)]


def labels_intersect(labels: Column, label_ids: Sequence[str]) -> Column:
    """The labels of the text that are in ``label_ids``, in their order in the text."""
    return F.array_join(F.array_intersect(tokens(labels), F.array(*[F.lit(i) for i in label_ids])), ",")
