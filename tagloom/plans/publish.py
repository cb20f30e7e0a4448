"""Publishing one period of a table: to documents, to a relational target, to key-value entries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from tagloom.operators.documents import doc_projection, doc_upsert
from tagloom.sinks.keyvalue import key_value_entries
from tagloom.sinks.relational import rolling_append
from tagloom.sources.tables import period_scan


def publish_documents(
    state: DataFrame,
    source: DataFrame,
    id_column: str,
    other_columns: str | None,
    partition_field: str,
    period: str,
    order: Column | None = None,
) -> DataFrame:
    """The document state after storing the projected rows of the period under their id."""
    docs = doc_projection(source, id_column, other_columns, partition_field, period)
    return doc_upsert(state, docs.withColumnRenamed(id_column, "id"), order)


def publish_relational(source: DataFrame, target: str, period: str, **options) -> DataFrame:
    """The relational target after its rolling append."""
    return rolling_append(source, target, period, **options)


def publish_key_values(
    source: DataFrame,
    kind: str,
    partition_field: str,
    period: str,
    *,
    key: str,
    value: str,
    order: Sequence[str],
    hash_field: str | None = None,
    hash_value: str | None = None,
) -> DataFrame:
    """The entries of the period's rows under a key."""
    rows = period_scan(source, partition_field, period)
    return key_value_entries(rows, kind, key=key, value=value, order=order, hash_field=hash_field, hash_value=hash_value)
