"""The rule catalog: columns ``id, value, source_name, source_label, partition_field``, all text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.operators.rules import Rule

CATALOG_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "value", "source_name", "source_label", "partition_field")]
)


def label_catalog(catalog: DataFrame, label_id: str) -> DataFrame:
    """All catalog rows of one label."""
    return catalog.where(F.col("id") == F.lit(label_id))


def _work_units(catalog: DataFrame) -> DataFrame:
    # Rows are made distinct before they are collected, so a source with many repeated rows
    # reaches its group already reduced to its distinct ids and labels.
    return (
        catalog.select("source_name", "partition_field", "id", "source_label")
        .distinct()
        .groupBy("source_name", "partition_field")
        .agg(
            F.array_join(F.sort_array(F.collect_set("id")), "#").alias("pids"),
            F.array_join(F.sort_array(F.collect_set("source_label")), "#").alias("labels"),
        )
    )


def label_tasks(catalog: DataFrame) -> DataFrame:
    """One work unit per named source: its ids and labels joined with ``#``."""
    return _work_units(catalog.where(F.length(F.trim("source_name")) > 0))


def label_tasks_single(catalog: DataFrame, source_name: str) -> DataFrame:
    """The work unit of one source, from its rows with a rule body."""
    return _work_units(
        catalog.where((F.length(F.trim("value")) > 0) & (F.col("source_name") == F.lit(source_name)))
    )


def screen_tasks(tasks: DataFrame, enabled: Sequence[str]) -> DataFrame:
    """Keep the work units of enabled sources."""
    return tasks.where(F.col("source_name").isin(list(enabled)))


def read_rules(catalog: DataFrame, units: DataFrame) -> dict[str, list[Rule]]:
    """The rules of the ids of the work units, by id, whatever source a rule row names.

    The driver gets only what it is about to compile; the rest of the catalog is left out where it is read.
    """
    wanted = units.select(F.explode(F.split("pids", "#")).alias("id")).distinct()
    rows = catalog.select(*CATALOG_SCHEMA.names).join(wanted, "id", "left_semi").select(*CATALOG_SCHEMA.names).collect()
    index: dict[str, list[Rule]] = {}
    for row in sorted(rows, key=lambda r: tuple(v or "" for v in r)):
        index.setdefault(row["id"], []).append(Rule(*row))
    return index
