"""Per user, the distinct combinations of place and labels."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Row

from tagloom.operators.aggregates import invert_membership
from tagloom.operators.rules import RulesById
from tagloom.operators.tags import composite_attribute
from tagloom.sources.catalog import label_tasks_single, read_rules
from tagloom.sources.tables import period_scan


def work_units(catalog: DataFrame, source: str) -> tuple[list[Row], RulesById]:
    """The work units of a source, one for each partition field of its rules, by that field, and their rules."""
    tasks = label_tasks_single(catalog, source)
    units = sorted(tasks.collect(), key=lambda u: u.partition_field or "")
    if not units:
        raise ValueError(f"source {source!r} has 0 work units in the catalog")
    return units, read_rules(catalog, tasks)


def resident_attributes(
    read: Callable[[str], DataFrame],
    catalog: DataFrame,
    source: str,
    period: str,
    *,
    id_column: str,
    place_column: str,
) -> DataFrame:
    """``(id, labels)``: the composite attributes of each user, sorted and joined by comma.

    If the rules of the source name several partition fields, the rows of the period by each field have the
    attributes of that field's rules, and a user has those of all.
    """
    units, rules = work_units(catalog, source)
    attributes = [
        composite_attribute(
            period_scan(read(source), unit.partition_field, period), sorted(unit.pids.split("#")), rules, id_column, place_column
        )
        for unit in units
    ]
    return invert_membership(reduce(DataFrame.unionByName, attributes), "id", "labels")
