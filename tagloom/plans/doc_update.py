"""Incremental update of the label documents from one source."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame

from tagloom.operators.documents import update_documents
from tagloom.plans.base_labels import label_source
from tagloom.plans.resident import work_units


def document_update(
    state: DataFrame,
    read: Callable[[str], DataFrame],
    catalog: DataFrame,
    source: str,
    period: str,
    action: str,
    *,
    id_column: str,
    label_id: str | None = None,
) -> DataFrame:
    """``add``: append the labels the source gives its users. ``delete``: remove one label everywhere.

    If the rules of the source name several partition fields, the labels of all of them are appended.
    """
    if action.upper() != "ADD":
        return update_documents(state, action, label_id=label_id)
    units, rules = work_units(catalog, source)
    deltas = [label_source(read, source, u.partition_field, period, u.pids.split("#"), rules, id_column) for u in units]
    return update_documents(state, action, reduce(DataFrame.unionByName, deltas))
