"""Users per label and base station."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tagloom.operators.aggregates import label_counts_by_join, report_json
from tagloom.sources.tables import period_scan

# The columns of the report.
STATION_KEYS = ["lac_ci", "dn_flag"]


def station_join(
    stations: DataFrame, user_labels: DataFrame, period: str, user_column: str = "user_id", partition_field: str = "month_id"
) -> DataFrame:
    """Station rows of the period with the labels of their user; users on one side only drop out."""
    here = period_scan(stations, partition_field, period)
    tags = period_scan(user_labels, partition_field, period).select("id", "labels")
    return here.join(tags, here[user_column] == tags["id"], "inner").drop("id", partition_field)


def station_label_counts(
    stations: DataFrame,
    user_labels: DataFrame,
    period: str,
    label_ids: Sequence[str],
    user_column: str = "user_id",
    partition_field: str = "month_id",
) -> DataFrame:
    """Per station and day/night flag, the number of users with each label."""
    return label_counts_by_join(
        period_scan(stations, partition_field, period),
        period_scan(user_labels, partition_field, period),
        label_ids,
        STATION_KEYS,
        user_column,
    )


def station_report(stations: DataFrame, user_labels: DataFrame, period: str, label_ids: Sequence[str]) -> DataFrame:
    """``(lac_ci, dn_flag, result, month_id)``, ready to save."""
    return report_json(station_label_counts(stations, user_labels, period, label_ids), STATION_KEYS, period)
