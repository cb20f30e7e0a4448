"""The monthly jobs on catalog tables: each computes, saves and writes the run log.

A ``store`` writes the rows it is given and returns the table it wrote (`sinks.buckets`); the job returns that, as the
rows themselves may read the state that the store has just replaced.

Every job is logged as started before anything is planned, and as complete or failed afterwards; a failure
goes on to the caller. Without a period it is the month before ``today``. `run_base_labels` is the first of
them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from tagloom.functions.dates import previous_period
from tagloom.operators.changes import apply_changes, change_set, one_per_id
from tagloom.operators.documents import doc_upsert
from tagloom.operators.postings import posting_changes, update_postings
from tagloom.plans import doc_update, publish
from tagloom.plans import resident as resident_plan
from tagloom.plans import station_report as station_plan
from tagloom.plans import user_markets as markets_plan
from tagloom.sinks.buckets import DocumentStore
from tagloom.sinks.period import save_period
from tagloom.sinks.keyvalue import merge_entries
from tagloom.sinks.runlog import RunLog
from tagloom.sources.tables import period_scan

def logged(log: RunLog, name: str, period: str | None, today: dt.date | None, job: Callable[[str], DataFrame]) -> DataFrame:
    """What ``job`` returns for the period, with its run logged."""
    period = period or previous_period(today or dt.date.today())
    with log.run(name, period):
        return job(period)


def run_station_report(
    spark: SparkSession,
    stations: str,
    user_labels: str,
    target: str,
    log: RunLog,
    period: str | None = None,
    *,
    label_ids: Sequence[str],
    today: dt.date | None = None,
) -> DataFrame:
    """Count labels per station, save the period of the report, return the table."""

    def job(period: str) -> DataFrame:
        report = station_plan.station_report(spark.read.table(stations), spark.read.table(user_labels), period, label_ids)
        return save_period(report, target, period)

    return logged(log, target, period, today, job)


def run_resident_attributes(
    spark: SparkSession,
    catalog: str,
    source: str,
    target: str,
    log: RunLog,
    period: str | None = None,
    *,
    id_column: str,
    place_column: str,
    read: Callable[[str], DataFrame] | None = None,
    today: dt.date | None = None,
) -> DataFrame:
    """Collect the attributes of each user, save the period, return the table."""

    def job(period: str) -> DataFrame:
        attributes = resident_plan.resident_attributes(
            read or spark.read.table, spark.read.table(catalog), source, period, id_column=id_column, place_column=place_column
        )
        return save_period(attributes, target, period)

    return logged(log, target, period, today, job)


def run_user_markets(
    state: DataFrame,
    user_labels: DataFrame,
    batches: DataFrame,
    actions: DataFrame,
    store: DocumentStore,
    log: RunLog,
    period: str | None = None,
    *,
    months: int | None = None,
    partition_field: str = "month_id",
    today: dt.date | None = None,
) -> DataFrame:
    """Store the saved labels of the period with each user's campaigns into the documents; return what was stored."""

    def job(period: str) -> DataFrame:
        since = markets_plan.window_start(period, months, today or dt.date.today())
        users = period_scan(user_labels, partition_field, period)
        reached = markets_plan.action_filter(actions, since=since)
        return store(doc_upsert(state, markets_plan.user_markets(users, batches, reached)))

    return logged(log, "user_markets", period, today, job)


def run_document_update(
    state: DataFrame,
    read: Callable[[str], DataFrame],
    catalog: DataFrame,
    source: str,
    action: str,
    store: DocumentStore,
    log: RunLog,
    period: str | None = None,
    *,
    id_column: str,
    label_id: str | None = None,
    today: dt.date | None = None,
) -> DataFrame:
    """Add the labels of a source to the documents, or delete one label; return what was stored."""

    def job(period: str) -> DataFrame:
        return store(
            doc_update.document_update(state, read, catalog, source, period, action, id_column=id_column, label_id=label_id)
        )

    return logged(log, f"update_{source}", period, today, job)


def run_publish_documents(
    state: DataFrame,
    source: DataFrame,
    store: DocumentStore,
    log: RunLog,
    period: str | None = None,
    *,
    id_column: str,
    other_columns: str | None = None,
    partition_field: str = "month_id",
    order: Column | None = None,
    today: dt.date | None = None,
) -> DataFrame:
    """Store the projected rows of the period as documents; return what was stored."""

    def job(period: str) -> DataFrame:
        return store(publish.publish_documents(state, source, id_column, other_columns, partition_field, period, order))

    return logged(log, "publish_documents", period, today, job)


def run_publish_relational(
    source: DataFrame, target: str, log: RunLog, period: str | None = None, *, today: dt.date | None = None, **options
) -> DataFrame:
    """Append the rows of the period to the relational target, return it."""
    return logged(log, target, period, today, lambda p: publish.publish_relational(source, target, p, **options))


def run_publish_key_values(
    source: DataFrame,
    kind: str,
    store: DocumentStore,
    log: RunLog,
    period: str | None = None,
    *,
    state: DataFrame | None = None,
    partition_field: str = "month_id",
    today: dt.date | None = None,
    **options,
) -> DataFrame:
    """Store the key-value entries of the period, merged into those of ``state`` if there is one; return what was stored."""

    def job(period: str) -> DataFrame:
        entries = publish.publish_key_values(source, kind, partition_field, period, **options)
        return store(entries if state is None else merge_entries(state, entries, kind))

    return logged(log, f"publish_{kind.lower()}", period, today, job)


def run_document_sync(
    state: DataFrame,
    labels: DataFrame,
    before: str,
    store: DocumentStore,
    log: RunLog,
    period: str | None = None,
    *,
    partition_field: str = "month_id",
    postings: str | None = None,
    today: dt.date | None = None,
) -> DataFrame:
    """Bring documents that hold the labels of period ``before`` up to ``period``: only what changed is written anew.

    ``labels`` is the saved label table ``(id, labels)``. With ``postings`` the index of documents by label is
    kept up too; its version is the period, so that a job that is started again adds nothing. Returns what was stored.
    """

    def job(period: str) -> DataFrame:
        old, new = (period_scan(labels, partition_field, p).select("id", "labels") for p in (before, period))
        changes = change_set(old, new)
        if postings is not None:
            update_postings(postings, posting_changes(one_per_id(old), changes), int(period))
        return store(apply_changes(state, changes))

    return logged(log, "document_sync", period, today, job)
