"""The run log: an append-only event table and its latest state per run.

A run is ``(job_id, job_name, job_period)``. It starts with status 0 and ends with 1 (complete) or 2
(failed). Instead of updating rows, each change is one event; the latest event wins.
"""

from __future__ import annotations

import datetime as dt
import traceback
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.dates import fmt_datetime_19
from tagloom.functions.text import single_to_double_quotes
from tagloom.sinks.buckets import replace_table

# The columns of the run log and its status codes.
RUN_KEY = ["job_id", "job_name", "job_period"]
STARTED, COMPLETE, FAILED = "0", "1", "2"
EVENT_SCHEMA = (
    "job_id string, job_name string, job_desc string, job_period string, project string, "
    "event_time timestamp_ntz, event_id bigint, status string, result string"
)


class RunLog:
    """Writes run events of this Spark application to a catalog table."""

    def __init__(self, spark: SparkSession, table: str, project: str = "", file_format: str = "orc") -> None:
        self.spark, self.table, self.project, self.file_format = spark, table, project, file_format
        self.job_id = spark.sparkContext.applicationId

    def append(self, job_name: str, job_period: str, changes: Iterable[tuple[str, str]], job_desc: str = "") -> None:
        """Append ``(status, result)`` changes of one run, in their order."""
        self.append_all([(job_name, job_period, job_desc, changes)])

    def append_all(self, runs: Iterable[tuple[str, str, str, Iterable[tuple[str, str]]]]) -> None:
        """Append the changes of several runs, ``(job_name, job_period, job_desc, changes)``, in one write."""
        now = dt.datetime.now(dt.UTC).replace(tzinfo=None)
        events = [
            (self.job_id, job_name, job_desc, job_period, self.project, now, int(status), status, result)
            for job_name, job_period, job_desc, changes in runs
            for status, result in changes
        ]
        if events:
            rows = self.spark.createDataFrame(events, EVENT_SCHEMA).coalesce(1)
            rows.write.format(self.file_format).mode("append").saveAsTable(self.table)

    @contextmanager
    def run(self, job_name: str, job_period: str, job_desc: str = "") -> Iterator[None]:
        """Log the start of a run and its end, complete or failed with the error; the error goes on."""
        self.append(job_name, job_period, [(STARTED, "start")], job_desc)
        try:
            yield
        except Exception:
            self.append(job_name, job_period, [(FAILED, traceback.format_exc())], job_desc)
            raise
        self.append(job_name, job_period, [(COMPLETE, "complete")], job_desc)


def compacted_events(events: DataFrame) -> DataFrame:
    """At most four events of each run, from which `run_log_latest` says the same: its first and its last start, and the last event.

    The start with the earliest time gives ``create_time``, the last one the description. Ends without a start stay, as a
    start may still come late.
    """
    at = F.struct("event_time", "event_id")
    rest = [c for c in events.columns if c not in RUN_KEY]
    event, started = F.struct(*rest), F.col("status") == STARTED
    kept = F.array_distinct(
        F.array_compact(
            F.array(F.min_by(event, F.when(started, at)), F.max_by(event, F.when(started, at)), F.max_by(event, at))
        )
    )
    runs = events.groupBy(*RUN_KEY).agg(kept.alias("_kept"))
    return runs.select(*RUN_KEY, F.explode("_kept").alias("_event")).select(*[F.col(c) if c in RUN_KEY else F.col(f"_event.{c}") for c in events.columns])


def compact_run_log(spark: SparkSession, table: str, file_format: str = "orc") -> DataFrame:
    """Fold the event table into `compacted_events`, in few files, and put it in the place of the old one at once.

    Run it when no job is writing; events that are appended meanwhile would be lost.
    """
    return replace_table(compacted_events(spark.read.table(table)).coalesce(max(1, spark.sparkContext.defaultParallelism)), table, file_format)


def complete_jobs(log: DataFrame, job_period: str) -> set[str]:
    """The names of the jobs whose latest run of the period, of any application, ended complete."""
    latest = log.where(F.col("job_period") == job_period).groupBy("job_name").agg(F.max_by("status", F.struct("event_time", "event_id")).alias("status"))
    return {r["job_name"] for r in latest.where(F.col("status") == COMPLETE).collect()}


def run_log_latest(events: DataFrame) -> DataFrame:
    """One row per run that was started, with its description and its latest status and result.

    ``create_time`` is the first start; ``end_time`` the latest end, null while the run is open, also if it
    was started again after an end. A run that has ends only was never started and is left out. Events of the
    same time are ordered by ``event_id``.
    """
    at = F.struct("event_time", "event_id")
    started = F.col("status") == STARTED
    runs = events.groupBy(*RUN_KEY).agg(
        F.min(F.when(started, F.col("event_time"))).alias("created"),
        F.max(F.when(started, at)).alias("start"),
        F.max_by(F.struct("job_desc", "project"), F.when(started, at)).alias("about"),
        F.max_by(F.struct("status", "result", "event_time"), at).alias("last"),
    )
    ended = F.when(F.col("last.status") != STARTED, F.col("last.event_time"))
    return runs.where(F.col("start").isNotNull()).select(
        "job_id",
        "job_name",
        F.col("about.job_desc").alias("job_desc"),
        "job_period",
        F.col("about.project").alias("project"),
        fmt_datetime_19(F.col("created")).alias("create_time"),
        fmt_datetime_19(ended).alias("end_time"),
        F.col("last.status").alias("status"),
        single_to_double_quotes(F.col("last.result")).alias("result"),
    )
