"""Monthly base labels: every enabled source labelled, joined to the main one, one text per user."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Collection, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tagloom.functions.dates import previous_period
from tagloom.operators.joins import Salt, join_tags
from tagloom.operators.rules import Rule, RulesById
from tagloom.operators.tags import tag_source
from tagloom.sinks.period import save_period
from tagloom.sinks.runlog import COMPLETE, FAILED, STARTED, RunLog, complete_jobs
from tagloom.sources.catalog import label_tasks, read_rules, screen_tasks
from tagloom.sources.tables import period_scan


@dataclass(frozen=True)
class SourceStatus:
    source: str
    status: str
    result: str
    partition_field: str | None = None


class MainSourceError(ValueError):
    """The main source has no labels to join the others to; ``statuses`` says what became of each source."""

    def __init__(self, main: str, statuses: list[SourceStatus]) -> None:
        super().__init__(f"main source {main!r} could not be labelled: {statuses}")
        self.statuses = statuses


@dataclass
class BaseLabels:
    """The labels ``(id, labels)`` and what became of each work unit."""

    labels: DataFrame
    statuses: list[SourceStatus] = field(default_factory=list)


def label_source(
    read: Callable[[str], DataFrame],
    source: str,
    partition_field: str,
    period: str,
    label_ids: Sequence[str],
    rules: Iterable[Rule] | RulesById,
    id_column: str,
) -> DataFrame:
    """One work unit: period scan, all its labels in one projection, one text per row."""
    snapshot = period_scan(read(source), partition_field, period)
    return tag_source(snapshot, sorted(label_ids), rules, id_column)


class UnitStore:
    """Saved labels of work units, so that a run that starts again computes only what is not there.

    A unit is saved as a period of a table of its own, and is complete once the run log says so: units that were
    logged complete for the period are read, all others are labelled and saved.
    """

    def __init__(self, spark: SparkSession, database: str, log: RunLog) -> None:
        self.spark, self.database, self.log = spark, database, log
        self.read: list[str] = []

    def _job(self, source: str, partition_field: str) -> str:
        return f"unit {source}/{partition_field}"

    def unit(self, source: str, partition_field: str, period: str, label: Callable[[], DataFrame]) -> DataFrame:
        """The labels of the unit: saved by an earlier run, or what ``label`` gives, saved and logged."""
        job = self._job(source, partition_field)
        table = f"{self.database}.`unit_{re.sub('[^A-Za-z0-9_]', '_', f'{source}_{partition_field}')}`"
        if self.spark.catalog.tableExists(self.log.table) and job in complete_jobs(self.spark.read.table(self.log.table), period):
            self.read.append(job)
            saved = self.spark.read.table(table)
        else:
            with self.log.run(job, period):
                saved = save_period(label(), table, period, partition_field="_period")
        return period_scan(saved, "_period", period).select("id", "labels")


def base_labels(
    read: Callable[[str], DataFrame],
    catalog: DataFrame,
    period: str,
    *,
    main: str,
    enabled: Sequence[str],
    id_column: str,
    unique: Collection[str] = (),
    salted: bool = True,
    kept: UnitStore | None = None,
) -> BaseLabels:
    """Label all work units of the enabled sources and join them to ``main`` on user id.

    ``read`` turns a source name into its table, for example ``spark.read.table``. A unit that cannot be
    labelled, for whatever reason, is reported and left out; without the main source there is no result,
    nor if the main source has rules in several partition fields, as none of them is the main one. Labels
    come in the order main, then ``enabled``, by partition field within a source, and ascending within a
    unit. ``salted=False`` skips the search for ids that fill a large share of the main source. ``kept`` saves what
    each unit gives, and gives back what an earlier run of the period has saved.
    """
    tasks = screen_tasks(label_tasks(catalog), enabled)
    rules = read_rules(catalog, tasks)
    units: dict[str, list] = {}
    for unit in sorted(tasks.collect(), key=lambda u: u.partition_field or ""):
        units.setdefault(unit.source_name, []).append(unit)
    labelled: dict[str, DataFrame] = {}
    single: list[str] = []
    statuses: list[SourceStatus] = []
    for source in [main, *[s for s in enabled if s != main]]:
        for unit in units.get(source, []):
            name, partition_field = f"{source}/{unit.partition_field}", unit.partition_field
            try:
                if source == main and len(units[main]) > 1:
                    raise ValueError(f"{len(units[main])} work units of the main source")
                label = lambda: label_source(read, source, partition_field, period, unit.pids.split("#"), rules, id_column)  # noqa: B023, E731
                labelled[name] = label() if kept is None else kept.unit(source, partition_field, period, label)
                statuses.append(SourceStatus(source, COMPLETE, "complete", partition_field))
            except Exception as e:  # whatever it is, the other sources go on
                statuses.append(SourceStatus(source, FAILED, str(e), partition_field))
            if source in unique:
                single.append(name)
    first = next((n for n in labelled if n.startswith(f"{main}/")), None) if main in units else None
    if first is None:
        raise MainSourceError(main, statuses)
    main_tags = labelled.pop(first)
    salt = Salt.of(main_tags, "id") if salted and labelled else None
    return BaseLabels(join_tags(main_tags, labelled, salt, single), statuses)


def _log_sources(log: RunLog, period: str, statuses: Sequence[SourceStatus]) -> None:
    changes = [(s.source, [(STARTED, "start"), (s.status, s.result)]) for s in statuses]
    log.append_all([(name, period, "", change) for name, change in changes])


def run_base_labels(
    spark: SparkSession,
    catalog: str,
    target: str,
    log: RunLog,
    period: str | None = None,
    *,
    today: dt.date | None = None,
    units: str | None = None,
    **options,
) -> BaseLabels:
    """The whole monthly job on catalog tables: label, join, save the period, write the run log.

    Without ``period`` it is the month before ``today``. The run is logged from before the plan is made;
    what became of each work unit is logged in either case. With ``units``, a database, the labels of every work unit
    are saved there (`UnitStore`), and a job that is started again after a failure labels only the units that are not
    complete. Drop the database to label all anew.
    """
    period = period or previous_period(today or dt.date.today())
    with log.run(target, period):
        try:
            kept = None if units is None else UnitStore(spark, units, log)
            plan = base_labels(spark.read.table, spark.read.table(catalog), period, kept=kept, **options)
        except MainSourceError as e:
            _log_sources(log, period, e.statuses)
            raise
        _log_sources(log, period, plan.statuses)
        save_period(plan.labels, target, period)
    return plan
