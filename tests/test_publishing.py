"""Statements, control tables, publishing in two steps, the compacted log and jobs that start again."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators.changes import row_digest
from tagloom.plans import resident
from tagloom.plans.base_labels import run_base_labels
from tagloom.plans.doc_update import document_update
from tagloom.sinks import period as p
from tagloom.sinks import staged as st
from tagloom.sinks.runlog import EVENT_SCHEMA, RunLog, compact_run_log, compacted_events, complete_jobs, run_log_latest
from tagloom.sources import catalog as c
from tagloom.sources import statements as sm

LABELS = "id string, labels string"


# Statements


def test_values_are_bound_not_written(spark, rows):
    spark.createDataFrame([("a'b", 1, dt.date(2024, 1, 2)), ("x", 2, dt.date(2024, 3, 4))], "s string, n int, d date").createOrReplaceTempView("statement_rows")
    find = "select s from statement_rows where s = '{s}'"
    assert rows(sm.statement(spark, find, {"s": "a'b", "unused": 1})) == [("a'b",)]
    assert rows(sm.statement(spark, find, {"s": "x' or '1' = '1"})) == []
    assert rows(sm.statement(spark, find, {"s": "{n}"})) == []
    typed = sm.statement(spark, "select n + {n} m, {d} d, {b} b, {f} f, '{s}' s, {s} t from statement_rows where d < {d}", {
        "n": 5, "d": dt.date(2024, 2, 1), "b": True, "f": 0.5, "s": "q'"})
    assert [t for _, t in typed.dtypes] == ["int", "date", "boolean", "double", "string", "string"]
    assert rows(typed) == [(6, dt.date(2024, 2, 1), True, 0.5, "q'", "q'")]
    with pytest.raises(KeyError, match="dt, month"):
        sm.statement(spark, "select {month}, '{dt}'", {"other": 1})


# Periods of a control table


@pytest.fixture
def history(spark, database):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("labels"), F.format_string("2024%02d", F.col("id") % 10 + 1).alias("month_id"))
    df.write.partitionBy("month_id").format("parquet").saveAsTable(f"{database}.h")
    rows = [("labels", "202403", True), ("labels", "202403", True), ("labels", "202404", False), ("labels", "202407", True), ("other", "202408", True), ("labels", "209901", True)]
    spark.createDataFrame(rows, "source_name string, period string, enabled boolean").write.saveAsTable(f"{database}.control")
    return f"{database}.h", f"{database}.control"


def test_the_wanted_partitions_are_read_only(spark, plan, history):
    df = sm.controlled_scan(spark.table(history[0]), spark.table(history[1]), "labels", "month_id")
    assert {r["month_id"]: r["count"] for r in df.groupBy("month_id").count().collect()} == {"202403": 100, "202407": 100}
    assert "dynamicpruning" in plan(df)
    df.collect()
    executed = df._jdf.queryExecution().executedPlan()
    text = executed.toString()
    scan = text[text.index("Final Plan") : text.index("Initial Plan")] if "Final Plan" in text else text
    assert "dynamicpruning" in scan


def test_an_empty_control_table(spark, history):
    assert sm.controlled_scan(spark.table(history[0]), spark.table(history[1]).limit(0), "labels", "month_id").count() == 0


# Publishing in two steps


@pytest.fixture
def published(spark, database):
    table = f"{database}.published"
    for month in ("202311", "202312"):
        p.save_period(spark.createDataFrame([("1", month)], LABELS), table, month)
    return table


def rows_of(spark, table, month):
    return sorted(tuple(r) for r in spark.table(table).where(F.col("month_id") == month).select("id", "labels").collect())


def location(spark, table, month):
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION (month_id = '{month}')").collect()
    return next(r[1] for r in described if r[0] == "Location")


def test_a_period_is_put_in_place_at_once(spark, published):
    new = spark.createDataFrame([("1", "a"), ("2", None), ("2", None)], LABELS)
    staged = st.stage(new, published, "202312")
    # A failure here leaves the old period readable, and the next run starts over.
    assert rows_of(spark, published, "202312") == [("1", "202312")] and st.published(spark, published, "202312") is None
    assert staged.rows == 3
    st.put_in_place(spark, published, "202312", staged)
    want = [("1", "a"), ("2", None), ("2", None)]
    assert sorted(rows_of(spark, published, "202312"), key=repr) == sorted(want, key=repr)
    assert rows_of(spark, published, "202311") == [("1", "202311")]
    assert st.published(spark, published, "202312") == staged


def test_the_same_rows_again_leave_the_table(spark, published):
    new = spark.createDataFrame([("1", "a"), ("2", "b")], LABELS)
    st.publish_period(new, published, "202401")
    first = location(spark, published, "202401")
    st.publish_period(new.orderBy(F.desc("id")).repartition(2), published, "202401")
    assert location(spark, published, "202401") == first and rows_of(spark, published, "202401") == [("1", "a"), ("2", "b")]
    assert spark.table(f"{published}__manifest").count() == 1
    st.publish_period(new.union(new.limit(1)), published, "202401")
    assert location(spark, published, "202401") != first and len(rows_of(spark, published, "202401")) == 3
    assert st.published(spark, published, "202401").rows == 3


def test_a_failed_stage_changes_nothing(spark, published):
    broken = spark.range(10).select(F.col("id").cast("string").alias("id"), F.raise_error(F.lit("broken")).cast("string").alias("labels"))
    with pytest.raises(Exception, match="broken"):
        st.publish_period(broken, published, "202312")
    assert rows_of(spark, published, "202312") == [("1", "202312")]


def test_checksums_see_order_free_contents(spark):
    df = spark.createDataFrame([("1", None), (None, "1"), ("1", None)], LABELS)
    assert st.content(df) == st.content(df.repartition(3).orderBy(F.desc("id")))
    assert st.content(df) != st.content(df.distinct()) and st.content(df.limit(0)) == (0, "0/0")
    assert st.content(df.where("id is null")) != st.content(df.where("id is not null").limit(1))
    assert row_digest(["id"]) is not None


# The compacted log, and jobs that start again


def test_compaction_keeps_the_latest_state(spark, rows, database):
    r = random.Random(3)
    events = [(r.choice("ab"), r.choice("xyz"), f"d{i}", r.choice(["202401", "202402"]), "p", dt.datetime(2024, 1, 1, 0, r.randint(0, 9)), r.randint(0, 9), r.choice("0012"), f"r{i}") for i in range(300)]
    events += [("solo", "end", "d", "202401", "p", dt.datetime(2024, 1, 1), 1, "1", "r")]
    # Equal times and numbers have no order; drop them, as the latest state would not be one of both either.
    events = list({(e[0], e[1], e[3], e[5], e[6]): e for e in events}.values())
    table = f"{database}.runs"
    spark.createDataFrame(events, EVENT_SCHEMA).repartition(9).write.format("orc").saveAsTable(table)
    before, count = rows(run_log_latest(spark.table(table))), len(events)
    compact_run_log(spark, table)
    assert rows(run_log_latest(spark.table(table))) == before and spark.table(table).count() < count / 3
    assert rows(compacted_events(spark.table(table))) == rows(spark.table(table))
    log = RunLog(spark, table, "p")
    with log.run("x", "202401"):
        pass
    assert rows(run_log_latest(spark.table(table))) != before


def test_a_job_that_starts_again_labels_what_is_missing(spark, rows, database):
    body = '{"n":{"value":"[%d,%d]","type":"range"}}'
    catalog = [(str(i), body % (i, i + 1), f"{database}.s{i}", "a", "month_id") for i in range(3)]
    spark.createDataFrame(catalog, c.CATALOG_SCHEMA).write.saveAsTable(f"{database}.rules")
    source = spark.createDataFrame([("u1", 0, "202401"), ("u2", 1, "202401"), ("u3", 2, "202401")], "id string, n int, month_id string")
    for i in (0, 1):
        source.write.saveAsTable(f"{database}.s{i}")
    log, units = RunLog(spark, f"{database}.runs"), f"{database}_units"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {units} LOCATION '{spark.conf.get('spark.sql.warehouse.dir')}/{units}'")
    options = {"main": f"{database}.s0", "enabled": [f"{database}.s{i}" for i in range(3)], "id_column": "id", "units": units}
    run = lambda: run_base_labels(spark, f"{database}.rules", f"{database}.labels", log, "202401", **options)
    try:
        first = run()
        assert [x.status for x in first.statuses] == ["1", "1", "2"]  # the third source is not there yet
        assert complete_jobs(spark.table(f"{database}.runs"), "202401") >= {f"unit {database}.s0/month_id", f"unit {database}.s1/month_id"}
        # Both complete sources are gone now; only the third is read.
        source.write.saveAsTable(f"{database}.s2")
        for i in (0, 1):
            spark.sql(f"DROP TABLE {database}.s{i}")
        again = run()
        assert [x.status for x in again.statuses] == ["1", "1", "1"]
        saved = spark.table(f"{database}.labels").where("month_id = '202401'").select("id", "labels")
        assert rows(saved) == [("u1", "0"), ("u2", "0,1"), ("u3", "1,2")]
    finally:
        spark.sql(f"DROP DATABASE {units} CASCADE")


# Sources with rules in several partition fields


def test_all_units_of_a_source_count(spark, rows):
    table = spark.createDataFrame([("u1", "p", 1, "202401", "x"), ("u1", "q", 2, "x", "202401"), ("u2", "p", 1, "202401", "202401")], "id string, place string, n int, month_id string, dt string")
    body = '{"n":{"value":"[%d,%d]","type":"range"}}'
    catalog = spark.createDataFrame([("1", body % (1, 1), "acts", "a", "month_id"), ("2", body % (1, 2), "acts", "b", "dt")], c.CATALOG_SCHEMA)
    got = resident.resident_attributes(lambda _: table, catalog, "acts", "202401", id_column="id", place_column="place")
    assert rows(got) == [("u1", "p_1,q_2"), ("u2", "p_1,p_2")]
    state = spark.createDataFrame([("u1", "9")], LABELS)
    got = document_update(state, lambda _: table, catalog, "acts", "202401", "add", id_column="id")
    assert rows(got) == [("u1", "9,1,2"), ("u2", "1,2")]
