"""Catalog, tables, run log and the monthly jobs end to end on catalog tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tagloom.plans import doc_update, jobs, resident, station_report, user_markets
from tagloom.plans.base_labels import MainSourceError, base_labels, run_base_labels
from tagloom.plans.publish import publish_key_values, publish_relational
from tagloom.sinks import buckets
from tagloom.sinks import period as p
from tagloom.sinks.relational import jdbc_write_options, rolling_append
from tagloom.sinks.runlog import EVENT_SCHEMA, RunLog, run_log_latest
from tagloom.sinks.scratch import drop_scratch, shared_database, shared_folder, stored
from tagloom.sources import catalog as c
from tagloom.sources import tables as t
from workload import standins as s


@pytest.fixture(scope="module")
def rules(spark):
    return s.rules_catalog(spark)


def test_work_units(rules, rows):
    units = {r.source_name: (r.pids, r.labels) for r in c.label_tasks(rules).collect()}
    assert set(units) == {"user_profile", "user_activity", "user_spend", "user_visit", "disabled_src"}
    assert units["user_spend"] == ("301#302", "orders#price#priority")
    assert c.label_tasks_single(rules, "disabled_src").count() == 0  # its only rule has no body
    assert {r.source_name for r in c.screen_tasks(c.label_tasks(rules), s.ENABLED).collect()} == set(s.ENABLED)
    assert c.label_catalog(rules, "302").count() == 2


def test_only_the_rules_of_the_units_are_read(spark, rules):
    many = spark.range(20_001).select(
        F.col("id").cast("string").alias("id"), F.lit('{"x":{"value":"1","type":"single"}}').alias("value"),
        F.lit("elsewhere").alias("source_name"), F.lit("n").alias("source_label"), F.lit("dt").alias("partition_field"),
    )
    read = c.read_rules(rules.unionByName(many), c.label_tasks_single(rules, "user_spend"))
    assert {i: sorted(r.source_name for r in rs) for i, rs in read.items()} == {
        "301": ["elsewhere", "user_spend"], "302": ["elsewhere", "user_spend", "user_spend"],
    }


def test_a_source_with_two_partition_fields_keeps_all_labels(spark, rows):
    table = spark.createDataFrame([("u1", 1, "202401", "x"), ("u1", 2, "x", "202401"), ("u2", 1, "202401", "202401")], "id string, n int, month_id string, dt string")
    body = '{"n":{"value":"[%d,%d]","type":"range"}}'
    catalog = [
        ("0", body % (1, 9), "people", "a", "month_id"), ("1", body % (1, 1), "acts", "a", "month_id"), ("2", body % (2, 2), "acts", "b", "dt"),
    ]
    for order in (catalog, catalog[::-1]):
        given = spark.createDataFrame(order, c.CATALOG_SCHEMA)
        plan = base_labels(lambda _: table, given, "202401", main="people", enabled=["people", "acts"], id_column="id")
        assert rows(plan.labels) == [("u1", "0,2,1"), ("u2", "0,1")]
        assert [(x.source, x.partition_field, x.status) for x in plan.statuses] == [("people", "month_id", "1"), ("acts", "dt", "1"), ("acts", "month_id", "1")]
        with pytest.raises(MainSourceError) as e:
            base_labels(lambda _: table, given, "202401", main="acts", enabled=["people", "acts"], id_column="id")
        assert [x.status for x in e.value.statuses] == ["2", "2", "1"]


MONTHLY = ["base_labels_units", "base_labels_months", "station_report_months", "resident_attributes_months", "labels_append_months"]


@pytest.mark.parametrize("name", MONTHLY)
def test_months_matter(spark, sf, monkeypatch, name):
    """Without its period filter the query differs from its SQL."""
    from tagloom.plans import base_labels as labels_plan
    from workload.check import connect, difference
    from workload.oracles import oracle_sql
    from workload.queries import QUERIES

    for module in (labels_plan, resident, station_report):
        monkeypatch.setattr(module, "period_scan", lambda df, *_: df)
    assert difference(QUERIES[name](spark, sf), connect(sf), oracle_sql()[name]) is not None


def test_relational_types(spark):
    kinds = {"s": "java.lang.String", "i": "java.lang.Integer", "l": "java.lang.Long", "b": "java.lang.Boolean", "d": "java.lang.Double",
             "f": "java.lang.Float", "day": "java.sql.Date", "t": "java.sql.Time", "ts": "java.sql.Timestamp", "n": "java.math.BigDecimal"}
    assert t.relational_schema(kinds).simpleString() == (
        "struct<s:string,i:int,l:bigint,b:boolean,d:double,f:float,day:date,t:timestamp,ts:timestamp,n:decimal(10,0)>"
    )
    typed = t.as_relational(spark.sql("select 1 i, '2' n, 'x' other"), {"n": "java.math.BigDecimal", "i": "java.lang.Long"})
    assert typed.dtypes == [("n", "decimal(10,0)"), ("i", "bigint")]
    with pytest.raises(ValueError, match="java.sql.Blob"):
        t.relational_schema({"x": "java.sql.Blob"})


def latest(spark, database):
    return {r.job_name: r for r in run_log_latest(spark.table(f"{database}.runs")).collect()}


def test_failed_base_labels_are_logged(spark, rules, database):
    rules.write.saveAsTable(f"{database}.rules")
    log = RunLog(spark, f"{database}.runs", "p")
    with pytest.raises(MainSourceError):
        run_base_labels(spark, f"{database}.rules", "target", log, main="user_profile", enabled=["user_profile"], id_column="x", today=dt.date(2024, 2, 5))
    runs = latest(spark, database)
    assert {n: (r.status, r.job_period, r.project) for n, r in runs.items()} == {
        "target": ("2", "202401", "p"), "user_profile": ("2", "202401", "p"),
    }
    with pytest.raises(Exception, match="no_catalog"):
        run_base_labels(spark, f"{database}.no_catalog", "other", log, main="m", enabled=[], id_column="x")
    assert latest(spark, database)["other"].status == "2"


class Stored(list):
    """A store that keeps what it is given and returns it."""

    def append(self, rows):
        super().append(rows)
        return rows


def job_cases(spark, database, log):
    """Each job as a call of the frames it reads, what it stores, and its name in the log."""
    doc, out = spark.createDataFrame([("1", "a")], "id string, labels string"), Stored()
    rows = spark.createDataFrame([("1", "x", "7", "202401"), ("2", "y", "8", "202312")], "id string, labels string, atid string, month_id string")
    return out, {
        "user_markets": lambda df: jobs.run_user_markets(doc, df or rows, spark.createDataFrame([("7", "1,2")], "atid string, userids string"), spark.createDataFrame([("7", "NOTERESSUC", dt.date(2024, 1, 1))], "atid string, bstatus string, send_time date"), out.append, log, "202401"),
        "update_src": lambda df: jobs.run_document_update(doc, None, None, "src", "delete" if df is None else "nothing", out.append, log, "202401", id_column="id", label_id="a"),
        "publish_documents": lambda df: jobs.run_publish_documents(doc, df or rows, out.append, log, "202401", id_column="id", other_columns="labels"),
        f"{database}.relational": lambda df: jobs.run_publish_relational(df or rows, f"{database}.relational", log, today=dt.date(2024, 2, 29)),
        "publish_set": lambda df: jobs.run_publish_key_values(df or rows, "set", out.append, log, "202401", key="k", value="id", order=[]),
    }


def test_jobs_store_and_log(spark, rows, database):
    out, cases = job_cases(spark, database, RunLog(spark, f"{database}.runs"))
    got = {name: rows(job(None)) for name, job in cases.items()}
    assert got == {
        "user_markets": [("1", "x", "7")], "update_src": [("1", "")], "publish_documents": [("1", "x")],
        f"{database}.relational": [("1", "x", "7", "202401")], "publish_set": [("k", "1")],
    }
    assert len(out) == 4
    assert {n: (r.status, r.job_period) for n, r in latest(spark, database).items()} == {n: ("1", "202401") for n in cases}


def test_jobs_return_what_was_stored(spark, rows, database):
    """The state that a job reads is replaced by its store; the returned table is the stored one, however often it is read."""
    state, log = f"{database}.documents", RunLog(spark, f"{database}.runs")
    store = buckets.table_store(state)
    store(spark.createDataFrame([("u1", "5")], "id string, labels string"))
    source = spark.createDataFrame([("u1", "x", "202401")], "k string, f string, month_id string")
    rules = spark.createDataFrame([("101", '{"f":{"value":"x","type":"single"}}', "src", "l", "month_id")], c.CATALOG_SCHEMA)
    got = jobs.run_document_update(spark.table(state), lambda _: source, rules, "src", "add", store, log, "202401", id_column="k")
    assert rows(got) == rows(got) == rows(spark.table(state)) == [("u1", "5,101")]
    labels = spark.createDataFrame([("u1", "7", "202401"), ("u2", "8", "202401")], "id string, labels string, month_id string")
    none = spark.createDataFrame([], "atid string, userids string"), spark.createDataFrame([], "atid string, bstatus string, send_time date")
    got = jobs.run_user_markets(spark.table(state), labels, *none, store, log, "202401")
    assert rows(got) == rows(got) == [("u1", "7", None), ("u2", "8", None)]
    entries = f"{database}.entries"
    first = jobs.run_publish_key_values(labels, "set", buckets.table_store(entries), log, "202401", key="k", value="id", order=[])
    more = labels.withColumn("id", F.concat("id", F.lit("!")))
    got = jobs.run_publish_key_values(more, "set", buckets.table_store(entries), log, "202401", state=first, key="k", value="id", order=[])
    assert rows(got) == rows(got) == [("k", "u1"), ("k", "u1!"), ("k", "u2"), ("k", "u2!")]


def test_failed_jobs_are_logged(spark, database):
    out, cases = job_cases(spark, database, RunLog(spark, f"{database}.runs"))
    for job in cases.values():
        with pytest.raises(Exception):
            job(spark.createDataFrame([(1,)], "unfit int"))
    assert out == [] and {n: r.status for n, r in latest(spark, database).items()} == {n: "2" for n in cases}


def test_saving_jobs_fail_with_a_log(spark, rules, database):
    log = RunLog(spark, f"{database}.runs")
    with pytest.raises(Exception):
        jobs.run_station_report(spark, "no_stations", "no_labels", "report", log, "202401", label_ids=["1"])
    rules.write.saveAsTable(f"{database}.rules")
    with pytest.raises(Exception):
        jobs.run_resident_attributes(spark, f"{database}.rules", "nothing", "attributes", log, "202401", id_column="i", place_column="p")
    assert {n: r.status for n, r in latest(spark, database).items()} == {"report": "2", "attributes": "2"}


def test_run_log_of_restarts_and_strays(spark):
    def event(minute, name, status):
        return ("j", name, f"desc {minute}", "202401", "p", dt.datetime(2024, 1, 1, 0, minute), minute, status, status)

    events = [event(1, "open again", "0"), event(2, "open again", "1"), event(3, "open again", "0"), event(1, "stray", "1"),
              event(1, "late", "2"), event(2, "late", "0"), event(1, "done", "0"), event(2, "done", "2")]
    got = {r.job_name: r for r in run_log_latest(spark.createDataFrame(events, EVENT_SCHEMA)).collect()}
    assert {n: (r.status, r.create_time[-5:], (r.end_time or "")[-5:], r.job_desc) for n, r in got.items()} == {
        "open again": ("0", "01:00", "", "desc 3"), "late": ("0", "02:00", "", "desc 2"), "done": ("2", "01:00", "02:00", "desc 1"),
    }
    assert len(got["done"]) == 9


def test_unreadable_bodies_are_kept(spark, rows):
    from tagloom.operators.rules import rule_conditions

    bodies = ["not json", "", None, "{}", '{"a":{"value":"1"}}', '{"a":{"type":"near","value":"1"}}', '{"a":{"type":"list"}}', '{"a":{"type":"list","value":"1"}}']
    df = spark.createDataFrame([(str(i), b, "s") for i, b in enumerate(bodies)], "id string, value string, source_name string")
    errors = {r["id"]: r["error"] for r in rule_conditions(df).collect()}
    unreadable = "unreadable rule body"
    assert [errors[str(i)] for i in range(8)] == [unreadable] * 4 + ["no match type", "unknown match type", "no value", None]


def test_default_period(spark, rows):
    df = spark.createDataFrame([("202101", "20210228"), ("202102", "20210331")], "month_id string, day_id string")
    assert rows(t.default_period_scan(df, "month_id", dt.date(2021, 3, 31))) == [("202102", "20210331")]
    assert rows(t.default_period_scan(df, "day_id", dt.date(2021, 3, 1))) == [("202101", "20210228")]
    with pytest.raises(KeyError):
        t.default_period_scan(df, "region", dt.date(2021, 3, 1))


def test_relational_options():
    assert t.jdbc_read_options("u", "select 1")["dbtable"] == "(select 1) q"
    ranged = t.jdbc_read_options("u", "q", "id", ("0", "9"), 4)
    assert (ranged["partitionColumn"], ranged["lowerBound"], ranged["upperBound"], ranged["numPartitions"]) == ("id", "0", "9", "4")
    with pytest.raises(ValueError):
        t.jdbc_read_options("u", "q", "id")
    assert jdbc_write_options("u", "t", 5)["batchsize"] == "5"


@pytest.fixture
def history(spark, database):
    months = ["202212", "202301", "202312", "202311"]
    for m in months:
        p.save_period(spark.createDataFrame([("1", m)], "id string, labels string"), f"{database}.h", m, retention_months=99)
    return f"{database}.h"


def months(spark, table):
    return p.periods(spark, table, "month_id")


def test_save_replaces_one_period_and_drops_one(spark, rows, history):
    new = spark.createDataFrame([("x", "ignored", "new")], "labels string, month_id string, id string")
    assert ("new", "x", "202401") in rows(p.save_period(new, history, "202401"))
    assert months(spark, history) == ["202212", "202311", "202312", "202401"]
    again = spark.createDataFrame([("2", "y")], "id string, labels string")
    p.save_period(again, history, "202401")
    assert rows(spark.table(history).where("month_id = '202401'")) == [("2", "y", "202401")]
    assert rows(spark.table(history).where("month_id = '202312'")) == [("1", "202312", "202312")]


def test_save_can_drop_all_older_periods(spark, history):
    p.save_period(spark.createDataFrame([("1", "x")], "id string, labels string"), history, "202401", retain="at_least")
    assert months(spark, history) == ["202311", "202312", "202401"]


def test_save_default_period(spark, history):
    p.save_default_period(spark.createDataFrame([("1", "x")], "id string, labels string"), history, dt.date(2023, 12, 31))
    assert months(spark, history) == ["202301", "202311", "202312"]


def test_saved_periods_are_pruned(spark, plan, history):
    text = plan(t.period_scan(spark.table(history), "month_id", "202312"))
    assert "PartitionFilters: [isnotnull(month_id" in text and "cast(month_id" not in text


def test_rolling_append(spark, rows, history):
    df = spark.createDataFrame([("5", "a", "202401"), ("6", "b", "202312")], "id string, labels string, month_id string")
    rolling_append(df, history, "202401")
    assert months(spark, history) == ["202212", "202301", "202312", "202401"]
    rolling_append(df, history, "202401")
    assert spark.table(history).where("month_id = '202401'").count() == 2
    publish_relational(df, history, "202401", idempotent=True)
    assert rows(spark.table(history).where("month_id = '202401'")) == [("5", "a", "202401")]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark) != shared_folder(spark)


def test_scratch_databases_are_dropped(spark):
    name = shared_database(spark)
    spark.range(3).write.saveAsTable(f"{name}.t")
    kept = stored(spark.range(3))
    folder = os.path.dirname(kept.inputFiles()[0].removeprefix("file://"))
    assert kept.count() == 3 and os.path.isdir(folder)
    drop_scratch(spark)
    assert not spark.catalog.databaseExists(name) and not os.path.exists(folder)


def test_run_log(spark, rows, database):
    log = RunLog(spark, f"{database}.runs", "p")
    with log.run("good", "202401"):
        pass
    with pytest.raises(RuntimeError), log.run("bad", "202401"):
        raise RuntimeError("it's broken")
    log.append("open", "202401", [("0", "start")])
    latest = {r.job_name: r for r in run_log_latest(spark.table(f"{database}.runs")).collect()}
    assert (latest["good"].status, latest["good"].result) == ("1", "complete")
    assert latest["bad"].status == "2" and 'it"s broken' in latest["bad"].result
    assert latest["open"].status == "0" and latest["open"].end_time is None
    assert latest["good"].create_time <= latest["good"].end_time


def options(**more):
    return {"main": s.MAIN, "enabled": s.ENABLED, "id_column": "user_id"} | more


def test_one_bad_source_does_not_stop_the_others(spark, sf, rules, rows):
    broken = rules.union(
        spark.createDataFrame(
            [("501", '{"nowhere":{"value":"1","type":"single"}}', "user_visit", "x", "month_id"),
             ("601", '{"x":{"value":"1","type":"single"}}', "no_such_table", "x", "month_id")],
            c.CATALOG_SCHEMA,
        )
    )
    enabled = [*s.ENABLED, "user_visit", "no_such_table", "disabled_src"]
    plan = base_labels(s.reader(spark, sf), broken, s.PERIOD, **options(enabled=enabled))
    statuses = {x.source: x.status for x in plan.statuses}
    assert statuses == {n: "1" for n in s.ENABLED} | {"user_visit": "2", "no_such_table": "2", "disabled_src": "2"}
    assert rows(plan.labels) == rows(s.labelled(spark, sf).labels)


def test_without_main_source_there_is_no_result(spark, sf, rules):
    with pytest.raises(ValueError, match="main source"):
        base_labels(s.reader(spark, sf), rules, s.PERIOD, **options(main="no_such_table", enabled=["user_spend"]))


def test_salting_does_not_change_the_labels(spark, sf, rows):
    assert rows(s.labelled(spark, sf, salted=True).labels) == rows(s.labelled(spark, sf, salted=False).labels)


def test_monthly_job_on_catalog_tables(spark, sf, rules, rows, database):
    names = {n: f"{database}.{n}" for n in s.ENABLED}
    for name, full in names.items():
        source = s.SOURCES[name](spark, sf)
        source.write.format("orc").partitionBy("month_id").saveAsTable(full)
    stored = rules.withColumn("source_name", F.concat(F.lit(f"{database}."), F.trim("source_name")))
    stored.write.format("orc").saveAsTable(f"{database}.rules")
    log = RunLog(spark, f"{database}.runs")
    run_base_labels(
        spark, f"{database}.rules", f"{database}.user_labels", log, s.PERIOD,
        main=names["user_profile"], enabled=list(names.values()), id_column="user_id",
    )
    saved = t.period_scan(t.table_scan(spark, f"{database}.user_labels"), "month_id", s.PERIOD)
    assert rows(saved.select("id", "labels")) == rows(s.labelled(spark, sf).labels)
    runs = run_log_latest(spark.table(f"{database}.runs")).collect()
    assert {r.job_name: r.status for r in runs} == {n: "1" for n in [*names.values(), f"{database}.user_labels"]}


def test_campaign_window():
    today = dt.date(2024, 3, 31)
    assert user_markets.window_start("202401", 3, today) == dt.date(2023, 10, 1)
    assert user_markets.window_start("202401", None, today) == dt.date(2023, 7, 1)
    assert user_markets.window_start(None, 1, today) == dt.date(2024, 2, 29)
    assert user_markets.window_start(None, None, today) is None


def test_user_markets_with_a_hot_user(spark, rows):
    labels = spark.createDataFrame([("hot", "1")] * 40 + [("2", ""), ("3", "x"), (None, "y")], "id string, labels string").repartition(8)
    batches = spark.createDataFrame([("A", "hot,hot,2"), ("B", "hot"), ("C", "3"), (None, "2")], "atid string, userids string")
    actions = spark.createDataFrame([("A",), ("A",), ("B",)], "atid string")
    want = [(None, "y", None), ("2", "", "A"), ("3", "x", None)] + [("hot", "1", "A,B")] * 40
    for salted in (True, False):
        got = user_markets.user_markets(labels, batches, actions, salted)
        assert rows(got) == sorted(want, key=lambda r: [(v is not None, v) for v in r])


def test_station_report_equals_row_by_row_counts(spark, sf):
    import json

    stations, labels = s.station_live(spark, sf), s.user_labels(spark, sf)
    joined = station_report.station_join(stations, labels, s.PERIOD).collect()
    want = {}
    for r in joined:
        row = want.setdefault((r.lac_ci, r.dn_flag), {f"label_{i}": 0.0 for i in s.STATION_LABELS})
        for i in set(r.labels.split(",")) & set(s.STATION_LABELS):
            row[f"label_{i}"] += 1
    got = station_report.station_report(stations, labels, s.PERIOD, s.STATION_LABELS).collect()
    for r in got:
        result = json.loads(r.result)
        assert (result.pop("lac_ci"), result.pop("dn_flag")) == (r.lac_ci, r.dn_flag)
        assert list(result) == [f"label_{i}" for i in s.STATION_LABELS]
        assert result == want.pop((r.lac_ci, r.dn_flag)) and r.month_id == s.PERIOD
    assert not want


def test_resident_attributes_need_one_work_unit(spark, sf, rules):
    with pytest.raises(ValueError, match="0 work units"):
        resident.resident_attributes(s.reader(spark, sf), rules, "nothing", s.PERIOD, id_column="user_id", place_column="lac_ci")


def test_document_update_actions(spark, sf, rules, rows):
    docs = s.documents(spark, sf)
    args = (s.reader(spark, sf), rules, "user_activity", s.PERIOD)
    removed = doc_update.document_update(docs, *args, "DELETE", id_column="user_id", label_id="101")
    assert removed.where(F.array_contains(F.split("labels", ","), "101")).count() == 0
    with pytest.raises(ValueError):
        doc_update.document_update(docs, *args, "replace", id_column="user_id")


def test_publish_key_values_of_a_period(spark, rows):
    df = spark.createDataFrame([("a", 1, "202401"), ("b", 2, "202312")], "m string, n int, month_id string")
    got = publish_key_values(df, "set", "month_id", "202401", key="k", value="m#n", order=[])
    assert rows(got) == [("k", "a,1")]
