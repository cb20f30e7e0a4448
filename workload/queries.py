"""One query per operator: name -> (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions import dates, text
from tagloom.operators import aggregates, audiences, changes, documents, postings, rule_index, rules, tags
from tagloom.plans import base_labels as labels_plan
from tagloom.plans import doc_update, jobs, resident, station_report, user_markets
from tagloom.settings import apply_settings
from tagloom.sinks import buckets, keyvalue, period, relational, runlog, staged
from tagloom.sinks.scratch import shared_database
from tagloom.sources import catalog, statements, tables
from workload import standins as s

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ORDER_PERIOD = s.ORDER_PERIOD
BEFORE = "199805"
TODAY = dt.date(1998, 7, 15)
CAMPAIGN_SINCE = user_markets.window_start(s.PERIOD, 300, dt.date(2024, 2, 1))


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(apply_settings(spark), sf_dir)

    QUERIES[fn.__name__.rstrip("_")] = run
    return run


# Sources


@query
def period_scan(spark, sf):
    return tables.period_scan(s.orders_monthly(spark, sf), "month_id", ORDER_PERIOD)


@query
def statement_scan(spark, sf):
    """A statement with parameters, one of them with quotes and SQL in it."""
    s.table(spark, sf, "orders").createOrReplaceTempView("tagloom_statement_orders")
    text = """
        select o_orderkey, o_custkey, '{note}' note from tagloom_statement_orders
        where o_orderpriority = '{priority}' and o_orderdate >= {since} and o_totalprice > {least} and o_orderstatus <> '{note}'"""
    return statements.statement(spark, text, {"priority": "1-URGENT", "since": dt.date(1997, 1, 1), "least": 1000, "note": "it's' or '1' = '1"})


def _control(spark, sf):
    """The months with an even number of orders are enabled."""
    months = s.orders_monthly(spark, sf).groupBy("month_id").agg((F.count(F.lit(1)) % 2 == 0).alias("enabled"))
    return months.select(F.lit("order_labels").alias("source_name"), F.col("month_id").alias("period"), "enabled")


@query
def controlled_periods(spark, sf):
    """The periods of a saved table that a control table names."""
    history = tables.table_scan(spark, _label_history(spark, sf))
    control = f"{shared_database(spark)}.control"
    _control(spark, sf).write.saveAsTable(control)
    return statements.controlled_scan(history, tables.table_scan(spark, control), "order_labels", "month_id").select("id", "labels", "month_id")


@query
def default_period_scan(spark, sf):
    return tables.default_period_scan(s.orders_monthly(spark, sf), "month_id", TODAY)


@query
def table_scan(spark, sf):
    s.table(spark, sf, "orders").createOrReplaceTempView("tagloom_orders")
    return tables.table_scan(spark, "tagloom_orders")


@query
def label_catalog(spark, sf):
    return catalog.label_catalog(s.part_catalog(spark, sf), "10")


@query
def label_tasks(spark, sf):
    return catalog.label_tasks(s.part_catalog(spark, sf))


@query
def label_tasks_single(spark, sf):
    return catalog.label_tasks_single(s.part_catalog(spark, sf), "brand_7")


@query
def task_screen(spark, sf):
    return catalog.screen_tasks(catalog.label_tasks(s.part_catalog(spark, sf)), ["brand_7", "brand_21", "brand_99"])


@query
def relational_ingest(spark, sf):
    return tables.distinct_rows(s.table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority"))


@query
def union_distinct(spark, sf):
    seen = s.table(spark, sf, "events").select("user_id", F.col("event_type").alias("what"))
    bought = s.table(spark, sf, "orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("what"))
    return tables.distinct_rows(seen, bought)


# Rules and labels


@query
def rule_conditions(spark, sf):
    return rules.rule_conditions(s.part_catalog(spark, sf))


def _lines(spark, sf, **labels):
    lines = s.table(spark, sf, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", *[c.alias(n) for n, c in labels.items()])


@query
def match_single(spark, sf):
    returned = rules.match_single(F.col("l_returnflag"), "R")
    whole = rules.match_single(F.col("l_quantity"), "23")  # a double reads as "23.0"
    double = rules.match_single(F.col("l_quantity"), "23.0")
    return _lines(spark, sf, returned=returned, whole=whole, double=double)


@query
def match_list(spark, sf):
    flags = rules.match_list(F.col("l_returnflag"), "R, A,N")  # " A" is not "A"
    lines = rules.match_list(F.col("l_linenumber"), "1,3,5,,")
    return _lines(spark, sf, flags=flags, lines=lines)


@query
def match_range(spark, sf):
    quantity = F.col("l_quantity")
    forms = {"closed": "[10,20]", "open": "(10,20)", "from_low": "[10,20)", "to_high": "(10,20]"}
    return _lines(spark, sf, **{n: rules.match_range(quantity, v) for n, v in forms.items()})


@query
def match_range_text(spark, sf):
    amount = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.col("value").cast("string"))
    return s.table(spark, sf, "events").select(
        "event_id", F.when(rules.match_range(amount, "[10.5,99.25)"), "in").alias("label")
    )


def _rules(source):
    return [rules.Rule(*r) for r in s.RULES if r[2] == source]


@query
def match_all_fields(spark, sf):
    both = rules.label_column("104", _rules("user_profile"))
    return s.user_profile(spark, sf).select("user_id", "segment", "acctbal", both)


@query
def match_any_row(spark, sf):
    either = rules.label_column("302", _rules("user_spend"))
    return s.user_spend(spark, sf).select("user_id", "top_priority", "max_price", either)


@query
def label_columns(spark, sf):
    ids = ["101", "102", "103", "104", "105"]
    return tags.label_matrix(s.user_profile(spark, sf), ids, _rules("user_profile"), "user_id")


@query
def label_tags(spark, sf):
    return s.profile_tags(spark, sf)


@query
def part_labels(spark, sf):
    """All rules of the large catalog on all parts, by the index."""
    parts = s.table(spark, sf, "part").select("p_partkey", F.col("p_retailprice").alias("price"), F.col("p_type").alias("kind"))
    return rule_index.tag_by_index(parts, s.readable_rules(spark, sf), "p_partkey")


@query
def line_labels(spark, sf):
    """As many different rules as there are parts on all order lines, with the price of a piece: how many match, and the first."""
    kinds = s.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("kind"))
    lines = s.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    found = rule_index.rule_index(s.narrow_rules(spark, sf)).labelled(lines.join(kinds, "l_partkey"), "ids")
    return found.select("l_orderkey", "l_linenumber", F.size("ids").alias("n_labels"), F.get("ids", F.lit(0)).alias("first_label"))


@query
def composite_attr(spark, sf):
    return tags.composite_attribute(s.user_visit(spark, sf), ["401", "402"], _rules("user_visit"), "user_id", "lac_ci")


@query
def multi_hot(spark, sf):
    flags = tags.multi_hot_text(F.col("labels"), s.STATION_LABELS)
    return s.user_labels(spark, sf).select("id", flags.alias("flags"))


@query
def multi_hot_wide(spark, sf):
    flags = tags.multi_hot_text(F.col("labels"), s.STATION_LABELS)
    return s.user_labels(spark, sf).select("id", *tags.spread_text(flags, s.STATION_LABELS))


@query
def labels_intersect(spark, sf):
    kept = tags.labels_intersect(F.col("labels"), ["103", "302", "201"])
    return s.user_labels(spark, sf).select("id", kept.alias("labels"))


# Joins, aggregates, jobs


@query
def base_labels(spark, sf):
    return s.labelled(spark, sf).labels


@query
def base_labels_repeated(spark, sf):
    """Visits hold a user many times, so every match multiplies the user's rows."""
    plan = labels_plan.base_labels(
        s.reader(spark, sf), s.rules_catalog(spark), s.PERIOD,
        main="user_profile", enabled=["user_visit", "user_spend"] + ["user_profile"], id_column="user_id",
    )
    return plan.labels


def _order_catalog(spark):
    return s.rules_catalog(spark, s.ORDER_RULES)


@query
def base_labels_units(spark, sf):
    """One source has rules in two partition fields: both of its work units are labelled and joined."""
    plan = labels_plan.base_labels(
        s.reader(spark, sf), _order_catalog(spark), ORDER_PERIOD,
        main="order_profile", enabled=["order_profile", "order_spend"], id_column="user_id", unique=["order_spend"],
    )
    return plan.labels


@query
def base_labels_months(spark, sf):
    """All sources span many months."""
    plan = labels_plan.base_labels(
        s.reader(spark, sf), _order_catalog(spark), ORDER_PERIOD,
        main="order_profile", enabled=["order_profile", "order_visit"], id_column="user_id",
    )
    return plan.labels


@query
def station_report_months(spark, sf):
    return station_report.station_report(s.order_station(spark, sf), s.labels_monthly(spark, sf), ORDER_PERIOD, s.ORDER_LABELS)


@query
def resident_attributes_months(spark, sf):
    return resident.resident_attributes(
        s.reader(spark, sf), _order_catalog(spark), "order_visit", ORDER_PERIOD, id_column="user_id", place_column="lac_ci"
    )


@query
def labels_append_months(spark, sf):
    return doc_update.document_update(
        s.documents(spark, sf), s.reader(spark, sf), _order_catalog(spark), "order_visit", ORDER_PERIOD, "add",
        id_column="user_id",
    )


def _saved(df, database, name):
    df.hint("rebalance", "month_id").write.partitionBy("month_id").format("orc").saveAsTable(f"{database}.{name}")
    return f"{database}.{name}"


@query
def station_report_saved(spark, sf):
    """The whole job on saved tables: the period of the report is saved and logged."""
    db = shared_database(spark)
    return jobs.run_station_report(
        spark, _saved(s.order_station(spark, sf), db, "stations"), _saved(s.labels_monthly(spark, sf), db, "labels"),
        f"{db}.report", runlog.RunLog(spark, f"{db}.runs"), label_ids=s.ORDER_LABELS, today=TODAY,
    )


@query
def resident_attributes_saved(spark, sf):
    db = shared_database(spark)
    _order_catalog(spark).write.saveAsTable(f"{db}.catalog")
    return jobs.run_resident_attributes(
        spark, f"{db}.catalog", "order_visit", f"{db}.attributes", runlog.RunLog(spark, f"{db}.runs"),
        id_column="user_id", place_column="lac_ci", read=s.reader(spark, sf), today=TODAY,
    )


@query
def user_markets_documents(spark, sf):
    """Campaigns go into documents that had no such field."""
    actions = user_markets.action_filter(s.campaign_actions(spark, sf), since=CAMPAIGN_SINCE)
    users = tables.period_scan(s.labels_monthly(spark, sf), "month_id", ORDER_PERIOD)
    markets = user_markets.user_markets(users, s.campaign_batch(spark, sf), actions)
    return documents.doc_upsert(s.documents(spark, sf), markets)


@query
def station_join(spark, sf):
    return station_report.station_join(s.station_live(spark, sf), s.user_labels(spark, sf), s.PERIOD)


@query
def station_label_counts(spark, sf):
    return station_report.station_label_counts(
        s.station_live(spark, sf), s.user_labels(spark, sf), s.PERIOD, s.STATION_LABELS
    )


@query
def station_label_json(spark, sf):
    return station_report.station_report(
        s.station_live(spark, sf), s.user_labels(spark, sf), s.PERIOD, s.STATION_LABELS
    )


def _station_audiences(spark, sf):
    here = station_report.station_join(s.station_live(spark, sf), s.user_labels(spark, sf), s.PERIOD)
    members = here.select("lac_ci", "user_id", F.explode(tags.tokens(F.col("labels"))).alias("label")).where(F.col("label") != "")
    numbers = audiences.user_numbers(s.user_profile(spark, sf), "user_id")
    return audiences.audience_bitmaps(members, numbers, ["lac_ci", "label"], "user_id")


@query
def station_label_users(spark, sf):
    """Distinct users for each station and label, from bitmaps."""
    return audiences.audience_sizes(_station_audiences(spark, sf), ["lac_ci", "label"])


@query
def station_label_overlap(spark, sf):
    """Distinct users with both of two labels at each station, from the bitmaps alone."""
    return audiences.audience_overlaps(_station_audiences(spark, sf), ["lac_ci"], "label", s.STATION_LABELS)


@query
def action_filter(spark, sf):
    return user_markets.action_filter(s.campaign_actions(spark, sf), since=CAMPAIGN_SINCE)


@query
def batch_actions(spark, sf):
    actions = user_markets.action_filter(s.campaign_actions(spark, sf), since=CAMPAIGN_SINCE)
    return user_markets.batch_actions(s.campaign_batch(spark, sf), actions)


@query
def invert_membership(spark, sf):
    return aggregates.invert_membership(s.campaign_batch(spark, sf), "userids", "atid")


@query
def user_markets_(spark, sf):
    actions = user_markets.action_filter(s.campaign_actions(spark, sf), since=CAMPAIGN_SINCE)
    # The labels are read as base labels saves them.
    saved = f"{shared_database(spark)}.labels"
    labels = period.save_period(s.labelled(spark, sf).labels, saved, s.PERIOD)
    users = tables.period_scan(labels, "month_id", s.PERIOD)
    return user_markets.user_markets(users, s.campaign_batch(spark, sf), actions)


@query
def resident_attributes(spark, sf):
    return resident.resident_attributes(
        s.reader(spark, sf), s.rules_catalog(spark), "user_visit", s.PERIOD, id_column="user_id", place_column="lac_ci"
    )


# Documents


@query
def docs_with_any_label(spark, sf):
    return documents.docs_with_any_label(s.documents(spark, sf), ["201", "203"])


@query
def docs_with_label(spark, sf):
    return documents.docs_with_label(s.documents(spark, sf), "203")


def _order_documents(orders):
    return orders.select(
        F.col("o_custkey").cast("string").alias("id"), F.col("o_orderpriority").alias("labels"), F.col("o_orderstatus").alias("state"), *_BY_ORDER
    )


_BY_ORDER = ["o_orderdate", "o_orderkey"]


@query
def doc_upsert(spark, sf):
    """Of all orders the last of each customer becomes the document; it has a field more than before."""
    new = _order_documents(s.table(spark, sf, "orders"))
    return documents.doc_upsert(s.documents(spark, sf), new, F.struct(*_BY_ORDER), _BY_ORDER)


@query
def doc_upsert_month(spark, sf):
    """The same with the orders of one month."""
    new = _order_documents(tables.period_scan(s.orders_monthly(spark, sf), "month_id", ORDER_PERIOD))
    return documents.doc_upsert(s.documents(spark, sf), new, F.struct(*_BY_ORDER), _BY_ORDER)


BUCKETS = 16


@query
def doc_upsert_bucketed(spark, sf):
    """All orders into a state that is saved in buckets: it is merged bucket by bucket and replaced."""
    table = f"{shared_database(spark)}.documents"
    state = buckets.save_bucketed(s.documents(spark, sf), table, BUCKETS)
    new = _order_documents(s.table(spark, sf, "orders"))
    return buckets.merge_bucketed(documents.doc_upsert(state, new, F.struct(*_BY_ORDER), _BY_ORDER), table, BUCKETS)


def _months(spark, sf):
    labels = s.priority_labels(spark, sf)
    return [tables.period_scan(labels, "month_id", p).select("id", "labels") for p in (BEFORE, ORDER_PERIOD)]


@query
def label_changes(spark, sf):
    return changes.change_set(*_months(spark, sf), unique=True)


@query
def label_changes_applied(spark, sf):
    old, new = _months(spark, sf)
    return changes.apply_changes(old, changes.change_set(old, new, unique=True))


def _synced(spark, sf):
    """The labels of a month as documents in buckets, indexed by label and brought up to the next month."""
    db = shared_database(spark)
    labels = s.priority_labels(spark, sf).where(F.col("month_id").isin(BEFORE, ORDER_PERIOD))
    labels.write.partitionBy("month_id").format("orc").saveAsTable(f"{db}.labels")
    saved = tables.table_scan(spark, f"{db}.labels")
    state = tables.period_scan(saved, "month_id", BEFORE).select("id", "labels")
    state = buckets.save_bucketed(state, f"{db}.documents", BUCKETS)
    postings.build_postings(state, f"{db}.postings", int(BEFORE))
    return db, jobs.run_document_sync(
        state, saved, BEFORE, buckets.bucketed_store(f"{db}.documents", BUCKETS), runlog.RunLog(spark, f"{db}.runs"),
        ORDER_PERIOD, postings=f"{db}.postings",
    )


@query
def document_sync(spark, sf):
    return _synced(spark, sf)[1]


@query
def docs_with_label_indexed(spark, sf):
    """A search through the index after an update, in the documents after the update."""
    db, docs = _synced(spark, sf)
    return postings.search_documents(docs, f"{db}.postings", ["1-URGENT"])


@query
def docs_with_all_labels_indexed(spark, sf):
    db, _ = _synced(spark, sf)
    return postings.ids_with_all_labels(spark, f"{db}.postings", ["1-URGENT", "2-HIGH"])


@query
def label_postings(spark, sf):
    """The folded index of all labels of all documents."""
    db = shared_database(spark)
    postings.build_postings(s.documents(spark, sf), f"{db}.postings")
    removed = documents.labels_remove(s.documents(spark, sf), "203")
    gone = changes.change_set(s.documents(spark, sf), removed, unique=True)
    postings.update_postings(f"{db}.postings", postings.posting_changes(s.documents(spark, sf), gone), 1)
    postings.compact(spark, f"{db}.postings", f"{db}.folded")
    return postings.labelled_ids(spark, f"{db}.postings", ["201", "202", "203"])


@query
def doc_projection(spark, sf):
    return documents.doc_projection(
        s.station_heat(spark, sf), "lac_ci", "longitude#latitude#per_num", "month_id", s.PERIOD
    )


@query
def doc_projection_id_only(spark, sf):
    return documents.doc_projection(s.station_heat(spark, sf), "lac_ci", "", "month_id", s.PERIOD)


@query
def labels_append_one(spark, sf):
    poor = documents.docs_with_label(s.profile_tags(spark, sf), "103")
    return documents.labels_append_one(s.documents(spark, sf), poor, "103")


@query
def labels_append(spark, sf):
    return doc_update.document_update(
        s.documents(spark, sf), s.reader(spark, sf), s.rules_catalog(spark), "user_profile", s.PERIOD, "add",
        id_column="user_id",
    )


@query
def labels_add(spark, sf):
    delta = s.profile_tags(spark, sf).unionByName(s.activity_tags(spark, sf))
    return documents.labels_add(s.documents(spark, sf), delta)


@query
def labels_remove(spark, sf):
    return doc_update.document_update(
        s.documents(spark, sf), s.reader(spark, sf), s.rules_catalog(spark), "user_profile", s.PERIOD, "Delete",
        id_column="user_id", label_id="203",
    )


@query
def labels_remove_tail(spark, sf):
    marked = s.profile_tags(spark, sf).unionByName(s.activity_tags(spark, sf))
    removals = aggregates.explode_labels(marked).where(F.col("label").isin("103", "202", "203"))
    return documents.labels_remove_tail(s.documents(spark, sf), removals)


@query
def labels_remove_many(spark, sf):
    return documents.labels_remove_many(s.documents(spark, sf), ["201", "203"])


@query
def labels_compact(spark, sf):
    return documents.labels_compact(s.gappy_labels(spark, sf))


# Saves and exports


def _label_history(spark, sf):
    """A saved label table with all order months."""
    name = f"{shared_database(spark)}.label_history"
    history = s.order_labels(spark, sf, "o_orderpriority").hint("rebalance", "month_id")
    history.write.format("orc").partitionBy("month_id").saveAsTable(name)
    return name


#: What a query needs to have written first, for timing the rest alone: (spark, sf) -> (() -> DataFrame).
PREPARED: dict[str, Callable[[SparkSession, str], Callable[[], DataFrame]]] = {}


def _prepared_save_period(spark, sf):
    history = _label_history(spark, sf)
    new = tables.period_scan(s.order_labels(spark, sf, "o_orderstatus"), "month_id", ORDER_PERIOD)
    return lambda: period.save_period(new, history, ORDER_PERIOD)


PREPARED["save_period"] = _prepared_save_period


@query
def save_period(spark, sf):
    return _prepared_save_period(spark, sf)()


@query
def save_default_period(spark, sf):
    new = tables.period_scan(s.order_labels(spark, sf, "o_orderstatus"), "month_id", ORDER_PERIOD)
    return period.save_default_period(new, _label_history(spark, sf), TODAY)


@query
def publish_period(spark, sf):
    """A period staged, checked and put in the place of the old one."""
    new = tables.period_scan(s.order_labels(spark, sf, "o_orderstatus"), "month_id", ORDER_PERIOD)
    return staged.publish_period(new, _label_history(spark, sf), ORDER_PERIOD)


@query
def rolling_append(spark, sf):
    return relational.rolling_append(s.order_labels(spark, sf, "o_orderstatus"), _label_history(spark, sf), ORDER_PERIOD)


def _entries(spark, sf, kind, **options):
    orders = s.table(spark, sf, "orders")
    return keyvalue.key_value_entries(orders, kind, **options)


@query
def kv_string(spark, sf):
    return _entries(spark, sf, "string", key="o_custkey", value="o_orderstatus#o_orderpriority", order=["o_orderdate", "o_orderkey"])


@query
def kv_hash(spark, sf):
    return _entries(
        spark, sf, "Hash", key="user_orders", value="o_custkey", order=["o_orderdate", "o_orderkey"],
        hash_field="o_custkey#o_orderpriority", hash_value="o_orderkey#o_orderstatus",
    )


@query
def kv_set(spark, sf):
    return _entries(spark, sf, "SET", key="user_set", value="o_custkey#o_orderpriority", order=[])


@query
def kv_list(spark, sf):
    return _entries(spark, sf, "list", key="user_list", value="o_orderstatus#o_orderpriority", order=["o_orderdate"])


@query
def kv_zset(spark, sf):
    return _entries(spark, sf, "sorted set", key="user_zset", value="o_custkey#o_orderpriority", order=["o_orderdate"])


def _merged(spark, sf, kind, **options):
    """The entries of a month in a store that holds those of the month before."""
    monthly = s.orders_monthly(spark, sf)
    state, new = (keyvalue.key_value_entries(tables.period_scan(monthly, "month_id", p), kind, **options) for p in (BEFORE, ORDER_PERIOD))
    return keyvalue.merge_entries(buckets.table_store(f"{shared_database(spark)}.entries")(state), new, kind)


@query
def kv_merge_string(spark, sf):
    return _merged(spark, sf, "string", key="o_custkey", value="o_orderstatus#o_orderpriority", order=["o_orderdate", "o_orderkey"])


@query
def kv_merge_hash(spark, sf):
    return _merged(
        spark, sf, "hash", key="user_orders", value="o_custkey", order=["o_orderdate", "o_orderkey"],
        hash_field="o_custkey", hash_value="o_orderkey#o_orderstatus",
    )


@query
def kv_merge_set(spark, sf):
    return _merged(spark, sf, "set", key="user_set", value="o_custkey#o_orderpriority", order=[])


@query
def kv_merge_list(spark, sf):
    return _merged(spark, sf, "list", key="user_list", value="o_orderstatus#o_orderpriority", order=["o_orderdate"])


@query
def kv_merge_zset(spark, sf):
    return _merged(spark, sf, "sorted set", key="user_zset", value="o_custkey", order=["o_orderdate"])


@query
def run_log_latest(spark, sf):
    return runlog.run_log_latest(s.run_events(spark, sf))


@query
def run_log_compacted(spark, sf):
    """The latest state from the events that compaction keeps."""
    return runlog.run_log_latest(runlog.compacted_events(s.run_events(spark, sf)))


# Text functions


def _gappy(spark, sf, **columns):
    return s.gappy_labels(spark, sf).select("id", *[c.alias(n) for n, c in columns.items()])


@query
def csv_split(spark, sf):
    items = text.csv_split(F.col("labels"))
    return _gappy(spark, sf, n=F.size(items), items=F.array_join(items, "|"))


@query
def csv_join(spark, sf):
    return s.user_profile(spark, sf).select("user_id", text.csv_join(F.array("segment", "nation")).alias("joined"))


@query
def csv_clean_split(spark, sf):
    quoted = F.concat(F.lit('"'), F.col("segment"), F.lit('", "'), F.col("nation"), F.lit(' ",,'))
    items = text.csv_clean_split(quoted)
    return s.user_profile(spark, sf).select("user_id", F.size(items).alias("n"), F.array_join(items, "|").alias("items"))


@query
def csv_prefix(spark, sf):
    return _gappy(spark, sf, prefixed=text.csv_prefix(F.col("labels")))


@query
def csv_quote(spark, sf):
    return _gappy(spark, sf, quoted=text.csv_quote(F.col("labels")))


@query
def csv_alias_list(spark, sf):
    return _gappy(spark, sf, aliased=text.csv_alias_list(F.col("labels")))


@query
def str_map(spark, sf):
    # A repeated key, and up to two separators at the end.
    pairs = F.concat(
        F.lit("status:"), F.col("o_orderstatus"), F.lit(",priority:"), F.col("o_orderpriority"),
        F.lit(",status:"), F.substring("o_orderpriority", 1, 1), F.repeat(F.lit(","), (F.col("o_orderkey") % 3).cast("int")),
    )
    parsed = s.table(spark, sf, "orders").select("o_orderkey", text.str_map(pairs).alias("m"))
    return parsed.select(
        "o_orderkey",
        F.size("m").alias("n"),
        F.try_element_at("m", F.lit("status")).alias("status"),
        F.try_element_at("m", F.lit("priority")).alias("priority"),
    )


@query
def template_fill(spark, sf):
    template = F.concat(F.lit("{user} {dt}: "), F.col("event_type"), F.lit(" of {user}"))
    filled = text.template_fill(template, {"user": F.col("user_id").cast("string"), "dt": "202402"})
    return s.table(spark, sf, "events").select("event_id", filled.alias("filled"))


@query
def json_field(spark, sf):
    return s.table(spark, sf, "events").select("event_id", text.json_field(F.col("props"), "k").alias("k"))


# Date functions


def _order_dates(spark, sf, **columns):
    return s.table(spark, sf, "orders").select("o_orderkey", *[c.alias(n) for n, c in columns.items()])


def _day():
    return F.col("o_orderdate")


@query
def fmt_datetime(spark, sf):
    ts = F.col("ts")
    return s.table(spark, sf, "events").select(
        "event_id", dates.fmt_datetime_19(ts).alias("long_form"), dates.fmt_datetime_14(ts).alias("short_form")
    )


@query
def month_of(spark, sf):
    return _order_dates(spark, sf, month=dates.month_of(_day()))


@query
def year_ago_month(spark, sf):
    return _order_dates(spark, sf, month=dates.year_ago_month(_day()))


@query
def last_month_day(spark, sf):
    return _order_dates(spark, sf, day=dates.last_month_day(_day()))


@query
def last_month_id(spark, sf):
    return _order_dates(spark, sf, month=dates.last_month_id(_day()))


@query
def next_month(spark, sf):
    return _order_dates(spark, sf, month=dates.next_month(dates.month_of(_day())))


@query
def months_before(spark, sf):
    return _order_dates(
        spark, sf,
        year_before=dates.months_before(dates.month_of(_day()), 12),
        by_line=dates.months_before(dates.month_of(_day()), F.substring("o_orderpriority", 1, 1).cast("int")),
    )


@query
def n_months_ago_day(spark, sf):
    return _order_dates(spark, sf, day=dates.n_months_ago_day(_day(), 6), short=dates.n_months_ago_day(_day(), 1))


@query
def comparison_dates(spark, sf):
    return _order_dates(spark, sf, **dates.comparison_dates(_day()))
