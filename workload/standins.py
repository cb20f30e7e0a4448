"""Inputs of the jobs, derived from the given tables. FIXTURES.md describes them."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators.rules import Rule, label_columns
from tagloom.operators.tags import label_matrix, tag_source
from tagloom.plans.base_labels import BaseLabels, base_labels
from tagloom.sources.catalog import CATALOG_SCHEMA

PERIOD = "202401"
MAIN = "user_profile"
ENABLED = ["user_profile", "user_activity", "user_spend"]
STATION_LABELS = ["101", "102", "103", "201", "202", "203", "302"]

# The rules of the label jobs; 901 to 904 test the screening of work units.
RULES = [
    ("101", '{"segment":{"value":"BUILDING","type":"single"}}', "user_profile", "segment", "month_id"),
    ("102", '{"segment":{"value":"MACHINERY,FURNITURE","type":"list"}}', "user_profile", "segment", "month_id"),
    ("103", '{"acctbal":{"value":"[0,1000)","type":"range"}}', "user_profile", "balance", "month_id"),
    ("104", '{"acctbal":{"value":"(5000,10000]","type":"RANGE"},"segment":{"value":"AUTOMOBILE","type":"Single"}}',
     "user_profile", "balance", "month_id"),
    ("105", '{"nation":{"value":"1,2,3","type":"list"},"acctbal":{"value":"[0,9000]","type":"range"}}',
     "user_profile", "region", "month_id"),
    ("201", '{"n_events":{"value":"(60,70)","type":"range"}}', "user_activity", "activity", "month_id"),
    ("202", '{"n_purchase":{"value":"[10,20]","type":"range"}}', "user_activity", "activity", "month_id"),
    ("203", '{"max_value":{"value":"[200,1000)","type":"range"}}', "user_activity", "value", "month_id"),
    ("301", '{"n_orders":{"value":"[1,5]","type":"range"}}', "user_spend", "orders", "month_id"),
    ("302", '{"top_priority":{"value":"5-LOW","type":"single"}}', "user_spend", "priority", "month_id"),
    ("302", '{"max_price":{"value":"(450000,1000000]","type":"range"}}', "user_spend", "price", "month_id"),
    ("401", '{"event_type":{"value":"purchase,click","type":"list"}}', "user_visit", "visit", "month_id"),
    ("402", '{"value":{"value":"[100,1000]","type":"range"}}', "user_visit", "visit", "month_id"),
    ("901", "", "disabled_src", "none", "month_id"),
    ("902", '{"x":{"value":"1","type":"single"}}', "  ", "none", "month_id"),
    ("903", '{"x":{"value":"1","type":"single"}}', None, "none", "month_id"),
]

# Rules over the sources that span many months; one source has rules in two partition fields.
ORDER_PERIOD = "199806"
ORDER_LABELS = ["101", "102", "103"]
ORDER_RULES = [
    ("101", '{"segment":{"value":"BUILDING","type":"single"}}', "order_profile", "segment", "month_id"),
    ("102", '{"segment":{"value":"MACHINERY,FURNITURE","type":"list"}}', "order_profile", "segment", "month_id"),
    ("103", '{"acctbal":{"value":"[0,1000)","type":"range"}}', "order_profile", "balance", "month_id"),
    ("311", '{"n_orders":{"value":"[1,1]","type":"range"}}', "order_spend", "orders", "month_id"),
    ("312", '{"max_price":{"value":"(200000,1000000]","type":"range"}}', "order_spend", "price", "month_id"),
    ("321", '{"top_priority":{"value":"1-URGENT,2-HIGH,3-MEDIUM","type":"list"}}', "order_spend", "before", "dt"),
    ("411", '{"event_type":{"value":"F,P","type":"list"}}', "order_visit", "visit", "month_id"),
    ("412", '{"value":{"value":"[100000,300000]","type":"range"}}', "order_visit", "visit", "month_id"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rules_catalog(spark: SparkSession, rules=RULES) -> DataFrame:
    columns = dict(zip(CATALOG_SCHEMA.names, map(list, zip(*rules, strict=True)), strict=True))
    return spark.createDataFrame(pa.table(columns))  # a local relation: reading it takes no job


def event_key(props: str = "props"):
    """The number in ``{"k": n}``, as text."""
    return F.regexp_extract(props, "([0-9]+)", 1)


def user_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_nationkey").cast("string").alias("nation"),
        F.lit(PERIOD).alias("month_id"),
    )


def user_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Grouped by plain numbers and dates; texts are made of the few groups, not of all rows.
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.trunc("ts", "month").alias("month"))
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.count(F.when(F.col("event_type") == "purchase", 1)).alias("n_purchase"),
            F.max("value").alias("max_value"),
        )
        .select(
            F.col("user_id").cast("string").alias("user_id"),
            "n_events",
            "n_purchase",
            "max_value",
            F.date_format("month", "yyyyMM").alias("month_id"),
        )
    )


def user_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.max("o_totalprice").alias("max_price"),
            F.max("o_orderpriority").alias("top_priority"),
        )
        .select(
            F.col("o_custkey").cast("string").alias("user_id"),
            "n_orders",
            "max_price",
            "top_priority",
            F.lit(PERIOD).alias("month_id"),
        )
    )


def user_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("user_id"),
        event_key().alias("lac_ci"),
        "event_type",
        "value",
        F.date_format("ts", "yyyyMM").alias("month_id"),
    )


def _month(date: str):
    return F.date_format(date, "yyyyMM").alias("month_id")


def order_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of each customer in each month with an order of theirs."""
    months = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), _month("o_orderdate")).distinct()
    return months.join(table(spark, sf_dir, "customer"), "c_custkey").select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("acctbal"),
        "month_id",
    )


def order_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What customers spent by order month; ``dt`` is the month after."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("month"))
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.max("o_totalprice").alias("max_price"),
            F.min("o_orderpriority").alias("top_priority"),
        )
        .select(
            F.col("o_custkey").cast("string").alias("user_id"),
            "n_orders",
            "max_price",
            "top_priority",
            _month("month"),
            F.date_format(F.add_months("month", 1), "yyyyMM").alias("dt"),
        )
    )


def order_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a visit to one of 50 places."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("user_id"),
        (F.col("o_orderkey") % 50).cast("string").alias("lac_ci"),
        F.col("o_orderstatus").alias("event_type"),
        F.col("o_totalprice").alias("value"),
        _month("o_orderdate"),
    )


def order_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who ordered at a place, by month; urgent and high orders are day, the others night."""
    flag = F.when(F.col("o_orderpriority") < "3", "D").otherwise("N").alias("dn_flag")
    visits = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 50).alias("place"), "o_custkey", flag, _month("o_orderdate"))
    return visits.distinct().select(
        F.col("place").cast("string").alias("lac_ci"), F.col("o_custkey").cast("string").alias("user_id"), "dn_flag", "month_id"
    )


def labels_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile labels of all months, as a saved label table holds them."""
    rules = [Rule(*r) for r in ORDER_RULES if r[2] == "order_profile"]
    labels = F.concat_ws(",", *label_columns(sorted(r.id for r in rules), rules)).alias("labels")
    return order_profile(spark, sf_dir).select(F.col("user_id").alias("id"), labels, "month_id")


SOURCES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "order_profile": order_profile,
    "order_spend": order_spend,
    "order_visit": order_visit,
    "user_profile": user_profile,
    "user_activity": user_activity,
    "user_spend": user_spend,
    "user_visit": user_visit,
}


def reader(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    """Source name to table; an unknown name fails like a missing catalog table."""
    return lambda name: SOURCES[name](spark, sf_dir) if name in SOURCES else spark.read.table(name)


def labelled(spark: SparkSession, sf_dir: str, salted: bool = True) -> BaseLabels:
    return base_labels(
        reader(spark, sf_dir),
        rules_catalog(spark),
        PERIOD,
        main=MAIN,
        enabled=ENABLED,
        id_column="user_id",
        unique=("user_activity", "user_spend"),  # both are grouped by user
        salted=salted,
    )


def user_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).labels.withColumn("month_id", F.lit(PERIOD))


def station_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.hour("ts")
    return (
        table(spark, sf_dir, "events")
        .select(
            event_key().alias("lac_ci"),
            "user_id",
            F.when(hour.between(8, 19), "D").otherwise("N").alias("dn_flag"),
            F.trunc("ts", "month").alias("month"),
        )
        .distinct()
        .select(
            "lac_ci",
            F.col("user_id").cast("string").alias("user_id"),
            "dn_flag",
            F.date_format("month", "yyyyMM").alias("month_id"),
        )
    )


def station_heat(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = station_live(spark, sf_dir).select("lac_ci", "month_id", "user_id").distinct()
    lac = F.col("lac_ci").cast("double")
    return (
        users.groupBy("lac_ci", "month_id")
        .agg(F.count(F.lit(1)).alias("per_num"))
        .select("lac_ci", (lac / 10).alias("longitude"), (lac / 4).alias("latitude"), "per_num", "month_id")
    )


def _campaign(day: str):
    return F.concat(F.lit("A"), F.date_format(day, "yyyyMMdd")).alias("atid")


def campaign_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One campaign per order day; its sends reached the users where an urgent or high order is final."""
    reached = (F.col("o_orderstatus") == "F") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return (
        table(spark, sf_dir, "orders")
        .select(
            F.when(reached, "NOTERESSUC").otherwise("FAILED").alias("bstatus"),
            F.col("o_orderdate").cast("date").alias("send_time"),
        )
        .distinct()
        .select(_campaign("send_time"), "bstatus", "send_time")
    )


def campaign_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users of a campaign in batches of at most 5000 neighbouring orders."""
    users = F.transform("users", lambda user: user.cast("string"))
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("day"), F.floor(F.col("o_orderkey") / 5000).alias("batch_id"))
        .agg(F.collect_list("o_custkey").alias("users"))
        .select(_campaign("day"), "batch_id", F.array_join(F.sort_array(users), ",").alias("userids"))
    )


def orders_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("month_id", F.date_format("o_orderdate", "yyyyMM"))


def order_labels(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """A label history with one period per order month."""
    return orders_monthly(spark, sf_dir).select(
        F.col("o_custkey").cast("string").alias("id"), F.col(label).alias("labels"), "month_id"
    )


def priority_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer and month the priorities of their orders as labels; one row each, and they change by month."""
    return (
        table(spark, sf_dir, "orders")
        .select(F.col("o_custkey").cast("string").alias("id"), "o_orderpriority", _month("o_orderdate"))
        .distinct()
        .groupBy("id", "month_id")
        .agg(F.array_join(F.sort_array(F.collect_list("o_orderpriority")), ",").alias("labels"))
        .select("id", "labels", "month_id")
    )


def readable_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules of `part_catalog` that have a body."""
    return part_catalog(spark, sf_dir).where(F.length("value") > 0)


def narrow_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule per part: its kind, and an interval of up to a unit to either side of its price. Nearly all differ."""
    price, wide = F.col("p_retailprice").cast("decimal(12,2)"), (F.col("p_partkey") % 10 + 1).cast("decimal(12,2)") / 10
    low, high = ((price + sign * wide).cast("decimal(12,2)").cast("string") for sign in (-1, 1))
    body = F.concat(
        F.lit('{"price":{"value":"('), low, F.lit(","), high, F.lit(']","type":"range"},"kind":{"value":"'),
        F.col("p_type"), F.lit(',OTHER,","type":"list"}}'),
    )
    return table(spark, sf_dir, "part").select(F.concat(F.lit("p"), (F.col("p_partkey") % 997).cast("string")).alias("id"), body.alias("value"))


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of a user and event type in a part of a month: open ones, restarts, and ends without a start."""
    value = F.col("value")
    part = F.floor(F.dayofmonth("ts") / 8).cast("string")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("job_id"),
        F.col("event_type").alias("job_name"),
        F.concat(F.lit("run "), F.col("event_id").cast("string")).alias("job_desc"),
        F.concat(F.date_format("ts", "yyyyMM"), F.lit("w"), part).alias("job_period"),
        F.concat(F.lit("p"), (F.col("event_id") % 3).cast("string")).alias("project"),
        F.col("ts").alias("event_time"),
        "event_id",
        F.when(value < 1, "2").when(value < 40, "1").otherwise("0").alias("status"),
        F.concat(F.lit("it's "), F.col("event_type")).alias("result"),
    )


def part_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large rule catalog: one rule per part, keyed by size, its source named after the brand."""
    low = (F.floor(F.col("p_retailprice") / 100) * 100).cast("string")
    high = (F.floor(F.col("p_retailprice") / 100) * 100 + 100).cast("string")
    body = F.concat(
        F.lit('{"price":{"value":"['), low, F.lit(","), high,
        F.lit(')","type":"range"},"kind":{"value":"'), F.col("p_type"), F.lit('","type":"Single"}}'),
    )
    brand = F.col("p_brand")
    return table(spark, sf_dir, "part").select(
        F.col("p_size").cast("string").alias("id"),
        F.when(F.col("p_type") == "PROMO", "").otherwise(body).alias("value"),
        F.when(brand == "Brand#11", "  ").when(brand != "Brand#12", F.lower(F.replace(brand, F.lit("#"), F.lit("_"))))
        .alias("source_name"),
        F.col("p_name").alias("source_label"),
        F.when(F.col("p_type") == "ECONOMY", "dt").otherwise("month_id").alias("partition_field"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label documents of all users with events; a user without activity label has no labels field."""
    return activity_tags(spark, sf_dir).select("id", F.nullif("labels", F.lit("")).alias("labels"))


def _rules(source: str) -> tuple[list[str], list[Rule]]:
    rules = [Rule(*r) for r in RULES if r[2] == source]
    return sorted({r.id for r in rules}), rules


def _tags(snapshot: DataFrame, source: str) -> DataFrame:
    return tag_source(snapshot, *_rules(source), "user_id")


def profile_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tags(user_profile(spark, sf_dir), "user_profile")


def activity_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tags(user_activity(spark, sf_dir), "user_activity")


def gappy_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile labels with an empty item for each label that does not apply, like ``101,,103,,``."""
    ids, rules = _rules("user_profile")
    matrix = label_matrix(user_profile(spark, sf_dir), ids, rules, "user_id")
    items = [F.coalesce(F.col(f"label_{i}"), F.lit("")) for i in ids]
    return matrix.select("id", F.concat_ws(",", *items).alias("labels"))
