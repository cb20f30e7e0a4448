from pyspark.sql import functions as F

from tagloom.operators.aggregates import collect_distinct, invert_membership
from tagloom.operators.tags import labels_intersect, multi_hot_columns, multi_hot_text, spread_text

# Expected values of the membership example.
BATCHES = [("102", "33,44,55,66,77,33,77,66,88,99"), ("105", "22,44"), ("103", "11,22,33,44")]
MEMBERS = {
    "11": "103", "22": "103,105", "33": "102,103", "44": "102,103,105",
    "55": "102", "66": "102", "77": "102", "88": "102", "99": "102",
}


def test_invert_membership_example(spark):
    df = spark.createDataFrame(BATCHES, "markets string, userids string")
    got = {r.userids: r.markets for r in invert_membership(df, "userids", "markets").collect()}
    assert got == MEMBERS


def test_empty_items_null_lists_and_null_values(spark, rows):
    df = spark.createDataFrame([("1", "a,,b"), ("2", None), (None, "a"), ("3", "")], "m string, u string")
    assert rows(invert_membership(df, "u", "m")) == [("", "1,3"), ("a", "1"), ("b", "1")]


def test_separator_is_no_pattern(spark, rows):
    df = spark.createDataFrame([("1", "a|b"), ("2", "b|c")], "m string, u string")
    assert rows(invert_membership(df, "u", "m", "|")) == [("a", "1"), ("b", "1|2"), ("c", "2")]


def test_pairs_are_distinct_before_they_are_collected(spark, plan):
    df = spark.createDataFrame([("1", "a")], "k string, v string")
    text = plan(collect_distinct(df, "k", "v"))
    collect, pairs = text.index("collect_list"), text.index("Exchange hashpartitioning(k")
    assert collect < pairs and text.count("Exchange hashpartitioning(k") == 2
    assert text.count("HashAggregate(keys=[k") >= 2


def test_multi_hot_counts_tokens(spark):
    df = spark.createDataFrame([("1", "1,12"), ("2", "12"), ("3", ""), ("4", None), ("5", "2,1")], "id string, labels string")
    ids = ["1", "2", "12"]
    sums = df.agg(*[F.sum(c) for c in multi_hot_columns(F.col("labels"), ids)]).first()
    exploded = df.select(F.explode(F.split("labels", ",")).alias("t")).groupBy("t").count().collect()
    counts = {r.t: r["count"] for r in exploded}
    assert list(sums) == [counts.get(i, 0) for i in ids]
    flags = multi_hot_text(F.col("labels"), ids)
    assert [r[0] for r in df.orderBy("id").select(flags).collect()] == ["1,0,1", "0,0,1", "0,0,0", "0,0,0", "1,1,0"]
    wide = df.select("id", flags.alias("f")).orderBy("id").select(*spread_text(F.col("f"), ids)).first()
    assert wide.asDict() == {"label_1": "1", "label_2": "0", "label_12": "1"}


def test_labels_intersect_keeps_text_order(spark):
    df = spark.createDataFrame([("3,1,2",)], "labels string")
    assert df.select(labels_intersect(F.col("labels"), ["2", "3", "9"])).first()[0] == "3,2"
