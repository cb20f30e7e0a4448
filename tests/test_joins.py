import pytest
from pyspark.sql import functions as F

from tagloom.operators.aggregates import label_counts, label_counts_by_join
from tagloom.operators.joins import (
    Salt,
    count_repeats,
    hot_keys,
    join_tags,
    repeat_rows,
)
from tagloom.operators import joins

LABELS = "id string, labels string"


@pytest.fixture(scope="module")
def hot_main(spark):
    """A third of the rows share one id, some have none, the others are spread."""
    rows = spark.range(0, 3000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.col("id").cast("string")).alias("id"),
        F.concat(F.lit("m"), (F.col("id") % 2).cast("string")).alias("labels"),
    )
    return rows


@pytest.fixture(scope="module")
def others(spark):
    first = [("hot", "a")] * 3 + [("hot", "b")] + [("4", "c")] * 2 + [("5", "")] * 2 + [(None, "z")] * 5
    second = [("hot", "s"), ("4", "t"), ("7", "u"), ("nobody", "v")]
    return {"first": spark.createDataFrame(first, LABELS), "second": spark.createDataFrame(second, LABELS)}


def plain_chain(main, others):
    out, parts = main, [F.nullif("labels", F.lit(""))]
    for name, df in others.items():
        out = out.join(df.select("id", F.col("labels").alias(name)), "id", "left")
        parts.append(F.nullif(name, F.lit("")))
    return out.select("id", F.concat_ws(",", *parts).alias("labels"))


@pytest.mark.parametrize("salted", [True, False])
def test_join_tags_equals_plain_left_joins(spark, rows, hot_main, others, salted):
    salt = Salt.of(hot_main, "id") if salted else None
    assert rows(join_tags(hot_main, others, salt)) == rows(plain_chain(hot_main, others))


def test_join_tags_with_unique_sources(rows, hot_main, others):
    unique = {"second": others["second"]}
    got = join_tags(hot_main, unique, Salt.of(hot_main, "id"), unique=["second"])
    assert rows(got) == rows(plain_chain(hot_main, unique))


def test_join_tags_without_others(rows, hot_main):
    assert rows(join_tags(hot_main, {})) == rows(hot_main)


def test_hot_keys_are_found_and_bounded(hot_main):
    assert hot_keys(hot_main, "id", 0.01) == {"hot": pytest.approx(1 / 3, abs=0.02)}
    assert hot_keys(hot_main.where("id = 'none'"), "id", 0.01) == {}


def test_salt_spreads_hot_and_null_ids_only(hot_main):
    salted = Salt.of(hot_main, "id").left(hot_main, "id")
    salts = {r["id"]: r["n"] for r in salted.groupBy("id").agg(F.countDistinct("_salt").alias("n")).collect()}
    assert salts.pop("hot") > 4 and salts.pop(None) > 4
    assert set(salts.values()) == {1}


def test_salts_follow_the_share_and_the_partitions(spark):
    rows = spark.range(0, 100_000, 1, 16).select(F.when(F.col("id") % 1000 < 3, "warm").otherwise(F.col("id").cast("string")).alias("id"))
    assert Salt.of(rows, "id", 8).salts == {}  # 0.3 % is little of an eighth
    assert Salt.of(rows, "id", 400).salts == {"warm": 5}  # and more than a 400th
    spread = Salt.of(rows, "id", 400).left(rows, "id").where("id = 'warm'")
    assert spread.select("_salt").distinct().count() == 5


@pytest.mark.parametrize("partitions", [2000, 4000, 20_000])
def test_any_number_of_partitions(spark, partitions):
    """An id with 0.3 % of the rows is spread by its share however many partitions there are."""
    rows = spark.range(0, 2_000_000, 1, 8).select(F.when(F.col("id") % 1000 < 3, -1).otherwise(F.col("id")).alias("id"))
    salts = Salt.of(rows, "id", partitions).salts
    assert set(salts) == {-1} and salts[-1] == pytest.approx(0.003 * partitions / joins.PART, abs=1)


def test_sampled_hot_keys_are_counted_exactly(spark):
    rows = spark.range(0, 1_000_000, 1, 8).select(F.when(F.col("id") % 10 == 0, "a").when(F.col("id") % 100 == 1, "b").otherwise(F.col("id").cast("string")).alias("id"))
    assert hot_keys(rows, "id", 0.009) == {"a": 0.1, "b": 0.01}
    assert hot_keys(rows, "id", 0.05) == {"a": 0.1}


def test_salted_join_without_exchange_reuse(spark, rows, hot_main, others):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        assert rows(join_tags(hot_main, others, Salt.of(hot_main, "id"))) == rows(plain_chain(hot_main, others))
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_user_markets_reads_the_saved_labels_only(spark, sf, plan):
    from workload.queries import QUERIES

    text = plan(QUERIES["user_markets"](spark, sf))
    assert text.count("Scan orc") <= 2 and "customer.parquet" not in text and "events.parquet" not in text


def test_each_input_is_shuffled_to_the_join_once(spark, plan, hot_main, others):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(join_tags(hot_main, others, Salt.of(hot_main, "id"), unique=list(others)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") == 2
    assert text.count("Exchange hashpartitioning") == 3  # main and two others, never the running result


def test_repeat_rows_over_many_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(joins, "MAX_COPIES_PER_ARRAY", 3)
    df = spark.createDataFrame([("a", 7), ("b", 1), ("c", 3)], "id string, n bigint")
    got = rows(repeat_rows(df, F.col("n"), [F.col("id")], position="p"))
    assert got == sorted([("a", i) for i in range(7)] + [("b", 0)] + [("c", i) for i in range(3)])


def test_count_repeats_combines_before_the_shuffle(plan, others):
    text = plan(count_repeats(others["first"]))
    assert text.index("HashAggregate") < text.index("Exchange") < text.rindex("HashAggregate")


def test_reduced_station_counts_equal_counts_of_the_join(spark, rows):
    places = spark.range(0, 400, 1, 4).select(
        (F.col("id") % 3).cast("string").alias("lac_ci"),
        F.when(F.col("id") % 2 == 0, "D").otherwise("N").alias("dn_flag"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 20).cast("string")).alias("user_id"),
    )
    tags = spark.createDataFrame(
        [("hot", "1,2"), ("hot", "2"), ("hot", ""), ("4", "12,1"), ("5", "21"), (None, "1"), ("77", "1")], LABELS
    )
    keys = ["lac_ci", "dn_flag"]
    joined = places.join(tags, places["user_id"] == tags["id"])
    got = label_counts_by_join(places, tags, ["1", "2", "3"], keys, "user_id")
    assert rows(got) == rows(label_counts(joined, ["1", "2", "3"], keys))
