"""The index against the rules written into the plan, and its shape."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators import rule_index as ri
from tagloom.operators.rules import Rule, RuleError
from tagloom.operators.tags import tag_source

CATALOG = "id string, value string"


def body(**conditions):
    return json.dumps({f: {"type": k, "value": v} for f, (k, v) in conditions.items()})


def by_plan(df, catalog):
    rules = [Rule(*r) for r in catalog]
    return tag_source(df, sorted({r.id for r in rules}), rules, "k")


@pytest.fixture(scope="module")
def values(spark):
    r = random.Random(5)
    numbers = [None, "x", "", "NaN", "Infinity", "-Infinity", "-0.0", "0", "1", "1.0", "1e1", " 3 ", "2.5", "-4", "1000000"]
    rows = [(str(i), r.choice(numbers + [str(r.randint(-6, 12))]), r.choice([None, 0.0, -0.0, float("nan"), 1.5, 3.0, 7.25, -2.0, 23.0]),
             r.choice([None, "", "a", "b", " a", "c,d", "23.0"])) for i in range(400)]
    return spark.createDataFrame(rows, "k string, n string, d double, t string").repartition(4)


def test_index_equals_the_rules_in_the_plan(spark, values, rows):
    r = random.Random(7)
    catalog = []
    for i in range(300):
        conditions = {}
        for field in r.sample(["n", "d", "t"], r.randint(1, 3)):
            kind = r.choice(["range", "Range", "single", "list"])
            if kind.lower() == "range":
                low = r.choice([-5, -2, 0, 1, 2.5, 3, 7.25, float("-inf")])
                high = low + r.choice([0, 0.5, 1, 4, 10])
                left, right = r.choice(["[]", "[)", "(]", "()"]) if low < high else "[]"
                conditions[field] = (kind, f"{left}{low},{high}{right}".replace("inf", "Infinity"))
            elif kind == "single":
                conditions[field] = (kind, r.choice(["a", "", "23.0", "1", "b"]))
            else:
                conditions[field] = (kind, r.choice(["a,b", ",", ",,", "", "a,,", ",a", " a,23.0", "1,3", "0.0,-0.0,NaN"]))
        catalog.append((str(r.randint(1, 120)), body(**conditions)))
    df = spark.createDataFrame(catalog, CATALOG).repartition(3)
    assert rows(ri.tag_by_index(values, df, "k")) == rows(by_plan(values, catalog))


def test_nested_and_touching_intervals(spark, rows):
    catalog = [(f"{a}{x}{b}{z}", body(v=("range", f"{x}{a},{b}{z}"))) for a in range(9) for b in range(a + 1, 10) for x in "[(" for z in "])"]
    df = spark.range(-4, 44).select(F.col("id").cast("string").alias("k"), (F.col("id") / 4).alias("v"))
    assert rows(ri.tag_by_index(df, spark.createDataFrame(catalog, CATALOG), "k")) == rows(by_plan(df, catalog))


def test_blocks_cover_each_place_of_a_range_once(spark):
    catalog = [(f"{a}-{b}", body(v=("range", f"[{a},{b}]"))) for a in range(12) for b in range(a, 12)]
    index = ri.rule_index(spark.createDataFrame(catalog, CATALOG))
    names = {r["_body"]: r["_ids"][0] for r in index.bodies.collect()}
    covered = {}
    for r in index.lookups.collect():
        covered.setdefault(names[r["_body"]], []).extend(range(r["_block"] << r["_level"], (r["_block"] + 1) << r["_level"]))
    for name, got in covered.items():
        a, b = map(int, name.split("-"))
        assert sorted(got) == list(range(2 * a + 1, 2 * b + 2)), name
    assert len(covered) == 78


@pytest.mark.parametrize(
    "value", ["", "nothing", "{}", body(v=("near", "1")), body(v=("range", "[1_000,2_000]")), body(v=("range", "[2,1]")), body(v=("range", "(1,1)")),
              body(v=("range", "[nan,1]")), body(v=("range", "[1,inf]")), body(v=("range", "<1,2>")), body(v=("range", "[1,2,3]"))]
)
def test_bad_rules_fail(spark, value):
    with pytest.raises(RuleError):
        ri.rule_index(spark.createDataFrame([("1", value)], CATALOG))


def test_a_missing_field_fails(spark):
    index = ri.rule_index(spark.createDataFrame([("1", body(nowhere=("single", "x")))], CATALOG))
    with pytest.raises(RuleError, match="nowhere"):
        index.labelled(spark.range(3))


def test_no_rules_and_no_rows(spark, values, rows):
    none = spark.createDataFrame([], CATALOG)
    assert {r["labels"] for r in ri.tag_by_index(values, none, "k").collect()} == {""}
    one = spark.createDataFrame([("1", body(t=("single", "a")))], CATALOG)
    assert ri.tag_by_index(values.limit(0), one, "k").collect() == []


def test_plan_does_not_grow_with_the_rules(spark, plan):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"), F.col("id").cast("double").alias("v"))

    def expressions(count):
        catalog = spark.range(count).select(
            F.col("id").cast("string").alias("id"),
            F.format_string('{"v":{"type":"range","value":"[%d,%d)"}}', F.col("id") % 100, F.col("id") % 100 + 1).alias("value"),
        )
        return plan(ri.tag_by_index(df, catalog, "k")).count("CASE WHEN")

    assert expressions(20_000) == expressions(200)
