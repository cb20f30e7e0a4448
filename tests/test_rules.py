import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.operators import rules
from tagloom.operators.rules import Rule, RuleError

EDGES = [
    ("1", "5", "a"), ("2", "5.0", "b"), ("3", "10", "a,b"), ("4", None, "a"),
    ("5", "x", " a"), ("6", "", ""), ("7", "7.5", None), ("8", "-1", "B"),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, "id string, amount string, kind string")


def ids(df, predicate):
    return "".join(sorted(r.id for r in df.where(predicate).collect()))


@pytest.mark.parametrize(
    "interval,expected",
    [("[5,10]", "1237"), ("(5,10)", "7"), ("[5,10)", "127"), ("(5,10]", "37"), ("[5,5]", "12"), ("[5,5)", ""), ("(5,5]", ""),
     ("[-Infinity,0)", "8"), ("[ 5 , 10 ]", "1237")],
)
def test_range_ends_nulls_and_text(edges, interval, expected):
    assert ids(edges, rules.match_range(F.col("amount"), interval)) == expected


@pytest.mark.parametrize("interval", ["10,20", "{10,20]", "[10,20}", "[20,10]", "(5,5)", "[a,b]", "[1,2,3]", "[1]", ""])
def test_bad_ranges_fail_when_compiled(interval):
    with pytest.raises(RuleError):
        rules.match_range(F.col("amount"), interval)


@pytest.mark.parametrize("value,expected", [("5", "1"), ("5.0", "2"), ("", "6"), ("X", "")])
def test_single_is_text_equality(edges, value, expected):
    assert ids(edges, rules.match_single(F.col("amount"), value)) == expected


@pytest.mark.parametrize(
    "value,expected",
    [("a,b", "124"), ("a, a", "145"), ("b", "2"), ("", "6"), (",", ""), ("a,,b", "1246"), ("a,,", "14"), ("b,B", "28")],
)
def test_list_is_exact_and_untrimmed(edges, value, expected):
    assert ids(edges, rules.match_list(F.col("kind"), value)) == expected


def test_single_and_list_read_doubles_as_text(spark):
    df = spark.createDataFrame([("1", 23.0), ("2", 23.5)], "id string, x double")
    assert ids(df, rules.match_single(F.col("x"), "23")) == ""
    assert ids(df, rules.match_single(F.col("x"), "23.0")) == "1"
    assert ids(df, rules.match_list(F.col("x"), "23,23.5")) == "2"


@pytest.mark.parametrize(
    "body",
    ["", "{}", "not json", "[]", '{"x":{"value":"1"}}', '{"x":{"type":"single"}}', '{"x":{"value":"1","type":"regex"}}', '{"x":1}'],
)
def test_bad_bodies_fail_when_compiled(spark, body):
    with pytest.raises(RuleError):
        rules.label_column("1", [Rule("1", body)])


def test_label_without_rows_fails(spark):
    with pytest.raises(RuleError):
        rules.label_column("2", [Rule("1", '{"x":{"value":"1","type":"single"}}')])


def test_fields_are_compared_in_their_own_column(spark, rows):
    """A null field or a comma in a value must not shift the fields after it."""
    df = spark.createDataFrame([("1", None, "b"), ("2", "a,b", "c"), ("3", "a", "b")], "id string, x string, y string")
    rule = Rule("7", '{"x":{"value":"a","type":"single"},"y":{"value":"b","type":"single"}}')
    assert rows(df.select("id", rules.label_column("7", [rule]))) == [("1", None), ("2", None), ("3", "7")]


def test_field_names_are_taken_literally(spark):
    df = spark.createDataFrame([("1", "a")], "id string, `odd.name` string")
    rule = Rule("7", '{"odd.name":{"value":"a","type":"LiSt"}}')
    assert df.select(rules.label_column("7", [rule])).first()[0] == "7"


def test_rule_conditions_equal_parsed_rules(spark, rows):
    body = '{"a":{"value":"1,2","type":"list"},"b":{"value":"[0,1)","type":"Range"}}'
    catalog = spark.createDataFrame([("1", body, "s"), ("2", "", "s"), ("3", None, "s")], "id string, value string, source_name string")
    parsed = {(c.field, c.kind, c.value) for c in Rule("1", body).conditions()}
    found = rows(rules.rule_conditions(catalog))
    assert {r[2:5] for r in found if r[5] is None} == parsed
    assert [(r[0], r[2:]) for r in found if r[5]] == [(i, (None, None, None, "unreadable rule body")) for i in "23"]


def _matches(rule, row):
    def one(field, kind, value):
        x = row[field]
        if x is None:
            return False
        if kind == "single":
            return x == value
        if kind == "list":
            return x in value.split(",")
        low, high = (float(p) for p in value[1:-1].split(","))
        try:
            number = float(x)
        except ValueError:
            return False
        return (number >= low if value[0] == "[" else number > low) and (number <= high if value[-1] == "]" else number < high)

    return all(one(f, c["type"], c["value"]) for f, c in rule.items())


_FIELD = st.sampled_from([None, "1", "2", "2.5", "7", "a", "b", "", "-3"])
_RANGE = st.tuples(st.sampled_from("(["), st.integers(-4, 3), st.integers(1, 8), st.sampled_from(")]")).map(
    lambda t: f"{t[0]}{t[1]},{t[1] + t[2]}{t[3]}"
)
_CONDITION = st.one_of(
    st.fixed_dictionaries({"type": st.just("single"), "value": st.sampled_from(["1", "a", "2.5"])}),
    st.fixed_dictionaries({"type": st.just("list"), "value": st.sampled_from(["1,a", "b,2", "7"])}),
    st.fixed_dictionaries({"type": st.just("range"), "value": _RANGE}),
)
_BODY = st.dictionaries(st.sampled_from("xyz"), _CONDITION, min_size=1)


@settings(max_examples=15, deadline=None)
@given(st.lists(_BODY, min_size=1, max_size=3), st.lists(st.tuples(_FIELD, _FIELD, _FIELD), min_size=1, max_size=30))
def test_label_equals_brute_force(spark, bodies, data):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, x string, y string, z string").coalesce(1)
    column = rules.label_column("9", [Rule("9", json.dumps(b)) for b in bodies])
    got = {r.i: r.label_9 for r in df.select("i", column).collect()}
    want = {
        i: "9" if any(_matches(b, dict(zip("xyz", r, strict=True))) for b in bodies) else None for i, r in enumerate(data)
    }
    assert got == want


def test_many_labels_stay_in_one_generated_projection(spark, plan):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 97).alias("x"))
    all_rules = [Rule(str(i), json.dumps({"x": {"value": f"[{i % 90},{i % 90 + 5})", "type": "range"}})) for i in range(300)]
    labels = df.select("id", F.concat_ws(",", *rules.label_columns([r.id for r in all_rules], all_rules)).alias("labels"))
    text = plan(labels)
    assert text.count("Project [") == text.count("*(1) Project [") <= 2
    assert labels.where(F.col("id") == "40").first().labels.split(",")[0] == "36"
