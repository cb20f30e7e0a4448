import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.functions import dates, text


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first().c


@pytest.mark.parametrize(
    "value,expected",
    [("a,b", ["a", "b"]), ("a,b,,", ["a", "b"]), ("a,,b", ["a", "", "b"]), (",a", ["", "a"]), ("", [""]), (",,", []), (None, None)],
)
def test_csv_split(spark, value, expected):
    assert one(spark, text.csv_split(F.lit(value).cast("string"))) == expected


def test_csv_forms(spark):
    assert one(spark, text.csv_prefix(F.lit("1,2"))) == "label_1,label_2"
    assert one(spark, text.csv_prefix(F.lit("1,2"), "p")) == "p1,p2"
    assert one(spark, text.csv_quote(F.lit("1,2"))) == '"1","2"'
    assert one(spark, text.csv_alias_list(F.lit("1,2"))) == " '1' as label_1,'2' as label_2"
    assert one(spark, text.csv_clean_split(F.lit('"a", "b c" ,'))) == ["a", "bc"]
    assert one(spark, text.csv_join(F.array(F.lit("a"), F.lit("b")))) == "a,b"


def test_str_map(spark):
    assert one(spark, text.str_map(F.lit("a:1,b:2,a:3"))) == {"a": "3", "b": "2"}
    assert one(spark, text.str_map(F.lit("a=1|b=2"), "|", "=")) == {"a": "1", "b": "2"}
    assert one(spark, text.str_map(F.lit("a::1;;b::2"), ";;", "::")) == {"a": "1", "b": "2"}
    assert one(spark, text.str_map(F.lit(None).cast("string"))) is None
    assert one(spark, text.str_map(F.lit("a:1,b:2,,"))) == {"a": "1", "b": "2"}
    assert one(spark, text.str_map(F.lit("a::1;;b::2;;"), ";;", "::")) == {"a": "1", "b": "2"}
    assert one(spark, text.str_map(F.lit(",,"))) == {}
    assert one(spark, text.str_map(F.lit(":1"))) == {"": "1"}
    for bad in ("a:1,b", "a:1,b:", "a:1:2", "", "a:1,,b:2", ",a:1", "a:1,b:2:"):
        with pytest.raises(Exception, match="not a pair"):
            one(spark, text.str_map(F.lit(bad)))


def test_template(spark):
    filled = text.template_fill(F.lit("select {a} from {b} where {a}"), {"a": "x", "b": F.lit("t")})
    assert one(spark, filled) == "select x from t where x"
    with pytest.raises(Exception, match="no parameter for c"):
        one(spark, text.template_fill(F.lit("{a} {c}"), {"a": "x"}))


def test_quotes_and_json(spark):
    assert one(spark, text.single_to_double_quotes(F.lit("it's"))) == 'it"s'
    assert one(spark, text.json_field(F.lit('{"k": 5}'), "k")) == "5"


def test_dates(spark):
    day = F.lit(dt.date(2021, 3, 31))
    assert one(spark, dates.month_of(day)) == "202103"
    assert one(spark, dates.year_ago_month(day)) == "202003"
    assert one(spark, dates.last_month_day(day)) == "20210228"
    assert one(spark, dates.last_month_id(day)) == "202102"
    assert one(spark, dates.next_month(F.lit("202112"))) == "202201"
    assert one(spark, dates.months_before(F.lit("202106"), 12)) == "202006"
    assert one(spark, dates.n_months_ago_day(day, 1)) == "20210228"
    got = {n: one(spark, c) for n, c in dates.comparison_dates(F.lit(dt.date(2021, 4, 1))).items()}
    assert got == {
        "base_day": "20210331", "base_month": "202103", "day_before": "20210330",
        "prev_month": "202102", "prev_month_day": "20210228",
    }


@settings(max_examples=50, deadline=None)
@given(st.dates(dt.date(1990, 1, 1), dt.date(2050, 12, 31)), st.integers(-40, 40))
def test_driver_months_equal_column_months(spark, day, n):
    period = day.strftime("%Y%m")
    params = dates.period_parameters(day)
    column = F.lit(day)
    got = spark.range(1).select(
        dates.months_before(F.lit(period), n), dates.month_of(column), dates.year_ago_month(column),
        dates.last_month_day(column), dates.last_month_id(column),
    ).first()
    assert tuple(got) == (
        dates.shift_month(period, -n), params["dt"], params["year"], params["last_month_day"], params["month_id"]
    )
    assert params["day_id"] == params["last_month_day"] and dates.previous_period(day) == params["last_month_id"]
