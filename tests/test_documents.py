import pytest
from pyspark.sql import functions as F

from tagloom.operators import documents as d
from tagloom.plans.publish import publish_documents

LABELS = "id string, labels string"


@pytest.fixture
def state(spark):
    return spark.createDataFrame([("1", "38,138"), ("2", "138"), ("3", None), ("4", ""), ("5", "5,6,7")], LABELS)


def test_append_is_repeatable_only_as_add(spark, rows, state):
    delta = spark.createDataFrame([("1", "38"), ("3", "9"), ("5", ""), ("9", "1,2")], LABELS)
    once = d.labels_append(state, delta)
    assert rows(once) == [("1", "38,138,38"), ("2", "138"), ("3", None), ("4", ""), ("5", "5,6,7"), ("9", "1,2")]
    assert rows(d.labels_append(once, delta))[0] == ("1", "38,138,38,38")
    added = d.labels_add(state, delta)
    assert rows(added) == rows(d.labels_add(added, delta))
    assert rows(added)[0] == ("1", "38,138")


def test_several_deltas_of_one_document(spark, rows, state):
    delta = spark.createDataFrame([("2", "7"), ("2", "5,6"), ("2", "7"), ("9", "1"), ("9", "1")], LABELS)
    got = rows(d.labels_append(state, delta))
    assert ("2", "138,5,6,7,7") in got and ("9", "1,1") in got


def test_changes_without_id_add_nothing(spark, rows, state):
    delta = spark.createDataFrame([(None, "7"), ("9", "1")], LABELS)
    want = rows(state) + [("9", "1")]
    for change in (
        lambda s: d.labels_append(s, delta.where("id is null")),
        lambda s: d.labels_add(s, delta),
        lambda s: d.labels_append_one(s, delta.where("id is null"), "7"),
        lambda s: d.labels_remove_tail(s, delta.where("id is null").withColumnRenamed("labels", "label")),
        lambda s: d.doc_upsert(s, delta),
    ):
        twice = rows(change(change(state)))
        assert twice in (rows(state), want)


def test_upsert_keeps_all_fields(spark, rows, state):
    new = spark.createDataFrame([("1", "9", "m"), ("7", None, "n")], "id string, labels string, markets string")
    stored = d.doc_upsert(state, new)
    assert stored.columns == ["id", "labels", "markets"]
    assert ("1", "9", "m") in rows(stored) and ("7", None, "n") in rows(stored) and ("2", "138", None) in rows(stored)
    back = d.doc_upsert(stored, spark.createDataFrame([("1", "8"), ("5", "0")], LABELS))
    assert back.columns == ["id", "labels", "markets"]
    assert ("1", "8", None) in rows(back) and ("5", "0", None) in rows(back) and ("7", None, "n") in rows(back)


def test_add_to_empty_document(spark, rows, state):
    delta = spark.createDataFrame([("4", "2,1"), ("4", "1")], LABELS)
    assert ("4", "1,2") in rows(d.labels_add(state, delta))


def test_append_one(spark, rows, state):
    ids = spark.createDataFrame([("1", ""), ("1", ""), ("3", ""), ("9", "")], LABELS)
    got = rows(d.labels_append_one(state, ids, "7"))
    assert got[0] == ("1", "38,138,7") and ("3", None) in got and ("9", "7") in got


def test_remove_takes_whole_labels(rows, state):
    assert rows(d.labels_remove(state, "38")) == [("1", "138"), ("2", "138"), ("3", None), ("4", ""), ("5", "5,6,7")]
    assert rows(d.labels_remove_many(state, ["138", "6", "5"]))[0] == ("1", "38")
    assert ("5", "7") in rows(d.labels_remove_many(state, ["138", "6", "5"]))


def test_remove_tail_spares_the_first(spark, rows, state):
    removals = spark.createDataFrame([("5", "5"), ("5", "7"), ("1", "138"), ("9", "3")], "id string, label string")
    got = rows(d.labels_remove_tail(state, removals))
    assert ("5", "5,6") in got and ("1", "38") in got and ("9", "3") in got and ("3", None) in got


def test_remove_undoes_add(spark, state):
    delta = spark.createDataFrame([(i, "77") for i in "12459"], LABELS)
    tokens = F.split(F.coalesce("labels", F.lit("")), ",")
    assert d.labels_remove(d.labels_add(state, delta), "77").where(F.array_contains(tokens, "77")).count() == 0


def test_compact(spark):
    df = spark.createDataFrame([("1,,,2",), (",1,",), (",",), (None,)], "labels string")
    assert [r[0] for r in d.labels_compact(df).collect()] == ["1,2", "1", "", None]


def test_search_matches_whole_labels(rows, state):
    assert [r[0] for r in rows(d.docs_with_label(state, "38"))] == ["1"]
    assert [r[0] for r in rows(d.docs_with_any_label(state, ["38", "6"]))] == ["1", "5"]


def test_upsert_replaces_and_keeps(spark, rows, state):
    new = spark.createDataFrame([("1", "x", 2), ("1", "y", 1), ("9", "z", 1)], "id string, labels string, seq int")
    got = rows(d.doc_upsert(state, new, F.col("seq"), ["seq"]))
    assert got == [("1", "x"), ("2", "138"), ("3", None), ("4", ""), ("5", "5,6,7"), ("9", "z")]
    assert rows(d.doc_upsert(d.doc_upsert(state, new, F.col("seq"), ["seq"]), new, F.col("seq"), ["seq"])) == got


def test_dispatch(spark, rows, state):
    delta = spark.createDataFrame([("1", "9")], LABELS)
    assert rows(d.update_documents(state, "Add", delta))[0] == ("1", "38,138,9")
    assert rows(d.update_documents(state, "delete", label_id="38"))[0] == ("1", "138")
    for action, options in (("drop", {"delta": delta}), ("add", {}), ("delete", {})):
        with pytest.raises(ValueError):
            d.update_documents(state, action, **options)


def test_publish_projects_and_stores(spark, rows):
    source = spark.createDataFrame([("a", 1, "x", "202401"), ("b", 2, "y", "202312")], "k string, n int, s string, m string")
    state = spark.createDataFrame([("a", 0), ("c", 3)], "id string, n int")
    assert rows(publish_documents(state, source, "k", "n", "m", "202401")) == [("a", 1), ("c", 3)]
    assert rows(d.doc_projection(source, "k", "n#s", "m", "202401")) == [("a", 1, "x")]
    assert rows(d.doc_projection(source, "k", " ", "m", "202312")) == [("b",)]
