"""Documents that are kept up: change sets, the index by label, bucketed tables, merged entries, audiences."""

import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators import audiences as au
from tagloom.operators import changes as ch
from tagloom.operators import documents as d
from tagloom.operators import postings as po
from tagloom.sinks import buckets as b
from tagloom.sinks import keyvalue as kv

LABELS = "id string, labels string"


# Change sets


@pytest.fixture
def old(spark):
    return spark.createDataFrame([("1", "a", 1), ("2", None, 2), ("3", "c", None), ("4", "d", 4), (None, "x", 9)], "id string, labels string, n int")


@pytest.fixture
def new(spark):
    # In 3 the value moves to the other column; a hash that skips nulls would not see it.
    return spark.createDataFrame([("1", "a", 1), ("2", "b", 2), ("3", None, 3), ("5", None, None), (None, "y", 9)], "id string, labels string, n int")


@pytest.mark.parametrize("unique", [True, False])
def test_change_set(rows, old, new, unique):
    got = rows(ch.change_set(old, new, unique=unique))
    assert got == [("2", "changed", "b", 2), ("3", "changed", None, 3), ("4", "gone", None, None), ("5", "inserted", None, None)]
    assert rows(ch.change_set(old, old, unique=unique)) == []


def test_a_null_that_moves_is_a_change(spark, rows):
    a, z = (spark.createDataFrame([("1", *v)], "id string, x string, y string") for v in ((None, "v"), ("v", None)))
    assert rows(ch.change_set(a, z)) == [("1", "changed", "v", None)]


def test_changes_lead_from_old_to_new(rows, old, new):
    changes = ch.change_set(old, new)
    state = ch.apply_changes(old, changes)
    assert rows(state.where("id is not null")) == rows(new.where("id is not null"))
    assert rows(ch.apply_changes(state, changes)) == rows(state)


def test_changes_keep_other_fields(spark, rows, old):
    state = old.withColumn("own", F.col("id"))
    got = rows(ch.apply_changes(state, ch.change_set(old.select("id", "labels"), spark.createDataFrame([("1", "z"), ("4", "d"), ("9", "n")], LABELS))))
    assert got == [(None, "x", 9, None), ("1", "z", 1, "1"), ("4", "d", 4, "4"), ("9", "n", None, None)]


def test_repeated_ids_count_once(spark, rows):
    twice = spark.createDataFrame([("1", "b"), ("1", "a"), ("1", None)], LABELS)
    assert rows(ch.change_set(twice, twice.where("labels is null"))) == []
    assert rows(ch.change_set(twice.limit(0), twice)) == [("1", "inserted", None)]


def test_new_columns_are_changes(spark, rows):
    before = spark.createDataFrame([("1", "a"), ("2", "b")], LABELS)
    after = spark.createDataFrame([("1", "a", "m"), ("2", "b", None)], LABELS + ", markets string")
    assert rows(ch.change_set(before, after)) == [("1", "changed", "a", "m")]


def test_the_old_side_travels_as_a_digest(spark, plan):
    before = spark.range(100).select(F.col("id").cast("string").alias("id"), F.repeat(F.lit("x"), F.lit(100)).alias("labels"))
    text = plan(ch.change_set(before, before, unique=True))
    shuffled = [line for line in text.split("\n") if "Exchange hashpartitioning" in line]
    assert len(shuffled) == 2 and "_before" in text


# The index by label


def state_of(spark, seed, count=60):
    r = random.Random(seed)
    choices = ["7", "17", "71", "", "a b", "it's", "x=y/z", "é%", "..", "A", "a"]
    rows = [(str(i), None if r.random() < 0.1 else ",".join(r.choices(choices, k=r.randint(0, 4)))) for i in range(count)]
    return spark.createDataFrame(rows, LABELS)


def test_search_equals_the_scan_after_every_update(spark, rows, database):
    state, table = state_of(spark, 1), f"{database}.postings"
    po.build_postings(state, table)
    updates = [
        lambda s: d.labels_append_one(s, s.where("try_cast(id as int) % 7 = 0").union(spark.createDataFrame([("new", None)], LABELS)), "17"),
        lambda s: d.labels_remove(s, "7"),
        lambda s: d.doc_upsert(s, state_of(spark, 2, 20)),
        lambda s: d.labels_add(s, s.where("try_cast(id as int) % 3 = 0").select("id", F.lit("7,it's").alias("labels"))),
        lambda s: s.where("id != '5'"),
    ]
    for version, update in enumerate([lambda s: s, *updates], 1):
        after = spark.createDataFrame(update(state).collect(), LABELS)
        changes = ch.change_set(state, after)
        po.update_postings(table, po.posting_changes(state, changes), version)
        if version == 3:  # an update that is run again
            po.update_postings(table, po.posting_changes(state, changes), version)
        if version in (3, 6):
            po.compact(spark, table, f"{database}.folded", None if version == 6 else ["7", "17", "nothing"])
        state = after
        for label in ["7", "17", "71", "", "a b", "it's", "x=y/z", "é%", "..", "A", "a", "nothing"]:
            assert rows(po.search_documents(state, table, [label])) == rows(d.docs_with_label(state, label)), (version, label)
        assert rows(po.search_documents(state, table, ["7", "it's"])) == rows(d.docs_with_any_label(state, ["7", "it's"]))
        both = state.where("array_contains(split(labels, ','), '7') and array_contains(split(labels, ','), '17')")
        assert rows(po.ids_with_all_labels(spark, table, ["7", "17", "7"])) == rows(both.select("id"))
    assert spark.table(table).where("not live").count() == 0 and not spark.catalog.tableExists(f"{database}.folded")


def test_a_search_reads_its_labels_only(spark, plan, database):
    table = f"{database}.postings"
    po.build_postings(state_of(spark, 3), table)
    found = spark.read.table(table).where(F.col("label").isin("_7")).inputFiles()
    assert found and all("label=_7" in f for f in found)
    text = plan(po.ids_with_any_label(spark, table, ["7"]))
    assert "PartitionFilters: [isnotnull(label" in text and "= _7)" in text
    everything = len(spark.read.table(table).inputFiles())
    assert len(found) < everything


def test_an_empty_index(spark, rows, database):
    table = f"{database}.postings"
    po.build_postings(state_of(spark, 3).limit(0), table)
    po.compact(spark, table, f"{database}.folded")
    assert rows(po.ids_with_any_label(spark, table, ["7"])) == []


# Bucketed states


def exchanges_above(plan_text, scan):
    """The exchanges on the way from the scan of the table to the top of the plan."""
    lines = plan_text.split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-|"))
    at = next(i for i, line in enumerate(lines) if scan in line)
    level, out = depth(lines[at]), []
    for line in reversed(lines[:at]):
        if line.strip() and depth(line) < level:
            level = depth(line)
            out += ["Exchange"] if "Exchange" in line else []
    return out


@pytest.mark.parametrize("update", ["upsert", "changes", "append"])
def test_a_bucketed_state_is_not_shuffled(spark, plan, rows, database, update):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = spark.range(200).select(F.col("id").cast("string").alias("id"), F.lit("1,2").alias("labels"))
        state = b.save_bucketed(plain, f"{database}.documents", 8)
        delta = spark.range(150, 260).select(F.col("id").cast("string").alias("id"), F.lit("3").alias("labels"))
        merge = {
            "upsert": lambda s: d.doc_upsert(s, delta),
            "changes": lambda s: ch.apply_changes(s, delta.select("id", F.lit("inserted").alias("change"), "labels")),
            "append": lambda s: d.labels_append(s, delta),
        }[update]
        merged, want = merge(state), rows(merge(plain))
        text = plan(merged)
        assert "documents" in text and exchanges_above(text, "documents") == []
        got = b.merge_bucketed(merged, f"{database}.documents", 8)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(got) == want and rows(spark.table(f"{database}.documents")) == want
    files = spark.table(f"{database}.documents").inputFiles()
    assert len(files) <= 8  # a task writes one file


def test_a_broken_replacement_is_finished(spark, rows, database):
    table = f"{database}.documents"
    b.save_bucketed(spark.createDataFrame([("1", "old")], LABELS), table, 4)
    # Written, not in place yet: the old table is what is read.
    spark.createDataFrame([("1", "half")], LABELS).write.saveAsTable(f"{table}__next")
    assert rows(spark.table(table)) == [("1", "old")]
    got = b.save_bucketed(spark.createDataFrame([("1", "new")], LABELS), table, 4)
    assert rows(got) == [("1", "new")]
    # Taken away, and the new one not in place.
    spark.createDataFrame([("1", "newer")], LABELS).write.saveAsTable(f"{table}__next")
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__last")
    b.recover(spark, table)
    assert rows(spark.table(table)) == [("1", "newer")]
    b.replace_table(spark.table(table).withColumn("labels", F.lit("again")), table)
    assert rows(spark.table(table)) == [("1", "again")] and not spark.catalog.tableExists(f"{table}__last")


# Merged entries


def test_merged_entries(spark, rows):
    frame = spark.createDataFrame
    strings = "key string, value string"
    assert rows(kv.merge_entries(frame([("a", "1"), ("b", None)], strings), frame([("b", "2"), ("c", "3")], strings), "String")) == [
        ("a", "1"), ("b", "2"), ("c", "3")]
    hashes = "key string, field string, value string"
    got = kv.merge_entries(frame([("k", "f", "1"), ("j", "f", "9")], hashes), frame([("k", "f", None)], hashes), "hash")
    assert rows(got) == [("j", "f", "9"), ("k", "f", None)]
    lists = "key string, pos bigint, element string"
    state, new = frame([("k", 0, "x"), ("k", 1, "y"), ("j", 0, "z")], lists), frame([("k", 0, "b"), ("k", 1, "a")], lists)
    once = kv.merge_entries(state, new, "LIST")
    assert rows(once) == [("j", 0, "z"), ("k", 0, "b"), ("k", 1, "a"), ("k", 2, "x"), ("k", 3, "y")]
    assert rows(kv.merge_entries(once, new, "list"))[1:4] == [("k", 0, "b"), ("k", 1, "a"), ("k", 2, "b")]
    with pytest.raises(ValueError):
        kv.merge_entries(state, new, "stream")


@pytest.mark.parametrize("kind", ["string", "hash", "set", "sorted set"])
def test_entries_may_be_merged_again(spark, rows, kind):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "m string, t int")
    later = spark.createDataFrame([("c", 1), ("a", 9)], "m string, t int")
    options = {"key": "m" if kind == "string" else "k", "value": "m", "order": ["t"], "hash_field": "m", "hash_value": "t"}
    state, new = (kv.key_value_entries(x, kind, **options) for x in (df, later))
    once = kv.merge_entries(state, new, kind)
    assert rows(kv.merge_entries(once, new, kind)) == rows(once)
    assert rows(kv.merge_entries(state.limit(0), new, kind)) == rows(new) and rows(kv.merge_entries(state, new.limit(0), kind)) == rows(state)


# Audiences


def test_audiences_equal_sets(spark, rows):
    r = random.Random(4)
    users = [f"u{i:05d}" for i in range(70_000)]  # more than two buckets
    members = [(r.choice("xy"), r.choice("abc"), u) for u in r.choices(users, k=3000)] + [("x", "a", users[0])] * 50 + [("x", "b", users[-1]), ("x", "a", users[-1])]
    df = spark.createDataFrame(members, "place string, label string, id string").repartition(4)
    numbers = au.user_numbers(spark.createDataFrame([(u,) for u in users] + [(None,), (users[3],)], "id string"))
    assert [tuple(x) for x in numbers.orderBy("number").limit(2).collect()] == [("u00000", 1), ("u00001", 2)] and numbers.count() == 70_000
    bitmaps = au.audience_bitmaps(df, numbers, ["place", "label"])
    sets = {}
    for p, label, u in members:
        sets.setdefault((p, label), set()).add(u)
    assert rows(au.audience_sizes(bitmaps, ["place", "label"])) == sorted((*k, len(v)) for k, v in sets.items())
    by_label = {label: len(sets["x", label] | sets["y", label]) for label in "abc"}
    assert dict(rows(au.audience_sizes(bitmaps, ["label"]))) == by_label
    overlaps = sorted((p, i, j, len(sets[p, i] & sets[p, j])) for p in "xy" for i, j in ("ab", "ac", "bc") if sets[p, i] & sets[p, j])
    assert rows(au.audience_overlaps(bitmaps, ["place"], "label", ["c", "a", "b", "none"])) == overlaps
