import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tagloom.operators import indexing
from tagloom.operators.indexing import _with_bucket, global_positions
from tagloom.sinks.keyvalue import key_value_entries
from pyspark.sql import functions as F

_DATA = st.lists(st.tuples(st.sampled_from([None, "a", "b", "c"]), st.integers(0, 6)), min_size=1, max_size=60)


def positions(data):
    return sorted(data, key=lambda r: ((r[0] is not None, r[0] or ""), r[1]))


@settings(max_examples=10, deadline=None)
@given(_DATA, st.integers(1, 20))
def test_positions_equal_a_global_sort(spark, data, buckets):
    df = spark.createDataFrame(data, "o string, e int").repartition(4)
    want = positions(data)
    got = [None] * len(data)
    for r in global_positions(df, ["o"], buckets).collect():
        assert r.total == len(data)
        for p in range(r.start, r.start + r.copies):
            assert got[p] is None
            got[p] = (r.o, r.e)
    assert got == want


@pytest.mark.parametrize("n", [1, 2, 7, 16, 17, 50])
def test_bucket_counts_cuts(spark, n):
    cuts = F.array(*[F.struct(F.lit(10 * i).alias("x")) for i in range(n)])
    df = spark.range(-3, 10 * n + 3).select(F.col("id").cast("int").alias("x"))
    got = _with_bucket(df, cuts, ["x"], n).collect()
    assert all(r._bucket == sum(10 * i <= r.x for i in range(n)) for r in got)


def test_buckets_are_balanced(spark):
    df = spark.range(200_000).select(F.xxhash64("id").alias("o"))
    placed = indexing.global_positions(df, ["o"], 256)
    # The number of the bucket is not part of the result; the window that places the rows has one group for each.
    rows = df.withColumn("_row", F.struct("o")).withColumn("_hash", F.xxhash64("o"))
    sample = sorted(r._row.o for r in rows.orderBy("_hash").limit(256 * indexing.ROWS_PER_CUT).collect())
    cuts = sample[indexing.ROWS_PER_CUT - 1 :: indexing.ROWS_PER_CUT]
    assert len(cuts) == 256 and placed.count() == 200_000
    sizes = _with_bucket(df, F.array(*[F.struct(F.lit(c).alias("o")) for c in cuts]), ["o"], 256).groupBy("_bucket").count()
    assert max(r["count"] for r in sizes.collect()) <= 2 * 200_000 / 257


@pytest.mark.parametrize("partitions", [3, 200])
def test_the_sample_is_small_whatever_the_tasks(spark, partitions):
    """The order of the sample gets some 40 rows for each bucket, not as many from every task."""
    rows = spark.range(0, 100_000, 1, partitions).select(F.xxhash64("id").alias("o"))
    cuts = spark.range(1).select(indexing.sample_cuts(rows, ["o"], 16).alias("cuts"))
    assert len(cuts.first()[0]) == 16
    total, wanted = 100_000, 16 * indexing.ROWS_PER_CUT
    spread = F.shiftrightunsigned(F.xxhash64("o"), 11).cast("double") / F.lit(float(2**53))
    assert wanted <= rows.where(spread * total <= 1.2 * wanted + 4 * wanted**0.5).count() <= 50 * 16


def test_a_hot_row_is_one_row(spark, plan):
    df = spark.range(100_000).select(F.lit("same").alias("e"))
    placed = global_positions(df, [], 8)
    assert [tuple(r) for r in placed.collect()] == [("same", 100_000, 0, 100_000)]


PUSHES = [("b", 1), ("a", 2), ("b", 3), ("c", 4), ("b", 4)]


@pytest.fixture
def pushes(spark):
    return spark.createDataFrame(PUSHES, "m string, t int").repartition(3)


def entries(df, kind, rows, **options):
    return rows(key_value_entries(df, kind, **{"key": "k", "value": "m", "order": ["t"], **options}))


def test_list_is_reversed(pushes, rows):
    want = [r[0] for r in sorted(PUSHES, key=lambda r: (r[1], r[0]))][::-1]
    got = sorted((r[1], r[2]) for r in entries(pushes, "List", rows))
    assert got == list(enumerate(want))


def test_sorted_set_keeps_the_last_score(pushes, rows):
    assert entries(pushes, "Sorted Set", rows) == entries(pushes, "sortedset", rows)
    assert entries(pushes, "SORTED SET", rows) == [("k", "a", 1.0), ("k", "b", 3.0), ("k", "c", 4.0)]


def test_set_string_and_hash(pushes, rows):
    assert entries(pushes, "set", rows) == [("k", "a"), ("k", "b"), ("k", "c")]
    assert entries(pushes, "string", rows, key="m", value="m#t") == [("a", "a,2"), ("b", "b,4"), ("c", "c,4")]
    got = entries(pushes, "hash", rows, hash_field="m", hash_value="t#m")
    assert got == [("k", "a", "2_a"), ("k", "b", "4_b"), ("k", "c", "4_c")]


@pytest.mark.parametrize("kind", ["stream", "", "hash"])
def test_unknown_kinds_fail(pushes, kind):
    with pytest.raises(ValueError):
        key_value_entries(pushes, kind, key="k", value="m", order=["t"])
