"""Exact duplicates by an extendible-hash index kept in shared files."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import SPACE_CLASS, same, settled

#: Keys of a bucket, at most; a fuller one is split if its keys differ in any further bit.
CAPACITY = 2_000
#: A key is spread over owners if it has more rows than this, and more than a quarter of an even partition.
HOT_ROWS = 10_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE_CLASS}+", " ")


def hash_key(text: Column, bits: int = 64) -> Column:
    """The index key; fewer bits only make collisions likely, for tests."""
    key = F.xxhash64(text)
    return key if bits == 64 else F.shiftleft(key, 64 - bits)


def _prefix(key: Column, depth: int) -> Column:
    """The first ``depth`` bits of a key, at the top of a long."""
    return F.shiftleft(F.shiftright(key, 64 - depth), 64 - depth) if depth else F.lit(0).cast("long")


@dataclass(frozen=True)
class Directory:
    """Which bucket a key is in: its first ``depth`` bits, but for slots that were split further.

    ``splits`` has those, ``(_slot, _depth)``: a slot is named by its bits at the top of a long. The bits of a hash are
    even, so a slot is split only where keys are not; the table is empty unless the hash is poor.
    """

    depth: int
    splits: DataFrame | None

    def place(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``_bucket``, the bucket of their ``_key``."""
        slot = _prefix(F.col("_key"), self.depth)
        if self.splits is None:
            return rows.withColumn("_bucket", slot)
        rows = rows.withColumn("_slot", slot).join(self.splits, "_slot", "left")
        # A split slot is a list of prefixes; a key has the one that it begins with.
        found = F.expr("get(filter(_prefixes, p -> shiftright(_key, 64 - p.depth) = shiftright(p.bucket, 64 - p.depth)), 0).bucket")
        return rows.withColumn("_bucket", F.coalesce(found, F.col("_slot"))).drop("_slot", "_prefixes")


def directory(keys: DataFrame, capacity: int = CAPACITY) -> Directory:
    """The directory of the distinct ``_key`` of ``keys``.

    It starts at the depth at which even slots hold a quarter of the capacity. Then overfull buckets are split by their next
    bit, all at once, until every bucket holds at most ``capacity`` keys or keys that no bit parts; keys
    of buckets that fit are not looked at again. A round is one count over the keys of overfull slots.
    """
    total = keys.count()
    depth = max(0, math.ceil(math.log2(max(1, 4 * total / capacity)))) if total > capacity else 0
    counts = keys.groupBy(_prefix(F.col("_key"), depth).alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    full = settled(counts.where(F.col("_n") > capacity).select(F.col("_bucket").alias("_slot")))
    if depth == 64 or not full.head(1):
        return Directory(depth, None)
    left = settled(keys.withColumn("_slot", _prefix(F.col("_key"), depth)).join(full, "_slot", "left_semi"))
    buckets, at = [], depth
    while True:
        at += 1
        halves = left.groupBy("_slot", _prefix(F.col("_key"), at).alias("bucket")).agg(F.count(F.lit(1)).alias("_n"))
        halves = settled(halves.withColumn("depth", F.lit(at)))
        fits = (F.col("_n") <= capacity) | (F.col("depth") == 64)
        buckets.append(halves.where(fits))
        still = halves.where(~fits).select("bucket")
        if not still.head(1):
            break
        left = settled(left.withColumn("bucket", _prefix(F.col("_key"), at)).join(still, "bucket", "left_semi").drop("bucket"))
    splits = buckets[0]
    for more in buckets[1:]:
        splits = splits.unionByName(more)
    by_slot = splits.groupBy("_slot").agg(F.collect_list(F.struct("bucket", "depth")).alias("_prefixes"))
    return Directory(depth, settled(by_slot))


def chains(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The entries of the index: ``(_bucket, _key, _text, _sha, _keep, _size, _salt, _ids)``.

    ``rows`` has ``(_id, _key, _text)``. Each row finds its bucket through the directory and is dealt to the bucket's
    owner, which chains the different texts of a key: texts are equal if their bytes are. An entry of the chain
    has the smallest id, the number of rows, and the sorted ids. Texts are shuffled once, to their owner. A key with
    a large share of all rows is dealt to several owners by the hash of the id, so its texts come in several entries,
    with their text; those of all other keys are whole and leave their text behind.
    """
    spark = rows.sparkSession
    counts = settled(rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_rows")))
    index = directory(counts.select("_key"), capacity)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    # At most four keys for each partition have so many rows, so the list may be broadcast.
    share = max(HOT_ROWS, total // (4 * partitions))
    hot = counts.where(F.col("_rows") > share).select("_key", F.ceil(F.col("_rows") / share).cast("int").alias("_salts"))
    placed = index.place(rows).join(F.broadcast(hot), "_key", "left")
    # Rows without id are told apart by the task that reads them.
    spread = F.coalesce(F.hash("_id"), F.spark_partition_id())
    salt = F.when(F.col("_salts").isNull(), -1).otherwise(F.pmod(spread, F.col("_salts")))
    dealt = placed.withColumn("_salt", salt).drop("_salts").repartition("_bucket", "_salt")
    entries = dealt.groupBy("_bucket", "_salt", "_key", "_text").agg(
        F.min("_id").alias("_keep"), F.count(F.lit(1)).alias("_size"), F.sort_array(F.collect_list(F.struct("_id"))).alias("_ids")
    )
    whole = F.when(F.col("_salt") >= 0, F.col("_text")).alias("_text")
    return entries.select("_bucket", "_key", whole, F.sha2("_text", 256).alias("_sha"), "_keep", "_size", "_salt", "_ids")


def build_index(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The `chains` as a table in the shared folder: every owner writes the buckets it has."""
    return settled(chains(rows, capacity))


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    hash_bits: int = 64,
) -> DataFrame:
    """One row per row of ``docs``: ``(id_column, keep_id, group_size, kept, text_sha256)``.

    Texts are equal when their bytes are, after every run of white space became one space; null counts
    as empty. Of equal texts the smallest id stays. Null ids come after all others, and if a group has
    no other, one of its rows stays with a null ``keep_id``. Rows that repeat both id and text are
    counted in ``group_size``, and one of them stays. Other columns are not read.

    The result is read off the chains of the index (`build_index`); the entries that a hot text has with several
    owners, one row each, are compared by their bytes once more and added up.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("_id"), normalised(F.col(f"`{text_column}`")).alias("_text"))
    index = build_index(rows.select("_id", hash_key(F.col("_text"), hash_bits).alias("_key"), "_text"), capacity)
    single = index.where(F.col("_salt") < 0).withColumn("_first", F.lit(True)).drop("_text")
    parts = index.where(F.col("_salt") >= 0)
    text = ["_bucket", "_key", "_text"]
    merged = parts.groupBy(*text).agg(F.min("_keep").alias("_all_keep"), F.sum("_size").alias("_all_size"), F.min("_salt").alias("_first_salt"))
    spread = parts.join(merged, text).select(
        "_bucket", "_key", "_sha", F.col("_all_keep").alias("_keep"), F.col("_all_size").alias("_size"), "_salt", "_ids",
        # A text without any id keeps a row of one of its entries.
        (F.col("_all_keep").isNotNull() | (F.col("_salt") == F.col("_first_salt"))).alias("_first"),
    )
    found = single.unionByName(spread).select("_keep", "_size", "_sha", "_first", "_ids", F.posexplode("_ids").alias("_at", "_row"))
    before = F.get("_ids", F.col("_at") - 1)["_id"]
    id_ = F.col("_row._id")
    kept = F.col("_first") & same(id_, F.col("_keep")) & ((F.col("_at") == 0) | ~same(before, F.col("_keep")))
    return found.select(
        id_.alias(id_column), F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"), kept.alias("kept"), F.col("_sha").alias("text_sha256")
    )
