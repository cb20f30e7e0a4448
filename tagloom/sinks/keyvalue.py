"""Key-value entries: the final state a key-value store would hold after the export, alone or into keys that are live."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators.indexing import global_positions, last_position
from tagloom.operators.joins import repeat_rows
from tagloom.sinks.scratch import stored


def _columns(spec: str) -> list[Column]:
    return [F.col(c).cast("string") for c in spec.split("#")]


def _joined(spec: str, separator: str) -> Column:
    return F.concat_ws(separator, *_columns(spec))


def kv_string(df: DataFrame, key_column: str, value: str, order: Column) -> DataFrame:
    """``(key, value)``: the ``#``-listed columns joined by comma; the last write of a key wins."""
    writes = df.select(F.col(key_column).cast("string").alias("key"), _joined(value, ",").alias("value"), order.alias("o"))
    return writes.groupBy("key").agg(F.max_by("value", "o").alias("value"))


def kv_hash(df: DataFrame, key: str, field: str, value: str, order: Column) -> DataFrame:
    """``(key, field, value)`` under one constant key; the last write of a field wins."""
    writes = df.select(_joined(field, "_").alias("field"), _joined(value, "_").alias("value"), order.alias("o"))
    last = writes.groupBy("field").agg(F.max_by("value", "o").alias("value"))
    return last.select(F.lit(key).alias("key"), "field", "value")


def kv_set(df: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, member)``: the distinct members."""
    return df.select(_joined(value, ",").alias("member")).distinct().select(F.lit(key).alias("key"), "member")


def kv_list(df: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """``(key, pos, element)``: every row is pushed to the left in ``order``, so the last one is at 0."""
    pushed = df.select(*order, _joined(value, ",").alias("element"))
    placed = global_positions(pushed, order)
    first = F.col("total") - 1 - last_position(F.col("start"), F.col("copies"))
    blocks = placed.select("element", "copies", first.alias("first"))
    numbered = repeat_rows(blocks, F.col("copies"), [F.col("element"), F.col("first")], position="offset")
    return numbered.select(F.lit(key).alias("key"), (F.col("first") + F.col("offset")).alias("pos"), "element")


def kv_zset(df: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """``(key, member, score)``: scores 0, 1, 2, ... in ``order``; a repeated member keeps its last score."""
    added = df.select(*order, _joined(value, ",").alias("member"))
    placed = global_positions(added, order)
    last = F.max(last_position(F.col("start"), F.col("copies"))).cast("double").alias("score")
    return placed.groupBy("member").agg(last).select(F.lit(key).alias("key"), "member", "score")


def key_value_entries(
    df: DataFrame,
    kind: str,
    *,
    key: str,
    value: str,
    order: Sequence[str],
    hash_field: str | None = None,
    hash_value: str | None = None,
) -> DataFrame:
    """Entries of the named kind: string, hash, set, list or sorted set, ignoring case.

    ``key`` names the key column for strings and is the constant key otherwise.
    """
    last = F.struct(*order)
    match "".join(kind.upper().split()):
        case "STRING":
            return kv_string(df, key, value, last)
        case "HASH" if hash_field and hash_value:
            return kv_hash(df, key, hash_field, hash_value, last)
        case "SET":
            return kv_set(df, key, value)
        case "LIST":
            return kv_list(df, key, value, order)
        case "SORTEDSET":
            return kv_zset(df, key, value, order)
    raise ValueError(f"unknown key-value type {kind!r}, or a hash without field and value columns")


def _replaced(state: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    written = new.select(*keys, F.col(value).alias("_new"), F.lit(True).alias("_written"))
    merged = F.when(F.col("_written"), F.col("_new")).otherwise(F.col(value)).alias(value)
    return state.select(*keys, value).join(written, keys, "full_outer").select(*keys, merged)


def merge_strings(state: DataFrame, new: DataFrame) -> DataFrame:
    """``(key, value)``: new values replace those of the same key, all others stay."""
    return _replaced(state, new, ["key"], "value")


def merge_hashes(state: DataFrame, new: DataFrame) -> DataFrame:
    """``(key, field, value)``: new values replace those of the same field, all others stay."""
    return _replaced(state, new, ["key", "field"], "value")


def merge_zsets(state: DataFrame, new: DataFrame) -> DataFrame:
    """``(key, member, score)``: new scores replace those of the same member, all others stay."""
    return _replaced(state, new, ["key", "member"], "score")


def merge_sets(state: DataFrame, new: DataFrame) -> DataFrame:
    """``(key, member)``: the members of either. The old ones pass through; only new ones look for themselves."""
    members = ["key", "member"]
    return state.select(*members).unionByName(new.select(*members).distinct().join(state.select(*members), members, "left_anti"))


def merge_lists(state: DataFrame, new: DataFrame) -> DataFrame:
    """``(key, pos, element)``: new elements take the first positions, the old ones of their key move up by as many.

    Pushed again, elements are there twice, as in the store. One row for each key of ``new`` is joined to the state;
    the new elements are stored first, as they are counted and read.
    """
    new = stored(new.select("key", "pos", "element"))
    pushed = new.groupBy("key").agg(F.count(F.lit(1)).alias("_pushed"))
    moved = state.join(pushed, "key", "left").select("key", (F.col("pos") + F.coalesce("_pushed", F.lit(0))).alias("pos"), "element")
    return moved.unionByName(new.select("key", "pos", "element"))


def merge_entries(state: DataFrame, new: DataFrame, kind: str) -> DataFrame:
    """The entries of a store that holds ``state`` after those of ``new``, of the kinds of `key_value_entries`.

    Strings, hashes, sets and sorted sets may be merged again with the same result; lists grow.
    """
    kinds = {"STRING": merge_strings, "HASH": merge_hashes, "SET": merge_sets, "LIST": merge_lists, "SORTEDSET": merge_zsets}
    merge = kinds.get("".join(kind.upper().split()))
    if merge is None:
        raise ValueError(f"unknown key-value type {kind!r}")
    return merge(state, new)
