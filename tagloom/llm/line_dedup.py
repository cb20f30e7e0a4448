"""Lines that many documents share, dropped from all of them but one."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import SPACES, let, packed, same, settled

MIN_CHARS, MIN_DOCUMENTS = 20, 3

# Characters that `lower` may change although they are not A-Z.
_OTHER_UPPER = r"[\p{javaUpperCase}\p{javaTitleCase}&&[^A-Z]]"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased and nothing else.

    `lower` is many times faster than `translate` and does the same where no other letter has a case.
    """
    line = F.btrim(line, F.lit(SPACES))
    only_ascii = F.octet_length(line) == F.char_length(line)
    return F.when(only_ascii | ~line.rlike(_OTHER_UPPER), F.lower(line)).otherwise(
        F.translate(line, string.ascii_uppercase, string.ascii_lowercase)
    )


def _hashed(key: Column) -> list[Column]:
    # 128 bits: at 10^12 lines, 64 would let thousands of different lines meet.
    return [F.xxhash64(key).alias("_h1"), F.xxhash64(F.lit(1), key).alias("_h2")]


def shared_lines(docs: DataFrame, id_column: str, text_column: str, min_chars: int, min_documents: int) -> DataFrame:
    """``(_h1, _h2, _last)``: each line key of enough documents, with the largest id that holds it.

    A document gives each of its keys once and keys are counted before the shuffle, so a line that
    every document holds is one row per task.
    """
    key = F.transform(lines_of(F.col(text_column)), line_key)
    long_enough = F.filter(key, lambda k: F.char_length(k) >= min_chars)
    return (
        docs.select(F.col(id_column).alias("_id"), F.explode(F.array_distinct(long_enough)).alias("_key"))
        .select("_id", *_hashed(F.col("_key")))
        .groupBy("_h1", "_h2")
        .agg(F.count(F.lit(1)).alias("_n"), F.max("_id").alias("_last"))
        .where(F.col("_n") >= min_documents)
        .drop("_n")
    )


def _without(lines: Column, dropped: Column) -> Column:
    """The lines between the sorted positions ``dropped``, cut out as slices: linear in the lines."""

    def piece(i):
        start = F.when(i == 0, 0).otherwise(F.get(dropped, i - 1) + 1)
        end = F.coalesce(F.get(dropped, i), F.size(lines))
        return F.slice(lines, start + 1, end - start)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(dropped)), piece))


def line_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    r"""``docs`` with the text rid of shared lines, and ``_n_lines`` and ``_n_dropped``.

    Texts are split at ``\n``. A line's key has no white space at its ends and A-Z in lower case. A key
    of at least ``min_chars`` code points in at least ``min_documents`` documents loses all its lines
    except those of the largest id that holds it; the other lines stay in order.

    Null or empty texts are one empty line; their text becomes empty. Each row is a document: rows that
    repeat an id count separately, and if theirs is the largest id, each keeps the line. Null ids come
    before all others; a key that only documents without id hold stays in all of them. Other columns
    pass through; columns with the names of the counts are replaced. An empty table gives an empty table.

    Only hashes, ids and positions are exploded and shuffled by line; the texts are shuffled once, to
    meet the positions to drop. A line with a large share of all rows is one row of the counts; in the
    join back, adaptive execution splits the partition it makes large.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    work = packed(docs, F.col(id_column).alias("_id"), text.alias("_text"), F.xxhash64(F.col(id_column), text).alias("_mark"))
    text = F.col("_text")
    # Written, as adaptive execution splits a hot line's partition only if both sides come from a shuffle.
    shared = settled(shared_lines(docs, id_column, text_column, min_chars, min_documents))
    positions = (
        work.select(
            "_id", "_mark", F.posexplode(F.transform(lines_of(text), line_key)).alias("_pos", "_key")
        )
        .where(F.char_length("_key") >= min_chars)
        .select("_id", "_mark", "_pos", *_hashed(F.col("_key")))
    )
    # The mark tells rows with one id apart; equal rows give the same positions, hence the set.
    drops = (
        positions.join(shared, ["_h1", "_h2"])
        .where(~same(F.col("_id"), F.col("_last")))
        .groupBy(F.col("_id").alias("_of"), F.col("_mark").alias("_with"))
        .agg(F.sort_array(F.collect_set("_pos")).alias("_dropped"))
        .hint("shuffle_hash")  # a small part of the texts' size; the texts need no sort
    )
    kept = F.when(F.col("_dropped").isNull(), text).otherwise(
        let(lines_of(text), lambda lines: F.array_join(_without(lines, F.col("_dropped")), "\n"))
    )
    joined = work.join(drops, same(F.col("_id"), F.col("_of")) & (F.col("_mark") == F.col("_with")), "left")
    columns = [c for c in docs.columns if c not in ("_n_lines", "_n_dropped")]
    return joined.select(
        *[kept.alias(c) if c == text_column else F.col("_row").getField(c).alias(c) for c in columns],
        F.size(lines_of(text)).cast("long").alias("_n_lines"),
        F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("_n_dropped"),
    )
