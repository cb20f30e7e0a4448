"""An index of documents by label, kept in a table with one partition for each label.

A posting is ``(id, version, live)``. An update appends the postings of the labels that documents got (live) or lost
(not live); the posting with the largest version counts. A search reads the partitions of the labels asked for and
nothing else. `compact` folds the versions of labels that were updated often.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators.tags import tokens

#: The partition is the label after this character, as an empty partition value would read as null.
_MARK = "_"
LABEL = "label"


def _partition(label: str) -> str:
    return _MARK + label


def _labels(column: Column) -> Column:
    return F.coalesce(F.array_distinct(tokens(column)), F.array().cast("array<string>"))


def _write(postings: DataFrame, table: str) -> None:
    # A rebalance, not a shuffle by label: a label with most of the postings is written by many tasks.
    spark = postings.sparkSession
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} (id STRING, version BIGINT, live BOOLEAN, {LABEL} STRING) USING orc PARTITIONED BY ({LABEL})"
    )
    postings.select("id", "version", "live", LABEL).hint("rebalance", LABEL).write.insertInto(table)


def build_postings(docs: DataFrame, table: str, version: int = 0) -> None:
    """Index all labels of all documents with an id in a new table."""
    docs.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    rows = docs.where(F.col("id").isNotNull()).select(F.col("id").cast("string").alias("id"), F.explode(_labels(F.col("labels"))).alias("_label"))
    _write(rows.distinct().select("id", F.lit(version).cast("long").alias("version"), F.lit(True).alias("live"), F.concat(F.lit(_MARK), "_label").alias(LABEL)), table)


def posting_changes(old: DataFrame, changes: DataFrame) -> DataFrame:
    """``(id, live, label)``: what the ``changes`` of `changes.change_set` (with ``labels``) do to the labels of ``old``.

    Only documents that changed are looked up in ``old``.
    """
    before = old.select("id", F.col("labels").alias("_old"))
    both = changes.select("id", "labels").join(before, "id", "left")
    was, now = _labels(F.col("_old")), _labels(F.col("labels"))
    change = F.concat(
        F.transform(F.array_except(now, was), lambda x: F.struct(x.alias("label"), F.lit(True).alias("live"))),
        F.transform(F.array_except(was, now), lambda x: F.struct(x.alias("label"), F.lit(False).alias("live"))),
    )
    return both.select(F.col("id").cast("string").alias("id"), F.explode(change).alias("_change")).select("id", "_change.live", "_change.label")


def update_postings(table: str, changes: DataFrame, version: int) -> None:
    """Append the `posting_changes` of one update. Versions grow; an update that is run again with its version adds nothing new."""
    _write(changes.select("id", F.lit(version).cast("long").alias("version"), "live", F.concat(F.lit(_MARK), LABEL).alias(LABEL)), table)


def _live(postings: DataFrame) -> DataFrame:
    last = postings.groupBy(LABEL, "id").agg(F.max_by("live", "version").alias("live"), F.max("version").alias("version"))
    return last.where("live")


def labelled_ids(spark: SparkSession, table: str, label_ids: Sequence[str]) -> DataFrame:
    """``(id, label)``: the documents that have one of the labels now; reads the partitions of these labels only."""
    wanted = spark.read.table(table).where(F.col(LABEL).isin([_partition(i) for i in label_ids]))
    return _live(wanted).select("id", F.substring(LABEL, len(_MARK) + 1, 1 << 30).alias("label"))


def ids_with_any_label(spark: SparkSession, table: str, label_ids: Sequence[str]) -> DataFrame:
    return labelled_ids(spark, table, label_ids).select("id").distinct()


def ids_with_all_labels(spark: SparkSession, table: str, label_ids: Sequence[str]) -> DataFrame:
    """The documents that have all of the labels; counted by id, so no posting list meets another in one place."""
    wanted = sorted(set(label_ids))
    counts = labelled_ids(spark, table, wanted).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") == len(wanted)).select("id")


def search_documents(docs: DataFrame, table: str, label_ids: Sequence[str]) -> DataFrame:
    """The documents that have one of the labels, as `documents.docs_with_any_label` finds them by reading all texts."""
    return docs.join(ids_with_any_label(docs.sparkSession, table, label_ids), "id", "left_semi")


def compact(spark: SparkSession, table: str, scratch: str, label_ids: Sequence[str] | None = None) -> None:
    """Fold the postings of the labels, or of all, into the live ones.

    ``scratch`` is a table that does not exist; it holds the folded postings until every partition is replaced, so a
    failure at any place leaves postings that say the same. Labels without documents lose their partition.
    """
    postings = spark.read.table(table)
    if label_ids is not None:
        postings = postings.where(F.col(LABEL).isin([_partition(i) for i in label_ids]))
    _live(postings).select("id", "version", "live", LABEL).write.format("orc").saveAsTable(scratch)
    folded = spark.read.table(scratch)
    touched = [_partition(i) for i in label_ids] if label_ids is not None else None
    before = {r[0] for r in spark.read.table(table).select(LABEL).distinct().collect()}
    left = {r[0] for r in folded.select(LABEL).distinct().collect()}
    mode = "spark.sql.sources.partitionOverwriteMode"
    was = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # only the partitions that are written are replaced
    try:
        folded.hint("rebalance", LABEL).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, was)
    for label in sorted(before - left):
        if touched is None or label in touched:
            value = label.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({LABEL} = '{value}')")
    spark.sql(f"DROP TABLE {scratch}")
