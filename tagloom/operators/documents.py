"""Id-keyed label documents: search, upsert, and label additions and removals.

A document state has one row per ``id`` and a nullable comma-separated ``labels`` text; null means
the document has no labels field. Every update takes a state and returns the next one. Changes
without an id belong to no document and are left out, so running an update again adds none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators.joins import count_repeats
from tagloom.operators.tags import tokens


def _text_array(ids: Sequence[str]) -> Column:
    return F.array(*[F.lit(i) for i in ids]).cast("array<string>")


def _has_any(ids: Sequence[str]) -> Column:
    return F.coalesce(F.arrays_overlap(tokens(F.col("labels")), _text_array(ids)), F.lit(False))


def docs_with_any_label(docs: DataFrame, label_ids: Sequence[str]) -> DataFrame:
    return docs.where(_has_any(label_ids))


def docs_with_label(docs: DataFrame, label_id: str) -> DataFrame:
    return docs.where(F.array_contains(tokens(F.col("labels")), label_id))


def doc_projection(
    source: DataFrame, id_column: str, other_columns: str | None, partition_field: str, period: str
) -> DataFrame:
    """The documents of one period: the id, and the ``#``-listed other columns if any."""
    names = [id_column]
    if other_columns and other_columns.strip():
        names += other_columns.split("#")
    return source.where(F.col(partition_field) == F.lit(period)).select(*names)


def latest_by_key(df: DataFrame, key: str | Sequence[str], order: Column, drop: Sequence[str] = ()) -> DataFrame:
    """One row per key: the one that comes last in ``order``. Columns to ``drop`` do not travel with the rows."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c not in drop]
    if not rest:
        return df.select(*keys).distinct()
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


def doc_upsert(
    state: DataFrame, docs: DataFrame, order: Column | None = None, order_columns: Sequence[str] = ()
) -> DataFrame:
    """Store documents by id: a new one replaces the whole old one, others stay.

    The result has the fields of both, null where a document does not have them. ``order`` says which of
    several documents of one id is the last, and ``order_columns`` are columns only there for it, no fields;
    without ``order`` ids must be unique. A document without id cannot be stored and is left out. One pass over the new
    documents and one join.
    """
    new = docs.where(F.col("id").isNotNull())
    fields = [c for c in docs.columns if c != "id"]
    if order is not None:
        fields = [c for c in fields if c not in order_columns]
        new = latest_by_key(new.select("id", *fields, order.alias("_order")), "id", F.col("_order"), drop=["_order"])
    both = [c for c in state.columns if c != "id"] + [c for c in fields if c not in state.columns]
    old = state.select("id", *[F.col(c).alias(f"_old_{c}") for c in state.columns if c != "id"])
    joined = old.join(new.select("id", F.lit(True).alias("_new"), *[F.col(c).alias(f"_new_{c}") for c in fields]), "id", "full_outer")

    def value(c: str) -> Column:
        fresh = F.col(f"_new_{c}") if c in fields else F.lit(None)
        return F.when(F.col("_new"), fresh).otherwise(F.col(f"_old_{c}") if c in state.columns else F.lit(None)).alias(c)

    return joined.select("id", *[value(c) for c in both])


def _merge(state: DataFrame, delta: DataFrame, appended: Column) -> DataFrame:
    # appended: the next text of a document that has labels, from `labels` and `delta`. A document needs an id.
    joined = state.withColumn("_doc", F.lit(True)).join(delta.where(F.col("id").isNotNull()), "id", "full_outer")
    exists, has_labels, changed = F.col("_doc").isNotNull(), F.col("labels").isNotNull(), F.col("delta").isNotNull()
    return joined.select(
        "id",
        F.when(~exists, F.col("delta"))
        .when(has_labels & changed, appended)
        .otherwise(F.col("labels"))
        .alias("labels"),
    )


def labels_append(state: DataFrame, delta: DataFrame) -> DataFrame:
    """Append each delta text to its document, without looking for repeats.

    A document without labels field stays as it is, a missing document is inserted, an empty delta
    changes nothing. Several deltas of an id are appended in text order; equal ones are counted before
    the shuffle and written out only in the document, which has to hold them all.
    """
    counted = count_repeats(delta.where(F.col("labels") != "").select("id", "labels"), "copies")
    texts = F.sort_array(F.collect_list(F.struct("labels", "copies")))
    repeated = F.flatten(F.transform("texts", lambda t: F.array_repeat(t["labels"], t["copies"].cast("int"))))
    by_id = counted.groupBy("id").agg(texts.alias("texts")).select("id", F.array_join(repeated, ",").alias("delta"))
    return _merge(state, by_id, F.concat_ws(",", "labels", "delta"))


def labels_append_one(state: DataFrame, ids: DataFrame, label_id: str) -> DataFrame:
    """Append one label to the documents of all ``ids``."""
    delta = ids.select("id").distinct().withColumn("delta", F.lit(label_id))
    return _merge(state, delta, F.concat_ws(",", "labels", "delta"))


def labels_add(state: DataFrame, delta: DataFrame) -> DataFrame:
    """Like `labels_append`, but each label is added at most once, so it can be run again."""
    by_id = (
        delta.where(F.col("labels") != "")
        .select("id", F.explode(tokens(F.col("labels"))).alias("label"))
        .distinct()
        .groupBy("id")
        .agg(F.sort_array(F.collect_list("label")).alias("added"))
        .withColumn("delta", F.array_join("added", ","))
    )
    missing = F.array_except("added", tokens(F.col("labels")))
    appended = F.concat_ws(",", F.nullif("labels", F.lit("")), F.nullif(F.array_join(missing, ","), F.lit("")))
    return _merge(state, by_id, appended)


def _without(labels: Column, ids: Sequence[str]) -> Column:
    return F.array_join(F.filter(tokens(labels), lambda label: ~label.isin(list(ids))), ",")


def labels_remove(state: DataFrame, label_id: str) -> DataFrame:
    """Take one label out of every document that has it; whole labels only."""
    return state.withColumn("labels", _without(F.col("labels"), [label_id]))


def labels_remove_many(state: DataFrame, label_ids: Sequence[str]) -> DataFrame:
    """Take all given labels out of every document."""
    return state.withColumn("labels", _without(F.col("labels"), label_ids))


def labels_remove_tail(state: DataFrame, removals: DataFrame) -> DataFrame:
    """Take each id's label out of its document, except where it is the first one.

    ``removals`` is ``(id, label)``. A document without labels field or without removal stays as it is,
    and a missing document is inserted with the label.
    """
    by_id = removals.distinct().groupBy("id").agg(F.sort_array(F.collect_list("label")).alias("removed"))
    by_id = by_id.withColumn("delta", F.array_join("removed", ","))
    items = tokens(F.col("labels"))
    kept = F.filter(items, lambda label, i: (i == 0) | ~F.array_contains(F.col("removed"), label))
    return _merge(state, by_id, F.array_join(kept, ","))


def labels_compact(state: DataFrame) -> DataFrame:
    """Remove empty items from the labels."""
    return state.withColumn(
        "labels", F.array_join(F.filter(tokens(F.col("labels")), lambda label: label != ""), ",")
    )


def update_documents(
    state: DataFrame, action: str, delta: DataFrame | None = None, label_id: str | None = None
) -> DataFrame:
    """``add`` the labels of ``delta`` or ``delete`` one label; the action ignores case."""
    match action.upper():
        case "ADD" if delta is not None:
            return labels_append(state, delta)
        case "DELETE" if label_id:
            return labels_remove(state, label_id)
    raise ValueError(f"cannot update documents: action {action!r} needs a delta (add) or a label (delete)")
