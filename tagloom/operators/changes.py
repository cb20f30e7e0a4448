"""What changed between two states of id-keyed rows, and a state brought up to date by it.

An update then touches the documents that differ, not all of them. The old side of a comparison is reduced to its id
and a digest before the shuffle, so its texts do not travel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERTED, CHANGED, GONE = "inserted", "changed", "gone"


def row_digest(columns: list[str]) -> Column:
    """128 bits of the values of a row. Nulls are marked, as a hash alone skips them."""
    values = [x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.struct(F.xxhash64(F.lit(0), *values).alias("a"), F.xxhash64(F.lit(1), *values).alias("b"))


def one_per_id(df: DataFrame, id_column: str = "id") -> DataFrame:
    """Rows with an id, of equal ids the one that is smallest in the order of the other columns."""
    rest = [c for c in df.columns if c != id_column]
    if not rest:
        return df.where(F.col(id_column).isNotNull()).distinct()
    rows = df.where(F.col(id_column).isNotNull()).groupBy(id_column).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_row"))
    return rows.select(id_column, *[F.col("_row").getField(c).alias(c) for c in rest])


def change_set(old: DataFrame, new: DataFrame, id_column: str = "id", unique: bool = False) -> DataFrame:
    """``(id, change, columns of new)``: rows inserted, changed (with their new values) and gone (with nulls).

    Equal rows are left out; null equals null. Columns are compared by name, and a column that ``old`` does not have
    makes every row that has a value in it changed. Rows without id are in no state. Of rows that share an id the
    smallest counts (`one_per_id`); ``unique`` says that there are none and saves that step.
    """
    rest = [c for c in new.columns if c != id_column]
    kept = old.select(id_column, *[F.col(f"`{c}`") if c in old.columns else F.lit(None).cast(new.schema[c].dataType).alias(c) for c in rest])
    kept, new = (df.where(F.col(id_column).isNotNull()) if unique else one_per_id(df, id_column) for df in (kept, new))
    before = kept.select(id_column, row_digest(rest).alias("_before"))
    after = new.withColumn("_after", row_digest(rest))
    both = before.join(after, id_column, "full_outer")
    change = (
        F.when(F.col("_before").isNull(), INSERTED).when(F.col("_after").isNull(), GONE).when(F.col("_before") != F.col("_after"), CHANGED)
    )
    return both.withColumn("change", change).where(F.col("change").isNotNull()).select(id_column, "change", *[F.col(f"`{c}`") for c in rest])


def apply_changes(state: DataFrame, changes: DataFrame, id_column: str = "id") -> DataFrame:
    """``state`` after ``changes``: gone rows leave, changed and inserted ones have their new values.

    Columns that the changes do not have stay as they are in changed rows. One join on the id; a state that is
    bucketed by it is not shuffled. Applying the same changes again changes nothing.
    """
    rest = [c for c in changes.columns if c not in (id_column, "change")]
    both = [c for c in state.columns if c != id_column] + [c for c in rest if c not in state.columns]
    new = changes.select(id_column, "change", *[F.col(f"`{c}`").alias(f"_new_{i}") for i, c in enumerate(rest)])
    joined = state.join(new, id_column, "full_outer").where(~F.col("change").eqNullSafe(GONE))

    def value(c: str) -> Column:
        old = F.col(f"`{c}`") if c in state.columns else F.lit(None)
        return (F.when(F.col("change").isNull(), old).otherwise(F.col(f"_new_{rest.index(c)}")) if c in rest else old).alias(c)

    return joined.select(id_column, *[value(c) for c in both])
