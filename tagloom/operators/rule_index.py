"""Rules matched by an index: a row costs the logarithm of the rules, and the plan does not grow with them.

`rules.label_columns` writes every rule into the plan, which is best for some hundred rules of a source. Here rules stay
rows. A value is reduced to its place among the values that rules name (a binary search, `place_among`); rows with the
same places match the same rules, so rules are matched once for each combination of places that occurs, by
joins, and the labels are joined back to the rows.

* An interval's bounds cut the numbers of a field into elementary intervals, numbered 0 to 2m for m bounds: odd places
  are the bounds themselves. A condition is a range of places, whatever its brackets.
* A text condition is a set of places among the texts of the field, the texts themselves in order.
* Each body is looked up by its narrowest condition: its range is covered by aligned blocks of 1, 2, 4, ... places, at
  most two of a size, and a place lies in one block of each size. The join on blocks finds the candidates; their
  other conditions are compared place by place.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators.rules import INTERVAL, RuleError
from tagloom.sinks.scratch import stored

#: The kinds of conditions whose places are numbers and texts.
_NUMBERS, _TEXTS = "number", "text"
#: Bounds or texts of one field. They are one constant of the plan, some 8 MB for a million numbers; more are refused.
MOST_VALUES = 1_000_000


def place_among(value: Column, values: Column, count: int) -> Column:
    """How many of the ``count`` sorted ``values`` are not after ``value``, null for null.

    A binary search as one fold over its steps, ..., 4, 2, 1, so that the expression does not grow with the values.
    """
    steps = F.array(*[F.lit(2**i) for i in reversed(range(max(1, count).bit_length()))])
    found = F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.get(values, at + step - 1) <= value, step).otherwise(0))
    return F.when(value.isNotNull(), found)


@dataclass(frozen=True)
class Dimension:
    """A field as the rules of one kind see it, with its sorted different values."""

    field: str
    kind: str
    values: tuple

    @property
    def count(self) -> int:
        return len(self.values)

    def _constant(self) -> Column:
        """The values as one array that is made once, when the plan is."""
        if self.kind == _NUMBERS:
            # A double reads back from its text as it was.
            return F.split(F.lit(",".join(str(v).replace("inf", "Infinity") for v in self.values)), ",").cast("array<double>")
        return F.from_json(F.lit(json.dumps(self.values)), "array<string>")

    def value(self) -> Column:
        column = F.col("`" + self.field.replace("`", "``") + "`")
        # -0.0 becomes 0.0, and what is no number has no place.
        return F.nullif(column.try_cast("double") + 0.0, F.lit(float("nan"))) if self.kind == _NUMBERS else column.cast("string")

    def place(self, df: DataFrame, name: str, value: Column | None = None) -> DataFrame:
        """The place of this field's value in each row: odd where it is one of the values, null if it has none."""
        values = self._constant()
        df = df.withColumn("_value", self.value() if value is None else value)
        df = df.withColumn(name, place_among(F.col("_value"), values, self.count))
        exact = F.get(values, F.col(name) - 1) == F.col("_value")
        return df.withColumn(name, 2 * F.col(name) - F.when(exact, 1).otherwise(0)).drop("_value")


@dataclass(frozen=True)
class RuleIndex:
    """Compiled rules: the ``dimensions`` they read, and their bodies by the blocks they are looked up in.

    ``lookups``: ``(dimension, level, block, body)``. ``bodies``: ``(body, conditions, ids)``; equal bodies are one, and
    ``ids`` are all labels they stand for.
    """

    dimensions: list[Dimension]
    lookups: DataFrame
    bodies: DataFrame

    @property
    def levels(self) -> int:
        return max((math.ceil(math.log2(2 * d.count + 2)) for d in self.dimensions), default=1)

    def labelled(self, df: DataFrame, column: str = "labels") -> DataFrame:
        """``df`` with the sorted ids of all matching rules as an array, empty where none matches.

        Rows are read twice: for the combinations of places, which are counted out before the shuffle, and to be
        labelled. The rows themselves are shuffled only if the combinations are too many to be broadcast.
        """
        missing = [d.field for d in self.dimensions if d.field not in df.columns]
        if missing:
            raise RuleError(f"rules read fields that the source does not have: {', '.join(sorted(set(missing)))}")
        names = [f"_place{i}" for i in range(len(self.dimensions))]
        placed = df
        for name, dimension in zip(names, self.dimensions):
            placed = dimension.place(placed, name)
        placed = placed.withColumn("_places", F.array(*[F.coalesce(F.col(n), F.lit(-1)) for n in names]).cast("array<int>")).drop(*names)
        found = placed.join(self.matches(placed.select("_places").distinct()), "_places", "left").drop("_places")
        return found.withColumn(column, F.coalesce("_ids", F.array().cast("array<string>"))).drop("_ids")

    def matches(self, combinations: DataFrame) -> DataFrame:
        """``(_places, _ids)``: of distinct arrays of places those that some body matches, with its sorted ids."""
        at = combinations.select("_places", F.posexplode("_places").alias("_dimension", "_place")).where("_place >= 0")
        block = F.expr(f"transform(sequence(0, {self.levels}), k -> struct(k as level, shiftright(_place, k) as block))")
        at = at.select("_places", "_dimension", F.explode(block).alias("_block"))
        at = at.select("_places", "_dimension", F.col("_block.level").alias("_level"), F.col("_block.block").alias("_block"))
        candidates = at.join(self.lookups, ["_dimension", "_level", "_block"]).join(self.bodies, "_body")

        def holds(c: Column) -> Column:
            place = F.get("_places", c["dimension"])
            return F.when(c["among"].isNull(), place.between(c["low"], c["high"])).otherwise(F.array_contains(c["among"], place))

        matched = candidates.where(F.forall("_conditions", holds)).select("_places", F.explode("_ids").alias("_id")).distinct()
        return matched.groupBy("_places").agg(F.sort_array(F.collect_list("_id")).alias("_ids"))


def _conditions(catalog: DataFrame) -> DataFrame:
    """``(_body, _field, _kind, _items, _low, _high, _left, _right, _ids, _error)``, one row per condition of a different body.

    Stored, so that rules are read once; ``_error`` says what is wrong with a condition or its body.
    """
    body = F.from_json("value", "map<string,struct<value:string,type:string>>")
    rows = catalog.select(F.col("id").alias("_id"), "value", F.sha2(F.coalesce("value", F.lit("")), 256).alias("_body"), F.explode_outer(body).alias("_field", "_rule"))
    kind, value = F.upper("_rule.type"), F.col("_rule.value")
    rows = rows.where(F.col("_id").isNotNull()).groupBy("_body", "_field", kind.alias("_type"), value.alias("_text")).agg(F.min("_id").alias("_first"), F.collect_set("_id").alias("_ids"))
    part = lambda i: F.regexp_extract("_text", f"(?s)^{INTERVAL}$", i)
    ranged = F.col("_type") == "RANGE"
    number = lambda i: F.when(ranged, F.trim(part(i)).try_cast("double") + 0.0)
    # A list without its empty items at the end; one of separators only matches nothing.
    items = F.split(F.regexp_replace("_text", ",+$", ""), ",")
    items = F.when(F.col("_type") == "SINGLE", F.array("_text")).when(F.col("_text").rlike("^,+$"), F.array().cast("array<string>")).otherwise(items)
    rows = rows.select(
        "_body", "_field", "_text", "_type", "_first", "_ids", F.when(ranged, _NUMBERS).otherwise(_TEXTS).alias("_kind"), F.when(~ranged, items).alias("_items"),
        number(2).alias("_low"), number(3).alias("_high"), F.when(ranged, part(1)).alias("_left"), F.when(ranged, part(4)).alias("_right"),
    )
    reversed_ = (F.col("_low") > F.col("_high")) | ((F.col("_low") == F.col("_high")) & (F.col("_left") == "(") & (F.col("_right") == ")"))
    error = (
        F.when(F.col("_field").isNull(), "unreadable rule body")
        .when(F.col("_type").isNull(), "no match type")
        .when(~F.col("_type").isin("SINGLE", "LIST", "RANGE"), "unknown match type")
        .when(F.col("_text").isNull(), "no value")
        .when(ranged & (F.col("_low").isNull() | F.col("_high").isNull()), "unreadable range")
        .when(~F.col("_left").isin("(", "[") | ~F.col("_right").isin(")", "]"), "unknown bracket in range")
        .when(reversed_, "reversed range")
    )
    rows = stored(rows.withColumn("_error", error))
    wrong = rows.where(F.col("_error").isNotNull()).select("_first", "_field", "_error", "_text").limit(5).collect()
    if wrong:
        raise RuleError("; ".join(f"label {r['_first']}: {r['_error']} ({r['_field']}: {r['_text']!r})" for r in wrong))
    return rows.drop("_error", "_first", "_type")


def _dimensions(rows: DataFrame) -> list[Dimension]:
    """Every field and kind that conditions read, with its distinct values."""
    values = F.when(F.col("_kind") == _NUMBERS, F.array("_low", "_high").cast("array<string>")).otherwise(F.col("_items"))
    # A null keeps the field of a list without items.
    distinct = stored(rows.select("_field", "_kind", F.explode_outer(values).alias("_value")).distinct())
    out = []
    for r in distinct.groupBy("_field", "_kind").agg(F.count("_value").alias("n")).orderBy("_field", "_kind").collect():
        field, kind, count = r
        if count > MOST_VALUES:
            raise RuleError(f"{count} values of {field!r} in rules; at most {MOST_VALUES} fit one index, so split the catalog by label")
        mine = distinct.where((F.col("_field") == field) & (F.col("_kind") == kind) & F.col("_value").isNotNull())
        value = F.col("_value").try_cast("double") if kind == _NUMBERS else F.col("_value")
        # Sorted by Spark, as it compares them.
        found = mine.agg(F.sort_array(F.collect_list(value)).alias("values")).first()[0]
        out.append(Dimension(field, kind, tuple(found)))
    return out


def rule_index(catalog: DataFrame) -> RuleIndex:
    """The index of all rules of ``catalog`` (``id``, ``value``); rules that share an id are alternatives.

    The meaning is that of `rules.label_columns`. A body that cannot be read is an error, as it is there. Rules are
    read, cut and joined as rows, and kept in the shared folder; the driver gets the names of their fields and their
    different values, `MOST_VALUES` of a field at most.
    """
    rows = _conditions(catalog)
    dimensions = _dimensions(rows)
    placed = []
    for i, d in enumerate(dimensions):
        mine = rows.where((F.col("_field") == d.field) & (F.col("_kind") == d.kind)).withColumn("_dimension", F.lit(i))
        if d.kind == _NUMBERS:
            mine = d.place(d.place(mine, "_from", F.col("_low")), "_to", F.col("_high"))
            mine = mine.withColumn("_from", F.col("_from") + F.when(F.col("_left") == "(", 1).otherwise(0))
            mine = mine.withColumn("_to", F.col("_to") - F.when(F.col("_right") == ")", 1).otherwise(0))
            mine = mine.withColumn("_among", F.lit(None).cast("array<int>")).withColumn("_share", (F.col("_to") - F.col("_from") + 1) / F.lit(2 * d.count + 1))
        else:
            item = d.place(mine.select("_body", "_ids", "_dimension", F.explode_outer("_items").alias("_item")), "_from", F.col("_item"))
            among = F.sort_array(F.collect_set(F.col("_from").cast("int"))).alias("_among")
            mine = item.groupBy("_body", "_ids", "_dimension").agg(among)
            mine = mine.withColumn("_from", F.lit(0)).withColumn("_to", F.lit(-1)).withColumn("_share", F.size("_among") / F.lit(max(1, d.count)))
        placed.append(mine.select("_body", "_ids", "_dimension", F.col("_from").cast("int").alias("_from"), F.col("_to").cast("int").alias("_to"), "_among", "_share"))
    if not placed:
        spark = catalog.sparkSession
        return RuleIndex(
            [], spark.createDataFrame([], "_dimension int, _level int, _block int, _body string"),
            spark.createDataFrame([], "_body string, _conditions array<struct<dimension:int,low:int,high:int,among:array<int>>>, _ids array<string>"),
        )
    conditions = placed[0]
    for more in placed[1:]:
        conditions = conditions.unionByName(more)
    condition = F.struct(F.col("_dimension").alias("dimension"), F.col("_from").alias("low"), F.col("_to").alias("high"), F.col("_among").alias("among"))
    one = F.struct("_share", "_dimension", "_from", "_to", "_among")
    bodies = stored(
        conditions.groupBy("_body").agg(F.collect_list(condition).alias("_conditions"), F.first("_ids").alias("_ids"), F.min(one).alias("_by"))
    )
    by = bodies.select("_body", "_by.*")
    # The aligned blocks of a range of places: at each size at most its first and its last.
    block = F.expr(
        "filter(array(if(_l < _r and _l % 2 = 1, _l, null), if(_l < _r and _r % 2 = 1, _r - 1, null)), b -> b is not null)"
    )
    levels = max(math.ceil(math.log2(2 * d.count + 2)) for d in dimensions)
    ranges = by.where(F.col("_among").isNull()).withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    ranges = ranges.withColumn("_l", F.expr("shiftright(_from + shiftleft(1, _level) - 1, _level)")).withColumn("_r", F.expr("shiftright(_to + 1, _level)"))
    ranges = ranges.select("_dimension", "_level", F.explode(block).alias("_block"), "_body")
    texts = by.select("_dimension", F.lit(0).alias("_level"), F.explode("_among").alias("_block"), "_body")
    return RuleIndex(dimensions, stored(ranges.unionByName(texts)), bodies.drop("_by"))


def tag_by_index(source: DataFrame, catalog: DataFrame, id_column: str) -> DataFrame:
    """``id`` and the comma-separated labels of each row, as `tags.tag_source` gives them, for any number of rules."""
    found = rule_index(catalog).labelled(source, "_labels")
    return found.select(F.col(id_column).cast("string").alias("id"), F.array_join("_labels", ",").alias("labels"))
