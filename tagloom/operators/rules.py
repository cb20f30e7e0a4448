"""Rules: from catalog rows to native predicates and label columns.

A rule body is JSON, ``{field: {"value": ..., "type": "single" | "list" | "range"}}``. All fields of
a body must match; rows that share a label id are alternatives. Rules compile to Column expressions
once, on the driver, so Catalyst sees plain comparisons: pushed down, pruned and code-generated.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.text import LABEL_PREFIX


class RuleError(ValueError):
    """A rule that cannot be compiled."""


@dataclass(frozen=True)
class Condition:
    field: str
    kind: str
    value: str


@dataclass(frozen=True)
class Rule:
    """One catalog row."""

    id: str
    value: str
    source_name: str | None = None
    source_label: str | None = None
    partition_field: str | None = None

    def conditions(self) -> list[Condition]:
        try:
            body = json.loads(self.value or "")
            conditions = [Condition(f, str(c["type"]).upper(), str(c["value"])) for f, c in body.items()]
        except (ValueError, KeyError, TypeError, AttributeError) as e:
            raise RuleError(f"label {self.id}: unreadable rule body {self.value!r}") from e
        if not conditions:
            raise RuleError(f"label {self.id}: a rule needs at least one field")
        return conditions


def _column(field: str) -> Column:
    return F.col("`" + field.replace("`", "``") + "`")


def match_single(x: Column, value: str) -> Column:
    """Text equality; a double 23.0 reads as ``23.0``."""
    return x.cast("string") == F.lit(value)


def match_list(x: Column, value: str) -> Column:
    """Text membership in a comma-separated list; items are not trimmed."""
    items = value.split(",")
    while len(items) > 1 and items[-1] == "":
        items.pop()
    if items == [""] and value:
        return F.lit(False)
    return x.cast("string").isin(items)


#: A bound of an interval: a decimal number, also with an exponent, or Infinity; spaces around it do not matter.
NUMBER = r"[ \t]*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|Infinity)[ \t]*"
INTERVAL = rf"(.)({NUMBER}),({NUMBER})(.)"


def match_range(x: Column, value: str) -> Column:
    """Numeric interval ``(a,b)``, ``[a,b)``, ``(a,b]`` or ``[a,b]``; text that is no number never matches."""
    interval = re.fullmatch(INTERVAL, value, re.DOTALL)
    if not interval:
        raise RuleError(f"unreadable range {value!r}")
    left, low, high, right = interval[1], float(interval[2]), float(interval[3]), interval[4]
    if left not in ("(", "[") or right not in (")", "]"):
        raise RuleError(f"unknown bracket in range {value!r}")
    if low > high or (low == high and left + right == "()"):
        raise RuleError(f"reversed range {value!r}")
    number = x.try_cast("double")
    above = number >= F.lit(low) if left == "[" else number > F.lit(low)
    below = number <= F.lit(high) if right == "]" else number < F.lit(high)
    return above & below


_MATCHERS = {"SINGLE": match_single, "LIST": match_list, "RANGE": match_range}


def condition_predicate(condition: Condition) -> Column:
    matcher = _MATCHERS.get(condition.kind)
    if matcher is None:
        raise RuleError(f"unknown match type {condition.kind!r}")
    return matcher(_column(condition.field), condition.value)


def rule_predicate(rule: Rule) -> Column:
    """All conditions of one catalog row."""
    return reduce(lambda a, b: a & b, [condition_predicate(c) for c in rule.conditions()])


RulesById = Mapping[str, Sequence[Rule]]


def rules_by_id(rules: Iterable[Rule] | RulesById) -> RulesById:
    if isinstance(rules, Mapping):
        return rules
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        index.setdefault(rule.id, []).append(rule)
    return index


def label_column(label_id: str, rules: Iterable[Rule] | RulesById) -> Column:
    """``label_<id>``: the id where any catalog row of that id matches, else null."""
    alternatives = [rule_predicate(r) for r in rules_by_id(rules).get(label_id, ())]
    if not alternatives:
        raise RuleError(f"label {label_id}: no rule")
    matched = reduce(lambda a, b: a | b, alternatives)
    return F.when(matched, F.lit(label_id)).alias(LABEL_PREFIX + label_id)


def label_columns(label_ids: Sequence[str], rules: Iterable[Rule] | RulesById) -> list[Column]:
    index = rules_by_id(rules)
    return [label_column(i, index) for i in label_ids]


def rule_conditions(catalog: DataFrame) -> DataFrame:
    """One row per condition of every rule body, with what is wrong with it in ``error``.

    A body that cannot be read, or has no field, is one row without a field.
    """
    body = F.from_json("value", "map<string,struct<value:string,type:string>>")
    parsed = catalog.select("id", "source_name", F.explode_outer(body).alias("field", "rule"))
    kind, value = F.upper("rule.type"), F.col("rule.value")
    error = (
        F.when(F.col("field").isNull(), "unreadable rule body")
        .when(kind.isNull(), "no match type")
        .when(~kind.isin(list(_MATCHERS)), "unknown match type")
        .when(value.isNull(), "no value")
    )
    return parsed.select(
        "id", "source_name", "field", kind.alias("match_type"), value.alias("match_value"), error.alias("error")
    )
