"""Text functions over whole columns of comma-separated values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how label columns are named.
LABEL_PREFIX = "label_"


def csv_split(text: Column) -> Column:
    """Split on commas; trailing empty items are dropped and a text of commas only has no items.

    An empty text has one empty item, and a null text gives null.
    """
    items = F.split(F.regexp_replace(text, ",+$", ""), ",")
    return F.when(text.rlike("^,+$"), F.array().cast("array<string>")).otherwise(items)


def csv_join(items: Column) -> Column:
    return F.array_join(items, ",")


def csv_clean_split(text: Column) -> Column:
    """``csv_split`` after removing double quotes and spaces."""
    return csv_split(F.regexp_replace(text, '[" ]', ""))


def csv_prefix(text: Column, prefix: str = LABEL_PREFIX) -> Column:
    return csv_join(F.transform(csv_split(text), lambda item: F.concat(F.lit(prefix), item)))


def csv_quote(text: Column) -> Column:
    return csv_join(F.transform(csv_split(text), lambda item: F.concat(F.lit('"'), item, F.lit('"'))))


def csv_alias_list(text: Column, prefix: str = LABEL_PREFIX) -> Column:
    """``1,2`` becomes `` '1' as label_1,'2' as label_2``; the leading space is part of the format."""
    aliased = F.transform(
        csv_split(text),
        lambda item: F.concat(F.lit("'"), item, F.lit("' as " + prefix), item),
    )
    return F.concat(F.lit(" "), csv_join(aliased))


def literal_pattern(separator: str) -> str:
    """``separator`` as a pattern for `split`; one character stays clear of the regex engine."""
    if len(separator) == 1:
        return separator if separator.isalnum() else "\\" + separator
    return "\\Q" + separator + "\\E"


def str_map(text: Column, pair_separator: str = ",", key_separator: str = ":") -> Column:
    """``a:1,b:2`` as a map.

    Separators at the end are dropped, and a text of separators only is an empty map. An item that is no pair of a
    key and a value that is not empty is an error. A repeated key keeps its last value, which needs
    ``spark.sql.mapKeyDedupPolicy`` as `tagloom.settings` sets it.
    """
    between, within = literal_pattern(pair_separator), literal_pattern(key_separator)
    if len(pair_separator) == len(key_separator) == 1:
        trimmed, part = F.rtrim(text, F.lit(pair_separator)), f"[^{between}{within}]"
    else:
        trimmed, part = F.regexp_replace(text, f"(?:{between})+$", ""), f"(?:(?!{between}|{within}).)"
    pair = f"{part}*+{within}{part}++"
    bad = ~trimmed.rlike(f"(?s)^{pair}(?:{between}{pair})*+$")
    return (
        F.when((trimmed == "") & (text != ""), F.create_map().cast("map<string,string>"))
        .when(bad, F.raise_error(F.concat(F.lit("not a pair in "), text)).cast("map<string,string>"))
        .otherwise(F.str_to_map(trimmed, F.lit(between), F.lit(within)))
    )


def template_fill(text: Column, params: Mapping[str, Column | str]) -> Column:
    """Replace every ``{name}`` in ``text``; a name without a parameter is an error."""
    values = {name: v if isinstance(v, Column) else F.lit(v) for name, v in params.items()}
    names = F.regexp_extract_all(text, F.lit(r"\{(\w+)\}"), F.lit(1))
    unknown = F.array_except(names, F.array(*[F.lit(n) for n in values]).cast("array<string>"))
    filled = text
    for name, value in values.items():
        filled = F.replace(filled, F.lit("{" + name + "}"), value)
    return F.when(
        F.size(unknown) > 0,
        F.raise_error(F.concat(F.lit("no parameter for "), csv_join(unknown))).cast("string"),
    ).otherwise(filled)


def single_to_double_quotes(text: Column) -> Column:
    return F.replace(text, F.lit("'"), F.lit('"'))


def json_field(text: Column, name: str) -> Column:
    return F.get_json_object(text, "$." + name)
