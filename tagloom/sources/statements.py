"""Statements with parameters, and periods that a control table names."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PLACE = re.compile(r"'\{(\w+)\}'|\{(\w+)\}")


def statement(spark: SparkSession, text: str, parameters: Mapping[str, object]) -> DataFrame:
    """The result of a statement with places ``{name}`` for values, also written in quotes of their own.

    Values are bound by Spark with their type, not written into the text: quotes or SQL in a value are part of the
    value. A place stands for a whole value, not for a part of one, a name or a keyword. A place without a parameter is
    an error; parameters that no place names are not used.
    """
    names = [quoted or plain for quoted, plain in _PLACE.findall(text)]
    missing = sorted(set(names) - set(parameters))
    if missing:
        raise KeyError(f"no parameter for {', '.join(missing)}")
    bound = _PLACE.sub(lambda m: f":{m[1] or m[2]}", text)
    return spark.sql(bound, args={name: parameters[name] for name in names})


def controlled_scan(
    df: DataFrame, control: DataFrame, source: str, partition_field: str, *, source_column: str = "source_name", period_column: str = "period"
) -> DataFrame:
    """The periods of ``df`` that the control table names for the source and has enabled.

    ``control`` is ``(source_name, period, enabled)``. The periods are joined, not collected, and their few rows are broadcast, so
    Spark prunes the partitions of ``df`` while it runs: files of other periods are never listed or read. A period named twice
    counts once.
    """
    wanted = control.where((F.col(source_column) == F.lit(source)) & F.col("enabled"))
    wanted = wanted.select(F.col(period_column).cast("string").alias(partition_field)).distinct()
    return df.join(F.broadcast(wanted), partition_field, "left_semi")
