"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.sinks.scratch import stored as settled  # noqa: F401

#: The white space of the contracts, as a regular expression class and as characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as keep it apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def packed(df: DataFrame, *more: Column) -> DataFrame:
    """All columns of ``df`` as one, ``_row``, beside ``more``, so that no name of theirs meets one of its own."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *more)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` names it in a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def uniform(*seeds: Column) -> Column:
    """A number from 0 to below 1 that depends on the seeds alone."""
    return F.shiftrightunsigned(F.xxhash64(*seeds), 11).cast("double") / F.lit(float(2**53))


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


#: Texts go to Python in batches of about this many bytes, whatever their number.
BATCH_BYTES = 8 << 20


def in_batches(df: DataFrame, function: Callable, schema) -> DataFrame:
    """`mapInArrow` with batches bounded in bytes: a run of long texts must not become one huge batch."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow text column and the offsets of its texts in them; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(data, np.uint8)[first:last] if last > first else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64) - first


def text_column(data: bytes, offsets: np.ndarray) -> pa.Array:
    """The Arrow text column of `utf8`; bytes that are no UTF-8 become U+FFFD."""
    try:
        data.decode()
        starts = np.frombuffer(data, np.uint8)[offsets[offsets < len(data)]]
        clean = not ((starts >= 0x80) & (starts < 0xC0)).any()
    except UnicodeDecodeError:
        clean = False
    if not clean:
        return pa.array([data[i:j].decode(errors="replace") for i, j in zip(offsets[:-1], offsets[1:])], pa.string())
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data))
