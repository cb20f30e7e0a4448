"""Columns of vectors in Arrow batches, and blocks of vectors as rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import in_batches, uniform, utf8

#: A block of vectors that is sent to others holds about this many bytes.
BLOCK_BYTES = 1 << 20


def vectors_by_length(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The usable vectors of an Arrow list column, by length: their row numbers and a matrix of doubles.

    A vector is usable if it is not null, not empty, and all its components are finite numbers.
    """
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)  # null becomes nan
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(lengths) else lengths
    for length in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == length)
        matrix = flat[starts[rows, None] + np.arange(length)]
        usable = np.isfinite(matrix).all(1)
        if usable.any():
            yield rows[usable], matrix[usable]


def binary_rows(matrix: np.ndarray) -> pa.Array:
    """Each row of a matrix as its bytes."""
    width = matrix.shape[1] * matrix.itemsize
    offsets = np.arange(0, (len(matrix) + 1) * width, width, dtype=np.int64) if width else np.zeros(len(matrix) + 1, np.int64)
    data = pa.py_buffer(np.ascontiguousarray(matrix).tobytes())
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(matrix), [None, pa.py_buffer(offsets.tobytes()), data]).cast(pa.binary())


def matrix_rows(column, dtype, length: int) -> np.ndarray:
    """The inverse of `binary_rows`."""
    data, _ = utf8(column)
    return data.view(dtype).reshape(len(column), length)


def whole_numbers(matrix: np.ndarray, scale: int, limit: int) -> np.ndarray:
    """``floor(scale * x)`` of all components, held to ``limit`` either way so that sums of products fit a long."""
    return np.clip(np.floor(matrix * scale), -limit, limit).astype(np.int32)


def exact(matrix: np.ndarray, most: float) -> np.ndarray:
    """A matrix of whole numbers as doubles if all sums up to ``most`` are exact in them, else as longs."""
    return matrix.astype(np.float64 if most < 2.0**53 else np.int64)


def dealt(rows: DataFrame, cell: list[str], key: Column, most: Column) -> DataFrame:
    """``rows`` with ``_part`` and ``_parts``: each cell is dealt by the hash of ``key`` into parts of about ``most`` rows."""
    sizes = rows.groupBy(*cell).agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.max(most))).cast("int").alias("_parts"))
    part = F.floor(uniform(key) * F.col("_parts")).cast("int").alias("_part")
    return rows.join(sizes, cell).select("*", part)


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str, label_column: str, scale: int, limit: int) -> DataFrame:
    """``(_id, _label, _length, _whole)``: the usable vectors as bytes of the 4-byte whole numbers of `whole_numbers`."""
    rows = vectors.select(
        F.col(f"`{id_column}`").alias("_id"), F.col(f"`{label_column}`").alias("_label"), F.col(f"`{vector_column}`").alias("_vector")
    )
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("_length", T.IntegerType()), T.StructField("_whole", T.BinaryType())])

    def convert(batches):
        for batch in batches:
            for kept, matrix in vectors_by_length(batch.column(2)):
                kept = pa.array(kept)
                length = pa.array(np.full(len(kept), matrix.shape[1], np.int32))
                whole = binary_rows(whole_numbers(matrix, scale, limit))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(kept), batch.column(1).take(kept), length, whole], names=schema.names)

    return in_batches(rows, convert, schema)
