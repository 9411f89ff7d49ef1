"""Vectors as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.workers import matrix_of


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """The rows that take part, as vec_id and vector (the doubles' bytes), and the number of components.

    Left out: rows without vec_id; vectors that are null, zero or hold null or non-finite components; and, as they can't
    be compared with the others, vectors of another length than most (of equally frequent lengths, the greatest).
    """
    value = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), value.alias("value"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("value").isNotNull() & takes_part(F.col("value")))
    lengths = rows.groupBy(F.size("value").alias("length")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("length")).first()
    length = lengths["length"] if lengths else 0
    return rows.filter(F.size("value") == length), length


def takes_part(value: Column) -> Column:
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return finite & F.exists(value, lambda x: x != 0)


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """An array<double> column whose rows have one length, or a binary one, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        return matrix_of(column, width, "<f8")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def as_binary(values: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(values, "<f8")
    width = data.shape[1] * 8
    bounds = np.arange(len(data) + 1, dtype=np.int64) * width
    large = pa.Array.from_buffers(pa.large_binary(), len(data), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    return large.cast(pa.binary())


def drawn(rows: DataFrame, n: int, total: int, width: int, seed: int) -> np.ndarray:
    """About n different vectors for fitting, drawn by a hash of the id: the one thing that the driver holds of them."""
    place = F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(1 << 30)) / float(1 << 30)
    found = rows.filter(place * total < n).select("vec_id", "value").orderBy("vec_id").toArrow()
    if not found.num_rows:
        found = rows.select("vec_id", "value").orderBy("vec_id").limit(1).toArrow()
    values = matrix(found["value"], width)
    return values[np.sort(np.unique(values, axis=0, return_index=True)[1])]
