"""What a Python worker keeps from task to task, and groups that arrive as a sorted stream."""

from __future__ import annotations

import gc
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame


def per_worker(key, make: Callable, shared: bool = False):
    """``make()``, once per worker process: functions of this package arrive anew with each task, modules stay.

    Workers outlive an operator, so what one keeps goes when the next one asks for something else; only ``shared`` values,
    which are small, stay.
    """
    held = sys.modules.setdefault("_sievework_worker", types.ModuleType("_sievework_worker")).__dict__.setdefault("held", {})
    if key not in held:
        if not shared:
            for other in [k for k, (_, stays) in held.items() if not stays]:
                del held[other]
            gc.collect()
        held[key] = make(), shared
    return held[key][0]


def text_slices(batches, column: str = "text", rows: int = 256, most_bytes: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of one have ``most_bytes`` at most, but for a single longer one."""
    for whole in batches:
        sizes = np.cumsum(pa.compute.binary_length(whole[column]).fill_null(0).to_numpy().astype(np.int64))
        low = 0
        while low < whole.num_rows:
            before = sizes[low - 1] if low else 0
            high = min(low + rows, max(low + 1, int(np.searchsorted(sizes, before + most_bytes, "right"))))
            yield whole.slice(low, high - low)
            low = high


def in_groups(df: DataFrame, keys: list[str], each: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Applies ``each`` to tables that hold whole groups of ``keys``, many small groups at a time.

    Groups are dealt by hash and sorted within the task, so a task holds its current groups only. The caller sees to it
    that no group is unbounded. ``each`` gets rows sorted by ``keys``; bounds_of() finds the groups.
    """

    def stream(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            last = _last_change(batch, keys)
            if held and last == 0 and _same_key(held[-1], held[-1].num_rows - 1, batch, 0, keys):
                held.append(batch)
                continue
            if last or held:
                whole = pa.Table.from_batches([*held, batch.slice(0, last)])
                if whole.num_rows:
                    yield from each(whole)
            held = [batch.slice(last)]
        if held:
            yield from each(pa.Table.from_batches(held))

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(stream, schema)


def _same_key(a, i: int, b, j: int, keys: list[str]) -> bool:
    return all(a.column(k)[i].as_py() == b.column(k)[j].as_py() for k in keys)


def _last_change(batch: pa.RecordBatch, keys: list[str]) -> int:
    """The first row of the batch's last group."""
    low, high = 0, batch.num_rows - 1
    while low < high:  # sorted, so equal keys are together
        mid = (low + high) // 2
        if _same_key(batch, mid, batch, batch.num_rows - 1, keys):
            high = mid
        else:
            low = mid + 1
    return low


def bounds_of(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where each group of a sorted table starts, and its end. The keys are integers without nulls."""
    n = table.num_rows
    change = np.zeros(n, bool)
    change[0] = True
    for k in keys:
        values = table.column(k).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(change), n)


def matrix_of(column: pa.ChunkedArray | pa.Array, width: int, kind) -> np.ndarray:
    """A binary column of equal lengths as a matrix, one row each."""
    joined = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(joined, pa.ChunkedArray):
        joined = pa.concat_arrays(joined.chunks)
    if not len(joined):
        return np.empty((0, width), kind)
    large = pa.types.is_large_binary(joined.type)
    bounds = np.frombuffer(joined.buffers()[1], np.int64 if large else np.int32)[joined.offset : joined.offset + len(joined) + 1]
    data = np.frombuffer(joined.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    return data.view(kind).reshape(len(joined), width) if data.size else np.empty((len(joined), width), kind)
