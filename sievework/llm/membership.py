"""A filter of fixed size for ids that may be in a set: what it lets through is then joined exactly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.hashing import mixed, random_values

BITS = 1 << 25
_HASHES = 4


def _places(ids: np.ndarray) -> np.ndarray:
    keys = ids.astype(np.int64).view(np.uint64)
    return np.stack([mixed(keys ^ salt) % np.uint64(BITS) for salt in random_values(_HASHES, 11)])


def filter_of(ids: DataFrame) -> np.ndarray:
    """The bits (4 MB, whatever the number of ids) of the first column of ``ids``.

    Up to some three million ids it lets one other in a hundred through; with very many it lets all through, and the
    exact join that follows does the work alone.
    """

    def marked(batches):
        for batch in batches:
            places = np.unique(_places(batch.column(0).to_numpy()))
            bits = np.uint64(1) << (places & np.uint64(63))
            words = (places >> np.uint64(6)).astype(np.int64)
            first = np.flatnonzero(np.diff(words, prepend=-1))
            joined = np.bitwise_or.reduceat(bits, first) if len(first) else bits
            yield pa.RecordBatch.from_arrays([pa.array(words[first]), pa.array(joined.view(np.int64))], ["word", "bits"])

    rows = ids.mapInArrow(marked, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(BITS // 64, np.uint64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def may_hold(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    places = _places(ids)
    return ((bits[(places >> np.uint64(6)).astype(np.int64)] >> (places & np.uint64(63))) & np.uint64(1)).all(axis=0)


def rows_that_may_be_in(df: DataFrame, id_column: str, ids: DataFrame, inside: bool = True) -> DataFrame:
    """The rows whose id may be in ``ids`` (all that are, and few others), or with ``inside`` false the other rows."""
    bits = filter_of(ids)

    def kept(batches):
        for batch in batches:
            column = batch[id_column]
            hit = may_hold(bits, column.fill_null(0).to_numpy()) & ~column.is_null().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(hit if inside else ~hit))

    return df.mapInArrow(kept, df.schema)
