"""Running counts, sums and exclusive ors within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.tables import stored


def running(rows: DataFrame, key: str, order: Sequence[Column], xors: Sequence[str] = (), adds: Sequence[str] = ()) -> DataFrame:
    """Adds ``place`` (1, 2, ... by ``order`` within ``key``) and, per column c of ``xors`` and ``adds``, ``run_c``: that of
    this row and those before it.

    ``key`` and the columns are integers without nulls; the order must be total, or tied rows alike. A group is not one
    task's: rows are dealt by ranges of (key, order), each range is run through once, and where a group goes on in the next range
    it takes over the sums of the earlier ones. At most one group goes on into a range, so what is broadcast for it is
    at most a row per range.
    """
    names = ["place", *[f"run_{c}" for c in (*xors, *adds)]]

    def run(batches):
        from pyspark import TaskContext

        last, carried = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch[key].to_numpy()
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            start = np.repeat(first, np.diff(np.append(first, len(keys))))
            values = [np.arange(len(keys)) - start + 1]
            for c in xors:
                total = np.bitwise_xor.accumulate(batch[c].to_numpy())
                values.append(total ^ np.append(0, total)[start])
            for c in adds:
                total = np.cumsum(batch[c].to_numpy())
                values.append(total - np.append(0, total)[start])
            if last == keys[0]:
                own = slice(0, first[1] if len(first) > 1 else len(keys))
                for k, (value, more) in enumerate(zip(values, carried, strict=True)):
                    value[own] = value[own] ^ more if 0 < k <= len(xors) else value[own] + more
            last, carried = keys[-1], [v[-1] for v in values]
            range_ = pa.array(np.full(len(keys), TaskContext.get().partitionId(), np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(v) for v in values], range_], [*batch.schema.names, *names, "range"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema], *[f"{n} long" for n in names], "range long"])
    dealt = rows.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    run_through = stored(dealt.mapInArrow(run, schema), "running")
    sums = [F.max("place").alias("place"), *[F.bit_xor(c).alias(f"run_{c}") for c in xors], *[F.sum(c).alias(f"run_{c}") for c in adds]]
    earlier = Window.partitionBy(key).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    joined = [(F.bit_xor if n[4:] in xors else F.sum)(n).over(earlier).alias(f"earlier_{n}") for n in names]
    ranges = run_through.groupBy(key, "range").agg(*sums).select(key, "range", *joined).filter("earlier_place is not null")
    out = run_through.join(F.broadcast(ranges), [key, "range"], "left")
    for n in names:
        more = F.coalesce(f"earlier_{n}", F.lit(0))
        out = out.withColumn(n, F.col(n).bitwiseXOR(more) if n[4:] in xors else F.col(n) + more)
    return out.select(*rows.columns, *names)
