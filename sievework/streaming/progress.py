"""Job snapshots over a stream of progress events: the streaming form of ``operators.progress``.

Each job has keyed state: what its latest event of every kind said, and the totals that a later 'done' may still refer to. A
micro-batch reads and writes the state of the jobs it holds events of, and no others.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from sievework.operators.progress import SNAPSHOT_COLUMNS, percent, with_optional_columns

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("job_id", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("total", T.LongType()),
        T.StructField("processed", T.LongType()),
        T.StructField("stage", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)
# The state of a job: sequence number (-1: none yet) and content of the latest event of each kind, and of the last total
# before the latest 'done'.
LATEST = (
    "total_seq long, total long, progress_seq long, processed long, stage string, done_seq long, summary string, "
    "error_seq long, message string, before_seq long, before long"
)
_EMPTY = (-1, None, -1, None, None, -1, None, -1, None, -1, None)
_FIELDS = [f.split()[0] for f in LATEST.split(", ")]
_SAID = {"total": ("total",), "progress": ("processed", "stage"), "done": ("summary",), "error": ("message",)}
_OUT = "job_id long, status string, stage string, processed long, total long, summary string, error string"


class JobState(StatefulProcessor):
    """Merges a job's new events into its state and gives its snapshot.

    Totals after the latest 'done' are kept one by one, since a 'done' that comes late may lie between any two of them;
    the 'done' that does arrive removes all before it but the last.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", LATEST)
        self.totals = handle.getMapState("totals", "seq long", "total long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = dict(zip(_FIELDS, self.latest.get() if self.latest.exists() else _EMPTY, strict=True))
        totals: dict[int, int | None] = {}
        done_before = state["done_seq"]
        for part in rows:
            self._merge(part, state, totals)
        if state["done_seq"] > done_before:
            self._finish(state, totals)
        for seq, total in totals.items():
            if seq > state["done_seq"]:
                self.totals.updateValue((seq,), (total,))
            elif seq > state["before_seq"]:
                state["before_seq"], state["before"] = seq, total
        self.latest.update(tuple(state[f] for f in _FIELDS))
        yield pd.DataFrame([_snapshot(key[0], state)], columns=[f.split()[0] for f in _OUT.split(", ")])

    @staticmethod
    def _merge(part: pd.DataFrame, state: dict, totals: dict) -> None:
        for kind, said in _SAID.items():
            own = part[part["kind"] == kind]
            if own.empty:
                continue
            last = own.loc[own["seq"].idxmax()]
            if last["seq"] > state[f"{kind}_seq"]:
                state[f"{kind}_seq"] = int(last["seq"])
                for column in said:
                    state[column] = _plain(last[column])
            if kind == "total":
                totals.update((int(s), _plain(t)) for s, t in zip(own["seq"], own["total"], strict=True))

    def _finish(self, state: dict, totals: dict) -> None:
        """A later 'done' is known: of the kept totals before it the last stays, as the one that it refers to."""
        passed = [(row[0][0], row[1][0]) for row in self.totals.iterator() if row[0][0] < state["done_seq"]] if self.totals.exists() else []
        for seq, total in passed:
            self.totals.removeKey((seq,))
            if seq > state["before_seq"]:
                state["before_seq"], state["before"] = seq, total

    def close(self) -> None:
        pass


def _plain(value):
    """Text or a whole number; pandas makes numbers of columns with nulls floats."""
    return None if pd.isna(value) else value if isinstance(value, str) else int(value)


def _snapshot(job_id, state: dict) -> tuple:
    seqs = {kind: state[f"{kind}_seq"] for kind in ("progress", "done", "error")}
    kind = max(seqs, key=seqs.get)
    status = "queued" if seqs[kind] < 0 else {"progress": "running"}.get(kind, kind)
    finished = state["done_seq"] > state["progress_seq"]
    processed = (state["before"] if finished else state["processed"]) or 0
    return job_id, status, state["stage"] or "", processed, state["total"] or 0, state["summary"] or "", state["message"] or ""


def start_job_snapshots(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process everything available and stop; start it again to go on where it stopped.

    Writes ``<path>/snapshots/batch=<n>``: the snapshots of the jobs that micro-batch n holds events of. Events may come in any
    order, within a micro-batch and over many; the result is the batch form's over all events so far. A replayed
    batch writes the same again. Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
    """
    rows = with_optional_columns(events).select(*[F.col(f.name).cast(f.dataType) for f in EVENT_SCHEMA.fields])
    changed = rows.groupBy("job_id").transformWithStateInPandas(JobState(), _OUT, "Update", "None")
    changed = changed.withColumn("pct", percent(F.col("processed"), F.col("total"))).select(*SNAPSHOT_COLUMNS)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/snapshots/batch={batch_id}")

    return changed.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot of each job after the last micro-batch that changed it."""
    every = spark.read.parquet(f"{path}/snapshots")
    last = every.groupBy("job_id").agg(F.max("batch").alias("batch"))
    return every.join(last, ["job_id", "batch"]).select(*SNAPSHOT_COLUMNS)
