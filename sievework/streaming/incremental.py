"""Qualification of contacts as they arrive.

Every micro-batch is a run of its own that reads what earlier batches cached, so a site is evaluated once
over the life of the stream. All writes are keyed by the batch id: a batch that is replayed after a failure
overwrites what it wrote before.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sievework.operators.cache import combined
from sievework.plans.asking import Asking, Provider
from sievework.plans.qualify import RunPaths, checkpoint_snapshot, run
from sievework.plans.snapshots import changed_sites, merged_snapshot, revised_contacts
from sievework.sinks.cache import fold_cache, remove_folded
from sievework.sinks.results import write_results
from sievework.streaming.metrics import RunningTotals


def contacts_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Landed contact files as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def start_incremental_run(
    contacts: DataFrame,
    tables: Callable[[SparkSession], tuple[DataFrame, DataFrame]],
    paths: RunPaths,
    run_id: str,
    run_time: datetime,
    checkpoint: str,
    retry_errors: bool = False,
    on_summary: Callable[[int, dict], None] | None = None,
    on_total: Callable[[int], None] | None = None,
    on_progress: Callable[[str, int], None] | None = None,
    provider: Provider | None = None,
    asking: Asking = Asking(),
    fold_every: int | None = None,
    revise: bool = False,
) -> StreamingQuery:
    """Process everything available and stop; start it again to go on where it stopped.

    ``tables`` returns the prepared pages and the answers and is asked anew for each batch, so additions to
    them are seen. ``on_total`` and ``on_progress`` are told what a batch run is told, as running totals since the start.
    The cache is folded after every ``fold_every`` batches, so that a batch reads its own keys' part of it. With ``revise``
    each batch also writes the earlier contacts whose results it changed, see :func:`snapshot_from_deltas`.
    """
    totals = RunningTotals(on_total, on_progress)

    def process(batch: DataFrame, batch_id: int) -> None:
        pages, answers = tables(batch.sparkSession)
        totals.next_batch()
        summary = run(
            batch,
            pages,
            answers,
            paths,
            f"{run_id}-{batch_id}",
            run_time,
            part=f"/batch={batch_id}",
            retry_errors=retry_errors,
            on_total=totals.total if on_total else None,
            on_progress=totals.progress if on_progress else None,
            provider=provider,
            asking=asking,
        )
        if revise:
            write_revisions(batch.sparkSession, paths, batch_id, run_time)
        if fold_every and batch_id % fold_every == fold_every - 1:
            fold_cache(batch.sparkSession, paths.cache)
            remove_folded(batch.sparkSession, paths.cache)
        if on_summary:
            on_summary(batch_id, summary)

    return (
        contacts.writeStream.queryName(run_id)
        .foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def qualified_so_far(spark: SparkSession, paths: RunPaths, batch_id: int | None = None) -> DataFrame:
    """Everything qualified up to a batch, read from the batches' own folders.

    The snapshot is a view over increments; storing it per batch would repeat all earlier work each time.
    """
    stored = spark.read.parquet(paths.of("qualified"))
    return stored if batch_id is None else stored.filter(F.col("batch") <= batch_id)


def _results(spark: SparkSession, paths: RunPaths, until: int) -> DataFrame:
    read = spark.read.parquet
    return combined(read(paths.of("cached_results")), read(paths.of("site_results"))).filter(F.col("batch") <= until)


def finished_sites(spark: SparkSession, paths: RunPaths, batch_id: int) -> DataFrame:
    """Each site's last result up to a batch; one without a reply in one batch may be evaluated again in a later one."""
    return _results(spark, paths, batch_id).groupBy("site").agg(F.max_by(F.struct("*"), "batch").alias("r")).select("r.*").drop("batch")


def write_revisions(spark: SparkSession, paths: RunPaths, batch_id: int, run_time: datetime) -> None:
    """Store the contacts of earlier batches whose site's result the batch has changed."""
    results = _results(spark, paths, batch_id)
    changed = changed_sites(results.filter(F.col("batch") < batch_id), results.filter(F.col("batch") == batch_id).drop("batch"))
    reached = qualified_so_far(spark, paths, batch_id - 1)
    write_results(revised_contacts(reached, changed, F.lit(run_time)), paths.of("revised", f"/batch={batch_id}"))


def snapshot_from_deltas(contacts: DataFrame, paths: RunPaths, batch_id: int, qualified_at: Column) -> DataFrame:
    """:func:`snapshot_of_all`, put together from what the batches of a run with ``revise`` have written."""
    spark = contacts.sparkSession
    revisions = spark.read.parquet(paths.of("revised")).filter(F.col("batch") <= batch_id)
    reached = qualified_so_far(spark, paths, batch_id)
    return merged_snapshot(contacts, reached, revisions, finished_sites(spark, paths, batch_id), qualified_at)


def snapshot_of_all(contacts: DataFrame, paths: RunPaths, batch_id: int, qualified_at: Column) -> DataFrame:
    """The scored view of all contacts after a batch, those not reached yet with NULL answers."""
    return checkpoint_snapshot(contacts, finished_sites(contacts.sparkSession, paths, batch_id), qualified_at)
