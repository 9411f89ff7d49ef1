"""Latest snapshot per job from a log of progress events.

Events hold ``job_id, seq, kind`` (total, progress, done, error), ``total, processed, stage`` and optionally
``summary`` and ``message``. A job may own any share of the log, so nothing is sorted or windowed per job:
each field is the value at the greatest ``seq`` of its kind, an aggregate that is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.rounding import round_half_even
from sievework.operators.lookup import spread_left_join

SNAPSHOT_COLUMNS = ("job_id", "status", "stage", "processed", "total", "pct", "summary", "error")


def percent(processed: Column, total: Column) -> Column:
    """Share of ``total`` in percent, 0 without a total."""
    share = F.try_divide(processed.cast("double"), total.cast("double")) * 100
    return F.when(total != 0, round_half_even(share, 1)).otherwise(0.0)


def with_optional_columns(events: DataFrame) -> DataFrame:
    absent = [F.lit(None).cast("string").alias(c) for c in ("summary", "message") if c not in events.columns]
    return events.select("*", *absent) if absent else events


def job_snapshots(events: DataFrame) -> DataFrame:
    """One row per job: status, stage, processed, total, percentage, summary and error."""
    events = with_optional_columns(events)

    def seq_of(*kinds: str) -> Column:
        return F.when(F.col("kind").isin(*kinds), F.col("seq"))

    def last(value: str, kind: str) -> Column:
        return F.max_by(value, seq_of(kind))

    jobs = events.groupBy("job_id").agg(
        last("total", "total").alias("total"),
        last("processed", "progress").alias("progressed"),
        last("stage", "progress").alias("stage"),
        last("summary", "done").alias("summary"),
        last("message", "error").alias("error"),
        F.max_by("kind", seq_of("progress", "done", "error")).alias("last_kind"),
        F.max(seq_of("total")).alias("total_seq"),
        F.max(seq_of("progress")).alias("progress_seq"),
        F.max(seq_of("done")).alias("done_seq"),
    )
    # 'done' sets processed to the total known by then. If a later event changed the total, the earlier one
    # is looked up, for those jobs only.
    finished = F.coalesce(F.col("done_seq") > F.coalesce("progress_seq", F.col("done_seq") - 1), F.lit(False))
    outdated = finished & F.coalesce(F.col("total_seq") > F.col("done_seq"), F.lit(False))
    cut = jobs.filter(outdated).select("job_id", "done_seq")
    totals = events.filter(F.col("kind") == "total").select("job_id", "seq", "total")
    earlier = (
        spread_left_join(totals, cut, "job_id", "seq")
        .filter(F.col("seq") < F.col("done_seq"))
        .groupBy("job_id")
        .agg(F.max_by("total", "seq").alias("total_then"))
    )
    processed = (
        F.when(outdated, F.col("total_then")).when(finished, F.col("total")).otherwise(F.col("progressed"))
    )
    status = (
        F.when(F.col("last_kind") == "progress", "running").when(F.col("last_kind").isNull(), "queued").otherwise(F.col("last_kind"))
    )
    snapshots = jobs.join(earlier, "job_id", "left").select(
        "job_id",
        status.alias("status"),
        F.coalesce("stage", F.lit("")).alias("stage"),
        F.coalesce(processed, F.lit(0)).cast("long").alias("processed"),
        F.coalesce("total", F.lit(0)).cast("long").alias("total"),
        F.coalesce("summary", F.lit("")).alias("summary"),
        F.coalesce("error", F.lit("")).alias("error"),
    )
    return snapshots.withColumn("pct", percent(F.col("processed"), F.col("total"))).select(*SNAPSHOT_COLUMNS)
