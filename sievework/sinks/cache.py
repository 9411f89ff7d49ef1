"""Writing the cache: runs add folders of their own, folding makes one row a key of them, laid out by key."""

from __future__ import annotations

import math
import uuid
from datetime import datetime
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions.stages import WEBSITE, Stage
from sievework.operators.cache import KEY, latest_entries, without_keys
from sievework.sources.cache import (
    GENERATION_SCHEMA,
    MAX_BUCKETS,
    Generation,
    added_entries,
    base_folder,
    bucket_of,
    cache_schema,
    current_folder,
    current_generation,
    entries_folder,
    folded_entries,
    forgotten_folder,
    not_forgotten,
)


def append_entries(entries: DataFrame, path: str, run_id: str, stage: Stage = WEBSITE) -> None:
    """Write a stage's entries of one run, in place of those it wrote before, if any.

    What it wrote before the cache was folded stays in the folded part; a later entry of a key counts before it.
    """
    after = current_generation(entries.sparkSession, path, stage).number
    own = entries.filter(F.col("stage") == stage.prefix).drop("stage", "run_id")
    own.write.mode("overwrite").parquet(f"{entries_folder(path, stage)}/after={after}/run_id={quote(run_id, safe='')}")


def forget_keys(keys: DataFrame, path: str, stage: Stage, forgotten_at: datetime) -> None:
    """Let go of the entries of ``keys`` written until a time. Only the keys are written; folding drops the entries."""
    after = current_generation(keys.sparkSession, path, stage).number
    order = keys.select(KEY).distinct().withColumn("forgotten_at", F.lit(forgotten_at))
    order.write.mode("errorifexists").parquet(f"{forgotten_folder(path, stage)}/after={after}/order={uuid.uuid4().hex}")


def fold_cache(spark: SparkSession, path: str, stage: Stage = WEBSITE, rows_per_bucket: int = 1000) -> Generation:
    """Make the next generation: the newest entry of every key that is not forgotten, in folders by the key's hash.

    The entries travel once, by their folder, and are reduced and sorted by key there. Its row is written last: until
    then readers see the generation before, and an attempt that dies leaves a folder that nothing refers to. One
    attempt may run at a time; of two that end together the one of the greater name counts, and both are whole.
    """
    now = current_generation(spark, path, stage)
    entries = added_entries(spark, path, stage, now)
    if now.name is not None:
        entries = entries.unionByName(folded_entries(spark, path, stage, now))
    kept = not_forgotten(spark, entries, path, stage, now)
    n_keys = kept.agg(F.approx_count_distinct(KEY)).first()[0]
    buckets = max(1, min(MAX_BUCKETS, math.ceil(n_keys / rows_per_bucket)))

    folder = bucket_of(F.col(KEY), buckets)
    newest = latest_entries(kept.withColumn("bucket", folder).repartition("bucket"), stage, with_columns=["run_id"], within=["bucket"])
    name = f"{now.number + 1}-{uuid.uuid4().hex}"
    placed = newest.drop("stage").sortWithinPartitions("bucket", KEY)
    placed.write.partitionBy("bucket").parquet(base_folder(path, stage, name))
    return _make_current(spark, path, stage, Generation(now.number + 1, name, buckets))


def _make_current(spark: SparkSession, path: str, stage: Stage, generation: Generation) -> Generation:
    row = spark.createDataFrame([(generation.number, generation.name, generation.buckets)], GENERATION_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(current_folder(path, stage))
    return generation


def remove_folded(spark: SparkSession, path: str, stage: Stage = WEBSITE) -> list[str]:
    """Delete what no reader of the current generation or the one before it needs; returns the folders.

    Those are additions and key lists from before the generation before last, and other generations' folders.
    """
    now = current_generation(spark, path, stage)
    files = spark._jvm.org.apache.hadoop.fs
    kept = [g["name"] for g in spark.read.schema(GENERATION_SCHEMA).parquet(current_folder(path, stage)).filter(
        F.col("generation") >= now.number - 1
    ).collect()] if now.number else []

    def below(folder: str, old) -> list[str]:
        at = files.Path(folder)
        system = at.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in system.listStatus(at)] if system.exists(at) else []
        gone = [f"{folder}/{n}" for n in names if old(n)]
        for each in gone:
            system.delete(files.Path(each), True)
        return gone

    def before(name: str) -> bool:
        return name.startswith("after=") and int(name.removeprefix("after=")) < now.number - 2

    def unused(name: str) -> bool:
        return int(name.split("-")[0]) <= now.number and name not in kept

    return [
        *below(entries_folder(path, stage), before),
        *below(forgotten_folder(path, stage), before),
        *below(base_folder(path, stage, "").rstrip("/"), unused),
    ]


def clear_cache(spark: SparkSession, path: str, stage: Stage) -> None:
    """Leave no entries of a stage; other stages keep theirs."""
    now = current_generation(spark, path, stage)
    empty = spark.createDataFrame([], cache_schema(stage)).drop("stage").withColumn("after", F.lit(0))
    empty.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("after", "run_id").parquet(entries_folder(path, stage))
    if now.name is not None:
        _make_current(spark, path, stage, Generation(now.number + 1, None, 1))


def delete_keys(cache: DataFrame, keys: DataFrame, new_path: str) -> None:
    """Write a stored cache without ``keys`` to a new folder; the old one stays readable meanwhile."""
    left = without_keys(cache, keys).withColumn("after", F.lit(0))
    left.write.mode("errorifexists").partitionBy("stage", "after", "run_id").parquet(new_path)
