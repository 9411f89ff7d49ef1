"""The answer cache as a table of ``key, stage, result columns, error, written_at``.

Entries are appended per run; the newest row of a key is the entry. Readers always reduce to that first, so
copies of one key never meet in a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import errors
from sievework.functions.stages import Stage

KEY = "cache_key"


def payload_columns(stage: Stage) -> list[str]:
    return [*stage.result_columns, stage.reasoning_column]


def cache_entries(results: DataFrame, stage: Stage, written_at: Column) -> DataFrame:
    """Results of one run as cache rows. A reply that is not there yet is no result and is left out."""
    return results.filter(F.col(stage.error_column) != errors.NO_ANSWER).select(
        KEY,
        F.lit(stage.prefix).alias("stage"),
        F.struct(*payload_columns(stage)).alias("result"),
        F.col(stage.error_column).alias("error"),
        written_at.alias("written_at"),
    )


def latest_entries(cache: DataFrame, stage: Stage, with_columns: Sequence[str] = (), within: Sequence[str] = ()) -> DataFrame:
    """The newest row per key of one stage; ties go to the row without an error, then to a hash.

    ``with_columns`` of that row are kept too. ``within`` names columns that follow from the key, such as the one by which
    rows are partitioned already.
    """
    newest = F.max_by(
        F.struct("result", "error", "written_at", *with_columns),
        F.struct("written_at", (F.col("error") == "").alias("clean"), F.xxhash64(F.to_json("result")).alias("tie")),
    )
    return (
        cache.filter(F.col("stage") == stage.prefix)
        .groupBy(*within, KEY)
        .agg(newest.alias("entry"))
        .select(KEY, F.lit(stage.prefix).alias("stage"), "entry.*", *within)
    )


def _usable(latest: DataFrame, retry_errors: bool) -> DataFrame:
    return latest.filter(F.col("error") == "") if retry_errors else latest


def cache_hits(keys: DataFrame, latest: DataFrame, stage: Stage, retry_errors: bool = False) -> DataFrame:
    """Keys with a cached result, and the result's columns. Errors count as hits unless they are retried."""
    found = _usable(latest, retry_errors).select(KEY, "result")
    return keys.join(found, KEY).select(*keys.columns, *[F.col(f"result.{c}") for c in payload_columns(stage)])


def cache_misses(keys: DataFrame, latest: DataFrame, retry_errors: bool = False) -> DataFrame:
    return keys.join(_usable(latest, retry_errors).select(KEY), KEY, "left_anti")


def without_keys(cache: DataFrame, keys: DataFrame) -> DataFrame:
    """The cache after deletion of ``keys``."""
    return cache.join(keys.select(KEY).distinct(), KEY, "left_anti")


def cache_stats(latest: DataFrame) -> DataFrame:
    """Number of entries and bytes of their JSON payload."""
    return latest.agg(
        F.count("*").alias("size"),
        F.coalesce(F.sum(F.octet_length(F.to_json("result"))), F.lit(0)).alias("volume_bytes"),
    )


def combined(*parts: DataFrame) -> DataFrame:
    """Rows of all parts, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), parts)
