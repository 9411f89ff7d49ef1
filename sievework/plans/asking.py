"""Asking an answer service from within a run, wave by wave, so that what it has replied is never asked again.

Below the given folder, ``pending/ask=A/wave=W`` holds the requests of call A in waves of about ``per_wave``, and
``replies/ask=A/wave=W`` what came back. A wave is one Spark job whose replies become visible together when it ends; when a
run dies, the next call leaves out every key with a stored reply. What a provider gives before it fails is kept.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sievework.functions.answers import decodable
from sievework.operators.distinct import best_per_key
from sievework.plans.website import replied_keys
from sievework.sources.tables import answers_from_replies

Provider = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]

REPLY_SCHEMA = "answer_key string, raw_answer string, failure string"
STORED_SCHEMA = f"{REPLY_SCHEMA}, ask int, wave int"


@dataclass(frozen=True)
class Asking:
    """How a service is asked.

    ``tasks`` ask side by side, each ``at_once`` requests in one call. A call that fails is repeated up to ``attempts`` times
    for the keys without a reply, after waits that double from ``first_wait`` to ``longest_wait`` seconds; then these keys
    count as failed. After ``give_up`` calls in a row without any reply a task asks no more in its wave, and after a wave
    without any reply no wave follows; what was not asked stays open. A lost executor costs at most a wave's replies.
    """

    per_wave: int = 10_000
    tasks: int = 8
    at_once: int = 20
    attempts: int = 3
    first_wait: float = 2.0
    longest_wait: float = 30.0
    give_up: int = 3


def replies_to(batch: pd.DataFrame, provider: Provider, asking: Asking) -> pd.DataFrame:
    """One row per request of a small batch: a reply, or the last failure. Keys that have a reply are not asked again.

    A reply of NULL, to a key that was not asked or a second one to a key is none.
    """
    found: dict[str, str] = {}
    failure, wait = None, asking.first_wait
    for attempt in range(asking.attempts):
        left = batch[~batch["cache_key"].isin(list(found))]
        if left.empty:
            break
        if attempt:
            time.sleep(wait)
            wait = min(2 * wait, asking.longest_wait)
        asked = set(left["cache_key"])
        try:
            for answers in provider(iter([left.reset_index(drop=True)])):
                for key, raw in zip(answers["answer_key"], answers["raw_answer"]):
                    if key in asked and raw is not None and raw == raw:
                        found.setdefault(key, raw)
            failure = "NoReply: the service left the request out"
        except Exception as exc:  # whatever a plugged-in client raises is a failed call
            failure = f"{type(exc).__name__}: {exc}"
    keys = list(dict.fromkeys(batch["cache_key"]))
    raw = [found.get(k) for k in keys]
    failures = [None if k in found else failure for k in keys]
    return pd.DataFrame({"answer_key": keys, "raw_answer": raw, "failure": failures}, dtype=object)


def _asker(provider: Provider, asking: Asking):
    def ask_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        silent = 0
        for batch in batches:
            for start in range(0, len(batch), asking.at_once):
                if silent >= asking.give_up:
                    return
                replies = replies_to(batch.iloc[start : start + asking.at_once], provider, asking)
                silent = 0 if replies["raw_answer"].notna().any() else silent + 1
                yield replies

    return ask_all


def stored_replies(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of all waves, failures included; none before the first wave."""
    try:
        return spark.read.schema(STORED_SCHEMA).parquet(f"{folder}/replies")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORED_SCHEMA)


def replied(spark: SparkSession, folder: str) -> DataFrame:
    """The stored replies in the shape of an answers table: usable ones first, then those of the last call."""
    return answers_from_replies(stored_replies(spark, folder).withColumn("replied_at", F.col("ask")))


def ask(
    requests: DataFrame,
    provider: Provider,
    folder: str,
    asking: Asking = Asking(),
    retry_errors: bool = False,
    on_replies: Callable[[int], None] | None = None,
) -> DataFrame:
    """Ask for what has no stored reply yet and return all stored replies as an answers table.

    With ``retry_errors`` a reply that can't be decoded is no reply. ``on_replies`` is told after each wave how many replies
    this call has brought so far. The driver holds counts only.
    """
    spark = requests.sparkSession
    last = stored_replies(spark, folder).agg(F.max("ask")).first()[0]
    number = 0 if last is None else last + 1
    still_open = requests.join(replied_keys(replied(spark, folder), retry_errors), "cache_key", "left_anti")
    waves = math.ceil(still_open.count() / asking.per_wave)
    if waves:
        pending = f"{folder}/pending/ask={number}"
        wave = F.pmod(F.xxhash64("cache_key"), F.lit(waves)).cast("int")
        still_open.withColumn("wave", wave).repartition("wave").write.mode("overwrite").partitionBy("wave").parquet(pending)
        stored = spark.read.schema(still_open.withColumn("wave", wave).schema).parquet(pending)
    total = 0
    for w in range(waves):
        observed = Observation()
        one = stored.filter(F.col("wave") == w).drop("wave").repartition(asking.tasks)
        replies = one.mapInPandas(_asker(provider, asking), REPLY_SCHEMA)
        counted = replies.observe(observed, F.count("raw_answer").alias("replies"), F.count("*").alias("asked"))
        counted.write.mode("overwrite").parquet(f"{folder}/replies/ask={number}/wave={w}")
        total += observed.get["replies"]
        if on_replies:
            on_replies(total)
        if observed.get["asked"] and not observed.get["replies"]:
            break  # the service is down; the rest stays open
    return replied(spark, folder)


def with_replies(answers: DataFrame, more: DataFrame) -> DataFrame:
    """An answers table with ``more`` replies: of two to one key the one that can be decoded, then any, then the added one."""
    columns = ["answer_key", "raw_answer", "answer_error"]
    both = answers.select(*columns, F.lit(0).alias("_added")).unionByName(more.select(*columns, F.lit(1).alias("_added")))
    rank = [decodable(F.col("raw_answer")), F.col("raw_answer").isNotNull(), F.col("answer_error").isNotNull(), F.col("_added")]
    return best_per_key(both, "answer_key", ["raw_answer", "answer_error"], rank)
