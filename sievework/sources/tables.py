"""Tables that stand for the network calls: crawled pages, profile responses, answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions.answers import decodable
from sievework.functions.errors import API_ERROR, FETCH_ERROR, PROFILE_ERROR, prefixed
from sievework.functions.html import MAX_CHARS, MIN_STATIC_CHARS, rendered_or_static, with_page_text
from sievework.functions.keys import fetch_url, normal_url
from sievework.functions.text import is_blank
from sievework.operators.distinct import best_per_key
from sievework.operators.profiles import found_person


def page_texts(pages: DataFrame, max_chars: int | None = MAX_CHARS) -> DataFrame:
    """Pages as ``page_id, page_url, page_text, page_blank, page_error``.

    ``pages`` has a unique ``page_id``, ``url`` and ``html``; optional are ``rendered_html``, used where the
    static text is short, and ``fetch_error`` (``Type: message``). The text is made where the page is read,
    before any shuffle, so at most ``max_chars`` characters of a page ever move; None keeps whole texts.
    """
    texts = with_page_text(pages, "html", "_static", max_chars)
    rendered = None
    if "rendered_html" in pages.columns:
        # Rendered pages are only looked into where they are needed.
        needed = F.when(F.length(F.coalesce("_static", F.lit(""))) < MIN_STATIC_CHARS, F.col("rendered_html"))
        texts = with_page_text(texts.withColumn("_needed", needed), "_needed", "_rendered", max_chars)
        rendered = F.col("_rendered")
    error = prefixed(FETCH_ERROR, F.col("fetch_error")) if "fetch_error" in pages.columns else F.lit(None).cast("string")
    text = F.coalesce(rendered_or_static(F.col("_static"), rendered), F.lit(""))
    return texts.select(
        "page_id",
        fetch_url(F.col("url")).alias("page_url"),
        text.alias("page_text"),
        is_blank(text).alias("page_blank"),
        error.alias("page_error"),
    )


def land_page_texts(pages: DataFrame, out: str, max_chars: int | None = MAX_CHARS) -> DataFrame:
    """Make the texts of a crawl once for any number of runs."""
    page_texts(pages, max_chars).write.mode("overwrite").parquet(out)
    return pages.sparkSession.read.parquet(out)


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Profile responses stored as JSON lines ``{"profile_url": ..., "data": {...}}``."""
    return profiles_from_responses(spark.read.schema("profile_url string, data variant").json(path), "data")


def profiles_from_responses(responses: DataFrame, data: str) -> DataFrame:
    """``profile_url, person, found, profile_error``, one per normal URL; a response without data found nobody.

    ``data`` is JSON text or VARIANT. Optional ``lookup_error`` (``Type: message``) marks failed lookups. Of several
    responses to one URL one that holds a person comes first, then any with data, then the newest by the optional
    ``responded_at``.
    """
    body = F.col(data)
    if isinstance(responses.schema[data].dataType, T.VariantType):
        body = F.to_json(body)
    failure = F.col("lookup_error") if "lookup_error" in responses.columns else F.lit(None).cast("string")
    time = F.col("responded_at") if "responded_at" in responses.columns else F.lit(None).cast("timestamp")
    slim = responses.select(
        normal_url(F.col("profile_url")).alias("profile_url"), body.alias("_text"), failure.alias("_failure"), time.alias("_time")
    )
    found = slim.withColumn("_found", found_person(F.col("_text")).isNotNull())
    found = found.withColumn("_any", F.col("_text").isNotNull())
    chosen = best_per_key(found, "profile_url", ["_text", "_failure", "_found", "_any"], [F.col("_found"), F.col("_any"), F.col("_time")])
    return chosen.select(
        "profile_url",
        found_person(F.col("_text")).alias("person"),
        F.col("_found").alias("found"),
        F.when(~F.col("_any"), prefixed(PROFILE_ERROR, F.col("_failure"))).alias("profile_error"),
    )


def answers_from_replies(replies: DataFrame) -> DataFrame:
    """``answer_key, raw_answer, answer_error``, one per key.

    Optional ``failure`` (``Type: message``) marks failed calls. Of several replies to one key one that can be decoded
    comes first, then any reply, then a failure; among equals the newest by the optional ``replied_at``.
    """
    failure = F.col("failure") if "failure" in replies.columns else F.lit(None).cast("string")
    time = F.col("replied_at") if "replied_at" in replies.columns else F.lit(None).cast("timestamp")
    slim = replies.select("answer_key", "raw_answer", failure.alias("_failure"), time.alias("_time"))
    rank = [decodable(F.col("raw_answer")), F.col("raw_answer").isNotNull(), F.col("_failure").isNotNull(), F.col("_time")]
    return best_per_key(slim, "answer_key", ["raw_answer", "_failure"], rank).select(
        "answer_key",
        "raw_answer",
        F.when(F.col("raw_answer").isNull(), prefixed(API_ERROR, F.col("_failure"))).alias("answer_error"),
    )


def read_answers(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Stored replies, as Parquet or JSON lines."""
    if file_format == "json":
        return answers_from_replies(spark.read.schema("answer_key string, raw_answer string, failure string").json(path))
    return answers_from_replies(spark.read.parquet(path))


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Requests that a run has written."""
    return spark.read.schema("cache_key string, system string, user string, max_tokens int").json(path)
