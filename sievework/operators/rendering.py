"""Pages whose static text is too short are asked for once more, rendered; what comes back replaces their text.

Works on page texts (``page_id, page_url, page_text, page_blank, page_error``), so markup never moves: only the pages that need
rendering are joined, and their texts are short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.errors import FETCH_ERROR, prefixed
from sievework.functions.html import MAX_CHARS, MIN_STATIC_CHARS, with_page_text
from sievework.functions.text import is_blank
from sievework.operators.cache import combined
from sievework.operators.distinct import best_per_key


def needs_rendering() -> Column:
    """Whether the static fetch of a page failed or gave too little text."""
    return F.col("page_error").isNotNull() | (F.length("page_text") < MIN_STATIC_CHARS)


def rendered_texts(renderings: DataFrame, max_chars: int | None = MAX_CHARS) -> DataFrame:
    """``page_id, page_text, page_error``, one per page, from ``page_id, rendered_html``.

    Optional are ``render_error`` (``Type: message``) and ``rendered_at``. Of several renderings of a page one with markup comes
    first, then a failure, then the newest. The text is made before the shuffle. A failed one has no text.
    """
    failure = F.col("render_error") if "render_error" in renderings.columns else F.lit(None).cast("string")
    time = F.col("rendered_at") if "rendered_at" in renderings.columns else F.lit(None).cast("timestamp")
    texts = with_page_text(renderings, "rendered_html", "_text", max_chars)
    slim = texts.select("page_id", "_text", failure.alias("_failure"), time.alias("_time"))
    rank = [F.col("_text").isNotNull(), F.col("_failure").isNotNull(), F.col("_time")]
    return best_per_key(slim, "page_id", ["_text", "_failure"], rank).select(
        "page_id",
        F.coalesce("_text", F.lit("")).alias("page_text"),
        F.when(F.col("_text").isNull(), prefixed(FETCH_ERROR, F.col("_failure"))).alias("page_error"),
    )


def render_requests(texts: DataFrame, rendered: DataFrame | None = None, retry_errors: bool = False) -> DataFrame:
    """``page_id, page_url`` of pages to render: those that need it and have no rendering, or none but a failed one if retried."""
    wanted = texts.filter(needs_rendering()).select("page_id", "page_url")
    if rendered is None:
        return wanted
    done = rendered.filter(F.col("page_error").isNull()) if retry_errors else rendered
    return wanted.join(done.select("page_id"), "page_id", "left_anti")


def with_renderings(texts: DataFrame, rendered: DataFrame) -> DataFrame:
    """Page texts in which rendered pages have the rendering's text and error, also where it failed.

    A page that needs no rendering stays as it is and isn't shuffled; one whose rendering is awaited keeps its short text.
    """
    needs = needs_rendering()
    short = texts.filter(needs).select("page_id", "page_url", *[F.col(c).alias(f"_{c}") for c in ("page_text", "page_error")])
    come = rendered.select("page_id", "page_text", "page_error", F.lit(True).alias("_come"))
    joined = short.join(come, "page_id", "left")
    text = F.when(F.col("_come"), F.col("page_text")).otherwise(F.col("_page_text"))
    error = F.when(F.col("_come"), F.col("page_error")).otherwise(F.col("_page_error"))
    merged = joined.select("page_id", "page_url", text.alias("page_text"), is_blank(text).alias("page_blank"), error.alias("page_error"))
    return combined(texts.filter(~needs).select(merged.columns), merged)
