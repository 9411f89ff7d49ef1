"""Stage 1: from contacts with a website to one evaluated row per site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions import errors
from sievework.functions.answers import decodable, with_decoded, without_answer
from sievework.functions.keys import fetch_url
from sievework.functions.stages import WEBSITE, Stage
from sievework.operators.cache import cache_hits, cache_misses, combined, latest_entries, payload_columns
from sievework.operators.distinct import distinct_sites
from sievework.operators.lookup import answer_for_keys, page_flags_for_sites, page_for_sites
from sievework.operators.requests import website_requests


def with_faults(evaluated: DataFrame, stage: Stage, fault) -> DataFrame:
    """Replace the stage's columns by defaults and ``fault`` where that is not NULL."""
    defaults = without_answer(stage, fault)
    return evaluated.withColumns(
        {c: F.when(fault.isNotNull(), defaults[c]).otherwise(F.col(c)) for c in payload_columns(stage)}
    )


def evaluate_sites(sites: DataFrame, pages: DataFrame, answers: DataFrame) -> DataFrame:
    """Result columns for each site from the prepared pages and the answers.

    Only the page's flags are needed here, so no text is shuffled.
    """
    slim = sites.select("site", "cache_key", "fetch_url")
    decoded = with_decoded(answer_for_keys(page_flags_for_sites(slim, pages), answers), WEBSITE)
    fault = (
        F.when(F.col("page_error").isNotNull(), F.col("page_error"))
        .when(F.coalesce("page_blank", F.lit(True)), errors.EMPTY_PAGE)
        .when(F.col("answer_error").isNotNull(), F.col("answer_error"))
        .when(F.col(WEBSITE.error_column).isNull(), errors.NO_ANSWER)
    )
    faulted = decoded.withColumn("_fault", fault)
    return with_faults(faulted, WEBSITE, F.col("_fault")).select("site", "cache_key", *payload_columns(WEBSITE))


def website_results(
    contacts: DataFrame,
    pages: DataFrame,
    answers: DataFrame,
    cache: DataFrame | None = None,
    retry_errors: bool = False,
) -> DataFrame:
    """One row per site of contacts that carry lookup keys: cached results and freshly evaluated ones."""
    sites = distinct_sites(contacts).select("site", "cache_key", "fetch_url")
    if cache is None:
        return evaluate_sites(sites, pages, answers)
    latest = latest_entries(cache, WEBSITE)
    hits = cache_hits(sites, latest, WEBSITE, retry_errors).drop("fetch_url")
    return combined(hits, evaluate_sites(cache_misses(sites, latest, retry_errors), pages, answers))


def pending_website_requests(
    contacts: DataFrame, pages: DataFrame, answers: DataFrame, cache: DataFrame | None = None, retry_errors: bool = False
) -> DataFrame:
    """Requests for the sites of contacts that neither the cache nor the answers cover."""
    sites = distinct_sites(contacts)
    if cache is not None:
        sites = cache_misses(sites, latest_entries(cache, WEBSITE), retry_errors)
    return requests_for_sites(sites, pages, answers, retry_errors)


def replied_keys(answers: DataFrame, retry_errors: bool) -> DataFrame:
    """Keys that need no request: those with a reply; when errors are retried, only those whose reply can be decoded."""
    done = F.col("raw_answer").isNotNull()
    if retry_errors:
        done &= decodable(F.col("raw_answer"))
    return answers.filter(done).select(F.col("answer_key").alias("cache_key"))


def open_sites(sites: DataFrame, answers: DataFrame, retry_errors: bool = False) -> DataFrame:
    return sites.join(replied_keys(answers, retry_errors), "cache_key", "left_anti")


def pages_of(sites: DataFrame, pages: DataFrame) -> DataFrame:
    """The raw pages (``url``) of the given sites, so that no other page's text is made."""
    wanted = sites.select("fetch_url").distinct()
    return pages.join(wanted, fetch_url(F.col("url")) == F.col("fetch_url"), "left_semi")


def requests_for_sites(sites: DataFrame, pages: DataFrame, answers: DataFrame, retry_errors: bool = False) -> DataFrame:
    """Requests for the sites that have page text and no answer."""
    texts = page_for_sites(open_sites(sites, answers, retry_errors), pages).filter(~F.col("page_blank") & F.col("page_error").isNull())
    return website_requests(texts)
