"""The qualification of a contact list, as one lazy plan and as a run with stored intermediate tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import errors
from sievework.functions.scoring import with_scores
from sievework.functions.stages import WEBSITE
from sievework.operators.cache import cache_entries, cache_hits, combined, latest_entries
from sievework.operators.contacts import (
    add_optional_columns,
    kept,
    reject_result_columns,
    require_columns,
    skipped,
    with_lookup_keys,
)
from sievework.operators.distinct import distinct_sites
from sievework.operators.stage_results import fill_missing_stage, merge_stage_results
from sievework.operators.summary import run_summary
from sievework.plans.asking import Asking, Provider, ask, with_replies
from sievework.plans.website import evaluate_sites, requests_for_sites, website_results
from sievework.sinks.cache import append_entries
from sievework.sinks.results import write_requests, write_results, write_results_csv
from sievework.sources.cache import read_cache
from sievework.sources.tables import read_requests

ADDED_COLUMNS = [*WEBSITE.result_columns, "final_score", "lead_tier", "hot_lead", "qualified_at"]
STAGE_NAME = "Stage 1 — Website"
ASKING_NAME = "Stage 1 — Replies"


def prepared(contacts: DataFrame) -> DataFrame:
    """Contacts that can be looked up, with their keys."""
    checked = reject_result_columns(require_columns(contacts), ADDED_COLUMNS)
    return with_lookup_keys(kept(add_optional_columns(checked)))


def scored(contacts: DataFrame, results: DataFrame, qualified_at: Column, counts: DataFrame | None = None) -> DataFrame:
    """Join results back to prepared contacts, score them and stamp the run time."""
    joined = merge_stage_results(contacts, results, WEBSITE, "site", counts)
    merged = fill_missing_stage(joined, WEBSITE, "site", errors.NO_WEBSITE)
    return with_scores(merged.drop("site", "profile")).withColumn("qualified_at", qualified_at)


def qualify(
    contacts: DataFrame,
    pages: DataFrame,
    answers: DataFrame,
    qualified_at: Column,
    cache: DataFrame | None = None,
    retry_errors: bool = False,
) -> DataFrame:
    """Contacts with website or profile URL, their website answers, score, tier and hot flag."""
    ready = prepared(contacts)
    results = website_results(ready, pages, answers, cache, retry_errors)
    return _in_order(scored(ready, results, qualified_at, site_counts(distinct_sites(ready))), contacts)


def site_counts(sites: DataFrame) -> DataFrame:
    """Contacts per site, which the sites hold already."""
    return sites.select("site", F.col("n_contacts").alias("n"))


def checkpoint_snapshot(contacts: DataFrame, finished: DataFrame, qualified_at: Column) -> DataFrame:
    """The scored view of all contacts while only ``finished`` sites have results; others have NULL answers."""
    ready = prepared(contacts)
    merged = merge_stage_results(ready, finished, WEBSITE, "site", site_counts(distinct_sites(ready))).drop("site", "profile")
    return _in_order(with_scores(merged).withColumn("qualified_at", qualified_at), contacts)


def _in_order(df: DataFrame, contacts: DataFrame) -> DataFrame:
    return df.select(*add_optional_columns(contacts).columns, *ADDED_COLUMNS)


@dataclass(frozen=True)
class RunPaths:
    """Folders of one run below a shared output folder."""

    root: str
    cache: str

    def of(self, table: str, part: str = "") -> str:
        return f"{self.root}/{table}{part}"


def run(
    contacts: DataFrame,
    pages: DataFrame,
    answers: DataFrame,
    paths: RunPaths,
    run_id: str,
    run_time: datetime,
    part: str = "",
    retry_errors: bool = False,
    csv: bool = False,
    on_total: Callable[[int], None] | None = None,
    on_progress: Callable[[str, int], None] | None = None,
    provider: Provider | None = None,
    asking: Asking = Asking(),
) -> dict:
    """Qualify stored ``contacts`` and write every table of the run; returns the summary.

    Tables: ``skipped``, ``sites``, ``cached_results``, ``requests``, ``site_results`` (fresh), ``qualified`` (and
    ``qualified_csv``), each below ``paths.root`` with the suffix ``part``; fresh results are added to the cache. Each step reads
    what the one before has written, so a lost executor costs tasks, not the run, and repeating a run
    overwrites its own tables and cache partition only.

    A ``provider`` is asked the requests, as ``asking`` says, and its replies (kept in ``asked``) count like ``answers``.
    ``on_progress`` is told how many contacts' sites have a result when the cached ones are found and when the
    others are evaluated, and in between, under ``ASKING_NAME``, how many replies the provider has given.
    """
    spark = contacts.sparkSession
    ready = prepared(contacts)
    if on_total:
        on_total(ready.count())

    def stored(df: DataFrame, table: str) -> DataFrame:
        write_results(df, paths.of(table, part))
        return spark.read.parquet(paths.of(table, part))

    def report(finished: DataFrame) -> None:
        if on_progress:
            n = F.coalesce(F.sum("n_contacts"), F.lit(0))
            on_progress(STAGE_NAME, sites.join(finished, "site", "left_semi").agg(n).first()[0])

    stored(skipped(add_optional_columns(contacts)), "skipped")
    sites = stored(distinct_sites(ready), "sites")
    # What other runs have cached; this run's own entries are left out so that repeating it starts afresh.
    cache = read_cache(spark, paths.cache, WEBSITE, sites).filter(F.col("run_id") != run_id)
    latest = latest_entries(cache, WEBSITE)
    hits = stored(cache_hits(sites.select("site", "cache_key"), latest, WEBSITE, retry_errors), "cached_results")
    report(hits)
    misses = sites.join(hits.select("site"), "site", "left_anti")
    write_requests(requests_for_sites(misses, pages, answers, retry_errors), paths.of("requests", part))
    if provider:
        told = (lambda n: on_progress(ASKING_NAME, n)) if on_progress else None
        given = ask(read_requests(spark, paths.of("requests", part)), provider, paths.of("asked"), asking, retry_errors, told)
        answers = with_replies(answers, given)
    fresh = stored(evaluate_sites(misses, pages, answers), "site_results")
    results = combined(hits, fresh)
    report(results)

    scores = scored(ready, results, F.lit(run_time), site_counts(sites))
    qualified = stored(_in_order(scores, contacts), "qualified")
    append_entries(cache_entries(fresh, WEBSITE, F.lit(run_time)), paths.cache, run_id)
    if csv:
        write_results_csv(qualified, paths.of("qualified_csv", part))
    return run_summary(qualified).first().asDict()
