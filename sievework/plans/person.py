"""Stage 2: from contacts with a profile URL to one evaluated row per profile."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions import errors
from sievework.functions.answers import with_decoded
from sievework.functions.stages import PERSON, WEBSITE
from sievework.operators.cache import cache_entries, cache_hits, cache_misses, combined, latest_entries, payload_columns
from sievework.operators.distinct import distinct_profiles, distinct_sites
from sievework.operators.lookup import answer_for_keys, profile_for_people
from sievework.operators.profiles import trimmed_profile
from sievework.operators.requests import person_requests
from sievework.operators.stage_results import fill_missing_stage, merge_stage_results
from sievework.plans.asking import Asking, Provider, ask, with_replies
from sievework.plans.qualify import prepared
from sievework.plans.website import replied_keys, with_faults
from sievework.sinks.cache import append_entries
from sievework.sinks.results import write_requests, write_results
from sievework.sources.cache import read_cache
from sievework.sources.tables import read_requests


def evaluate_people(people: DataFrame, profiles: DataFrame, answers: DataFrame) -> DataFrame:
    """Result columns for each profile from the profile responses and the answers."""
    found = profiles.select("profile_url", "found", "profile_error")  # no body is shuffled
    slim = people.select("profile", "cache_key")
    decoded = with_decoded(answer_for_keys(profile_for_people(slim, found), answers), PERSON)
    fault = (
        F.when(F.col("profile_error").isNotNull(), F.col("profile_error"))
        .when(~F.coalesce("found", F.lit(False)), errors.PROFILE_NOT_FOUND)
        .when(F.col("answer_error").isNotNull(), F.col("answer_error"))
        .when(F.col(PERSON.error_column).isNull(), errors.NO_ANSWER)
    )
    faulted = decoded.withColumn("_fault", fault)
    return with_faults(faulted, PERSON, F.col("_fault")).select("profile", "cache_key", *payload_columns(PERSON))


def person_results(
    contacts: DataFrame,
    profiles: DataFrame,
    answers: DataFrame,
    cache: DataFrame | None = None,
    retry_errors: bool = False,
) -> DataFrame:
    """One row per profile of contacts that carry lookup keys."""
    people = distinct_profiles(contacts).select("profile", "cache_key")
    if cache is None:
        return evaluate_people(people, profiles, answers)
    latest = latest_entries(cache, PERSON)
    hits = cache_hits(people, latest, PERSON, retry_errors)
    return combined(hits, evaluate_people(cache_misses(people, latest, retry_errors), profiles, answers))


def pending_person_requests(contacts: DataFrame, profiles: DataFrame, answers: DataFrame, retry_errors: bool = False) -> DataFrame:
    """Requests for the found profiles of contacts without a reply."""
    return requests_for_people(distinct_profiles(contacts), profiles, answers, retry_errors)


def requests_for_people(people: DataFrame, profiles: DataFrame, answers: DataFrame, retry_errors: bool = False) -> DataFrame:
    """Requests for the found profiles without a reply; with ``retry_errors`` also for those whose reply can't be decoded."""
    people = people.join(replied_keys(answers, retry_errors), "cache_key", "left_anti")
    found = profile_for_people(people, profiles).filter(F.col("person").isNotNull())
    return person_requests(found.withColumn("profile_json", trimmed_profile(F.col("person"))))


def profile_counts(contacts: DataFrame) -> DataFrame:
    """Contacts per profile, which the distinct profiles hold already."""
    return distinct_profiles(contacts).select("profile", F.col("n_contacts").alias("n"))


def with_both_stages(contacts: DataFrame, sites: DataFrame, people: DataFrame) -> DataFrame:
    """Contacts that carry lookup keys with the columns of both stages, joined onto them one after the other."""
    counts = distinct_sites(contacts).select("site", F.col("n_contacts").alias("n"))
    merged = merge_stage_results(contacts, sites, WEBSITE, "site", counts)
    return with_person_stage(fill_missing_stage(merged, WEBSITE, "site", errors.NO_WEBSITE), people, profile_counts(contacts))


def run_people(
    contacts: DataFrame,
    profiles: DataFrame,
    answers: DataFrame,
    root: str,
    cache_path: str,
    run_id: str,
    run_time: datetime,
    retry_errors: bool = False,
    provider: Provider | None = None,
    asking: Asking = Asking(),
) -> DataFrame:
    """Evaluate the profiles of stored ``contacts`` and write every table of the run; returns the stored results.

    Tables below ``root``: ``people``, ``person_results`` (fresh), ``all_person_results`` (those and cached ones) and
    ``person_requests``. Fresh results are added to the stage's cache; repeating a run replaces what it wrote.
    """
    spark = contacts.sparkSession

    def kept(df: DataFrame, table: str) -> DataFrame:
        write_results(df, f"{root}/{table}")
        return spark.read.parquet(f"{root}/{table}")

    people = kept(distinct_profiles(prepared(contacts)), "people")
    latest = latest_entries(read_cache(spark, cache_path, PERSON, people).filter(F.col("run_id") != run_id), PERSON)
    misses = cache_misses(people, latest, retry_errors)
    write_requests(requests_for_people(misses, profiles, answers, retry_errors), f"{root}/person_requests")
    if provider:
        given = ask(read_requests(spark, f"{root}/person_requests"), provider, f"{root}/person_asked", asking, retry_errors)
        answers = with_replies(answers, given)
    fresh = kept(evaluate_people(misses, profiles, answers), "person_results")
    hits = cache_hits(people.select("profile", "cache_key"), latest, PERSON, retry_errors)
    results = kept(combined(hits, fresh), "all_person_results")
    append_entries(cache_entries(fresh, PERSON, F.lit(run_time)), cache_path, run_id, PERSON)
    return results


def with_person_stage(contacts: DataFrame, results: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Contacts that carry lookup keys with the stage's columns."""
    merged = merge_stage_results(contacts, results, PERSON, "profile", counts)
    return fill_missing_stage(merged, PERSON, "profile", errors.NO_LINKEDIN_URL)
