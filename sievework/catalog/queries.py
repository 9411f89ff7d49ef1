"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.catalog import inputs as fx
from sievework.functions import errors
from sievework.functions.answers import with_decoded
from sievework.functions.html import with_page_text
from sievework.functions.keys import cache_key, fetch_url
from sievework.functions.rubric import WEBSITE_RULES, evidence
from sievework.functions.scoring import with_scores, with_weighted_score
from sievework.functions.stages import PERSON, WEBSITE
from sievework.functions.text import strip
from sievework.operators import cache as cache_ops
from sievework.operators import contacts as contact_ops
from sievework.operators import rendering, summary
from sievework.operators.distinct import distinct_profiles, distinct_sites
from sievework.operators.lookup import answer_for_keys, page_for_sites, profile_for_people
from sievework.operators.profiles import trimmed_profile
from sievework.operators.progress import job_snapshots
from sievework.operators.requests import answers_from_rubric
from sievework.operators.stage_results import default_rows
from sievework.plans.person import pending_person_requests, person_results, profile_counts, with_both_stages, with_person_stage
from sievework.plans.qualify import checkpoint_snapshot, prepared, qualify
from sievework.plans.website import open_sites, pages_of, requests_for_sites, website_results
from sievework.session import configure
from sievework.sinks.results import csv_values
from sievework.sources.contacts import normalise_columns
from sievework.sources.tables import answers_from_replies, page_texts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(configure(spark), sf_dir)

    QUERIES[build.__name__] = configured
    return configured


def _qualified(spark, sf_dir):
    return qualify(fx.contacts(spark, sf_dir), fx.prepared_pages(spark, sf_dir), fx.website_answers(spark, sf_dir), fx.run_time())


def _site_results(spark, sf_dir):
    ready = prepared(fx.contacts(spark, sf_dir))
    return website_results(ready, fx.prepared_pages(spark, sf_dir), fx.website_answers(spark, sf_dir))


@query
def contacts_prepared(spark, sf_dir):
    raw = fx.contacts(spark, sf_dir).toDF("contact_id", " Name", "Company ", "WebSite", "Linkedin URL", "Market Segment")
    normal = normalise_columns(raw.drop("Linkedin URL"))
    return contact_ops.add_optional_columns(contact_ops.require_columns(normal))


@query
def contacts_kept(spark, sf_dir):
    return contact_ops.kept(fx.contacts(spark, sf_dir))


@query
def contacts_skipped(spark, sf_dir):
    return contact_ops.skipped(fx.contacts(spark, sf_dir))


@query
def contacts_with_website(spark, sf_dir):
    return contact_ops.with_website(fx.contacts(spark, sf_dir))


@query
def contacts_with_profile_url(spark, sf_dir):
    return contact_ops.with_profile_url(fx.contacts(spark, sf_dir))


@query
def stripped_text(spark, sf_dir):
    text = strip(F.col("text"))
    return fx.padded_texts(spark, sf_dir).select("doc_id", text.alias("stripped"), F.length(text).cast("long").alias("n"))


@query
def cache_keys(spark, sf_dir):
    return fx.contacts(spark, sf_dir).select(
        "contact_id",
        cache_key(F.lit("s1"), F.col("website")).alias("site_key"),
        cache_key(F.lit("s2"), F.col("linkedin_url")).alias("person_key"),
    )


@query
def fetch_urls(spark, sf_dir):
    return fx.contacts(spark, sf_dir).select("contact_id", fetch_url(F.col("website")).alias("fetch_url"))


@query
def sites_distinct(spark, sf_dir):
    return distinct_sites(prepared(fx.contacts(spark, sf_dir)))


@query
def profiles_distinct(spark, sf_dir):
    return distinct_profiles(prepared(fx.contacts(spark, sf_dir)))


@query
def page_text(spark, sf_dir):
    return with_page_text(fx.table(spark, sf_dir, "pages")).select("page_id", "page_text")


@query
def page_rendered(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages").withColumn("rendered_html", F.concat("html", "html"))
    return page_texts(pages).select("page_id", "page_text")


@query
def page_flags(spark, sf_dir):
    return page_texts(fx.failing_pages(spark, sf_dir)).select("page_id", "page_url", "page_blank", "page_error")


@query
def render_requests(spark, sf_dir):
    return rendering.render_requests(fx.static_texts(spark, sf_dir), rendering.rendered_texts(fx.renderings(spark, sf_dir)))


@query
def page_renderings(spark, sf_dir):
    merged = rendering.with_renderings(fx.static_texts(spark, sf_dir), rendering.rendered_texts(fx.renderings(spark, sf_dir)))
    return merged.select("page_id", "page_url", "page_text", "page_blank", "page_error")


@query
def page_lookup(spark, sf_dir):
    sites = distinct_sites(prepared(fx.contacts(spark, sf_dir))).select("site", "fetch_url")
    return page_for_sites(sites, fx.prepared_pages(spark, sf_dir).select("page_id", "page_url", "page_text"))


@query
def answer_lookup(spark, sf_dir):
    sites = distinct_sites(prepared(fx.contacts(spark, sf_dir))).select("site", "cache_key")
    return answer_for_keys(sites, fx.website_answers(spark, sf_dir)).select("site", "raw_answer")


@query
def website_requests(spark, sf_dir):
    sites = distinct_sites(prepared(fx.contacts(spark, sf_dir)))
    answers = fx.website_answers(spark, sf_dir)
    pages = pages_of(open_sites(sites, answers), fx.crawled_pages(spark, sf_dir))
    return requests_for_sites(sites, page_texts(pages), answers)


@query
def answers_decoded(spark, sf_dir):
    return with_decoded(fx.website_replies(spark, sf_dir).drop("answer_key"), WEBSITE).drop("s1_score")


@query
def website_scores(spark, sf_dir):
    return _site_results(spark, sf_dir).select("site", "s1_score", "s1_error")


@query
def profile_lookup(spark, sf_dir):
    people = distinct_profiles(prepared(fx.contacts(spark, sf_dir))).select("profile")
    found = profile_for_people(people, fx.profiles(spark, sf_dir))
    return found.select("profile", F.try_variant_get("person", "$.full_name", "string").alias("full_name"))


@query
def profile_trimmed(spark, sf_dir):
    profiles = fx.profiles(spark, sf_dir).filter(F.col("person").isNotNull())
    return profiles.select("profile_url", trimmed_profile(F.col("person")).alias("profile_json"))


@query
def person_requests(spark, sf_dir):
    some = fx.first_person_answers(spark, sf_dir)
    return pending_person_requests(prepared(fx.contacts(spark, sf_dir)), fx.profiles(spark, sf_dir), some)


@query
def person_answers_decoded(spark, sf_dir):
    return with_decoded(fx.person_replies(spark, sf_dir).drop("answer_key"), PERSON).drop("s2_score")


@query
def person_scores(spark, sf_dir):
    results = person_results(prepared(fx.contacts(spark, sf_dir)), fx.profiles(spark, sf_dir), fx.person_answers(spark, sf_dir))
    return results.select("profile", "s2_title", "s2_score", "s2_error")


@query
def qualified_people(spark, sf_dir):
    ready = prepared(fx.contacts(spark, sf_dir))
    results = person_results(ready, fx.profiles(spark, sf_dir), fx.person_answers(spark, sf_dir))
    return with_person_stage(ready, results, profile_counts(ready)).select("contact_id", *PERSON.result_columns)


@query
def weighted_leads(spark, sf_dir):
    ready = prepared(fx.contacts(spark, sf_dir))
    people = person_results(ready, fx.profiles(spark, sf_dir), fx.person_answers(spark, sf_dir))
    sites = website_results(ready, fx.prepared_pages(spark, sf_dir), fx.website_answers(spark, sf_dir))
    return with_weighted_score(with_both_stages(ready, sites, people).select("contact_id", "s1_score", "s2_score"))


@query
def rubric_evidence(spark, sf_dir):
    found = evidence(F.col("text"), WEBSITE_RULES, [q.field for q in WEBSITE.questions])
    return fx.texts_with_phrases(spark, sf_dir).select("doc_id", *[c.alias(f) for f, c in found.items()])


@query
def rubric_leads(spark, sf_dir):
    contacts, pages = fx.contacts(spark, sf_dir), page_texts(fx.table(spark, sf_dir, "pages"), max_chars=None)
    texts = pages.select(cache_key(F.lit("s1"), F.col("page_url")).alias("cache_key"), "page_text")
    answers = answers_from_replies(answers_from_rubric(texts, "page_text", WEBSITE_RULES, WEBSITE))
    return qualify(contacts, pages, answers, fx.run_time()).select("contact_id", "s1_score", "s1_error", "lead_tier")


@query
def text_rows_scored(spark, sf_dir):
    return with_scores(fx.text_rows(spark, sf_dir)).select("row_id", "final_score", "lead_tier", "hot_lead")


@query
def stage_defaults(spark, sf_dir):
    ready = prepared(fx.contacts(spark, sf_dir))
    return default_rows(ready, contact_ops.with_website(ready), WEBSITE, errors.NO_WEBSITE)


@query
def qualified_leads(spark, sf_dir):
    return _qualified(spark, sf_dir)


@query
def qualified_leads_cached(spark, sf_dir):
    contacts, pages, answers = fx.contacts(spark, sf_dir), fx.prepared_pages(spark, sf_dir), fx.website_answers(spark, sf_dir)
    return qualify(contacts, pages, answers, fx.run_time(), cache=fx.website_cache(spark, sf_dir))


@query
def csv_leads(spark, sf_dir):
    return csv_values(_qualified(spark, sf_dir)).drop("qualified_at")


@query
def error_counts(spark, sf_dir):
    return summary.error_counts(_qualified(spark, sf_dir))


@query
def tier_counts(spark, sf_dir):
    return summary.tier_counts(_qualified(spark, sf_dir))


@query
def tier_scorecard(spark, sf_dir):
    return summary.tier_scorecard(_qualified(spark, sf_dir))


@query
def run_summary(spark, sf_dir):
    return summary.run_summary(_qualified(spark, sf_dir)).withColumn("tiers", F.to_json("tiers"))


@query
def checkpoint_leads(spark, sf_dir):
    done = _site_results(spark, sf_dir).filter(F.col("s1_error") != errors.NO_ANSWER)
    return checkpoint_snapshot(fx.contacts(spark, sf_dir), done, fx.run_time())


@query
def cache_latest(spark, sf_dir):
    latest = cache_ops.latest_entries(fx.website_cache(spark, sf_dir), WEBSITE)
    return latest.select("cache_key", "stage", F.col("result.s1_score").alias("s1_score"), "error", "written_at")


@query
def cache_hits(spark, sf_dir):
    sites = distinct_sites(prepared(fx.contacts(spark, sf_dir))).select("site", "cache_key")
    latest = cache_ops.latest_entries(fx.website_cache(spark, sf_dir), WEBSITE)
    return cache_ops.cache_hits(sites, latest, WEBSITE).select("site", "cache_key", "s1_score", "s1_error")


@query
def cache_misses(spark, sf_dir):
    sites = distinct_sites(prepared(fx.contacts(spark, sf_dir))).select("site", "cache_key")
    latest = cache_ops.latest_entries(fx.website_cache(spark, sf_dir), WEBSITE)
    return cache_ops.cache_misses(sites, latest, retry_errors=True)


@query
def cache_after_delete(spark, sf_dir):
    cache = fx.website_cache(spark, sf_dir)
    machinery = prepared(fx.contacts(spark, sf_dir).filter(F.col("segment") == "MACHINERY"))
    left = cache_ops.without_keys(cache, distinct_sites(machinery))
    return left.select("cache_key", "stage", "error", "written_at")


@query
def cache_stats(spark, sf_dir):
    return cache_ops.cache_stats(cache_ops.latest_entries(fx.website_cache(spark, sf_dir), WEBSITE))


@query
def results_combined(spark, sf_dir):
    ready = prepared(fx.contacts(spark, sf_dir))
    results = website_results(
        ready, fx.prepared_pages(spark, sf_dir), fx.website_answers(spark, sf_dir), fx.website_cache(spark, sf_dir), retry_errors=True
    )
    return results.select("site", "s1_score", "s1_error")


@query
def job_progress(spark, sf_dir):
    return job_snapshots(fx.job_events(spark, sf_dir))


@query
def run_metrics(spark, sf_dir):
    """What the running query reports: rows evaluated so far and rows in all, from stored results."""
    evaluated = F.count_if(F.col("s1_error") != errors.NO_WEBSITE).alias("processed")
    return _qualified(spark, sf_dir).agg(evaluated, F.count("*").alias("rows"))
