"""Whole runs: totals from the fixtures, invariances, re-runs from the cache, and the streaming form."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from sievework.catalog import inputs as fx
from sievework.functions.stages import WEBSITE
from sievework.operators.requests import answers_from
from sievework.operators.summary import run_summary
from sievework.plans.qualify import ADDED_COLUMNS, STAGE_NAME, RunPaths, prepared, qualify, run
from sievework.plans.website import pending_website_requests, website_results
from sievework.sources.cache import read_cache
from sievework.sources.tables import answers_from_replies, land_page_texts, page_texts
from sievework.streaming.incremental import contacts_stream, qualified_so_far, snapshot_of_all, start_incremental_run
from sievework.streaming.metrics import ProgressListener, with_run_metrics

SF = "/root/testdata/sf0.001"
NOW = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
COMPARED = ["contact_id", *[c for c in ADDED_COLUMNS if c != "qualified_at"]]


def rows(df, columns=COMPARED):
    return sorted(map(str, df.select(*columns).collect()))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("tables")
    contacts, answers = str(base / "contacts"), str(base / "answers")
    fx.contacts(spark, SF).repartition(6).write.parquet(contacts)
    fx.website_answers(spark, SF).write.parquet(answers)
    pages = land_page_texts(fx.table(spark, SF, "pages"), str(base / "pages"))
    return spark.read.parquet(contacts), pages, spark.read.parquet(answers), contacts


@pytest.fixture(scope="module")
def plain(spark, tables):
    contacts, pages, answers, _ = tables
    return rows(qualify(contacts, pages, answers, F.lit(NOW)))


@pytest.mark.parametrize(
    "sf, kept, tiers, score_sum",
    [
        ("0.001", 142, {"ideal": 15, "hot": 9, "warm": 18, "cold": 88, "disqualified": 12}, 321),
        ("0.01", 1425, {"ideal": 168, "hot": 54, "warm": 168, "cold": 861, "disqualified": 174}, 3006),
        ("0.1", 14250, {"ideal": 1710, "hot": 576, "warm": 1710, "cold": 8544, "disqualified": 1710}, 30828),
    ],
)
def test_totals(spark, sf, kept, tiers, score_sum):
    sf_dir = f"/root/testdata/sf{sf}"
    df = qualify(fx.contacts(spark, sf_dir), fx.prepared_pages(spark, sf_dir), fx.website_answers(spark, sf_dir), fx.run_time())
    summary = run_summary(df).first()
    assert summary["total"] == kept and summary["tiers"] == tiers
    assert summary["avg_final_score"] == round(score_sum / kept, 2)


def test_order_and_partitions_do_not_matter(spark, tables, plain):
    contacts, pages, answers, _ = tables
    shuffled = contacts.orderBy(F.rand(3)).repartition(11)
    assert rows(qualify(shuffled, pages.repartition(5), answers.repartition(7), F.lit(NOW))) == plain


def test_no_contacts(spark, tables):
    contacts, pages, answers, _ = tables
    nobody = contacts.filter("false")
    assert run_summary(qualify(nobody, pages, answers, F.lit(NOW))).first()["total"] == 0


def test_run_and_rerun_from_cache(spark, tables, plain, tmp_path):
    contacts, pages, answers, _ = tables
    paths, calls = RunPaths(str(tmp_path / "out"), str(tmp_path / "cache")), []
    summary = run(
        contacts, pages, answers, paths, "r1", NOW, csv=True,
        on_total=lambda n: calls.append(n), on_progress=lambda stage, n: calls.append((stage, n)),
    )
    assert (summary["total"], calls) == (142, [142, (STAGE_NAME, 0), (STAGE_NAME, 120)])
    assert rows(spark.read.parquet(paths.of("qualified"))) == plain
    assert spark.read.parquet(paths.of("skipped")).count() == 8
    pending = spark.read.json(paths.of("requests"))
    assert pending.count() == len([r for r in website_results(prepared(contacts), pages, answers).collect() if r["s1_error"] == "no_answer"])
    assert spark.read.option("header", True).csv(paths.of("qualified_csv")).filter("hot_lead = 'True'").count() == summary["hot_leads"]

    # Repeating the run changes nothing, nor does a later run, which finds everything cached.
    assert run(contacts, pages, answers, paths, "r1", NOW) == summary
    again = RunPaths(str(tmp_path / "again"), paths.cache)
    no_pages, no_answers = pages.filter("false"), answers.filter("false")
    run(contacts.filter("segment is not null"), pages, answers, again, "r2", NOW)
    evaluated = spark.read.parquet(again.of("site_results"))
    assert evaluated.filter("s1_error <> 'no_answer'").count() == 0
    hits = read_cache(spark, paths.cache, WEBSITE).filter("run_id = 'r1'")
    known = qualify(contacts, no_pages, no_answers, F.lit(NOW), cache=hits)
    assert rows(known.filter("s1_error not in ('empty_page')")) == [r for r in plain if "no_answer" not in r and "'empty_page'" not in r]


def test_retrying_errors(spark, tables, tmp_path):
    contacts, pages, answers, _ = tables
    paths = RunPaths(str(tmp_path / "out"), str(tmp_path / "cache"))
    run(contacts, pages.filter("false"), answers, paths, "r1", NOW)  # nothing crawled yet
    stuck = run(contacts, pages, answers, paths, "r2", NOW)
    assert stuck["hot_leads"] == 0
    retried = run(contacts, pages, answers, paths, "r3", NOW, retry_errors=True)
    assert retried["hot_leads"] == 24


def test_plugged_in_provider(spark, tables):
    contacts, pages, answers, _ = tables
    requests = pending_website_requests(prepared(contacts), pages, answers.filter("false"))
    assert requests.count() == requests.select("cache_key").distinct().count() > 0

    def provider(batches):
        for batch in batches:
            yes = batch["user"].str.contains("Company 1")
            batch["raw_answer"] = yes.map({True: '{"q1_sells_payments":1,"q2_is_independent_iso":1}', False: "{}"})
            yield batch.rename(columns={"cache_key": "answer_key"})[["answer_key", "raw_answer"]]

    given = answers_from_replies(answers_from(requests, provider))
    tiers = run_summary(qualify(contacts, pages, given, F.lit(NOW))).first()["tiers"]
    assert set(tiers) == {"warm", "disqualified", "cold"}


def test_incremental_run(spark, tables, plain, tmp_path):
    contacts, pages, answers, path = tables
    paths = RunPaths(str(tmp_path / "out"), str(tmp_path / "cache"))
    summaries = {}

    def start():
        stream = contacts_stream(spark, path, contacts.schema, files_per_batch=2)
        query = start_incremental_run(
            stream, lambda s: (pages, answers), paths, "inc", NOW, str(tmp_path / "checkpoint"), on_summary=summaries.__setitem__
        )
        query.awaitTermination()

    start()
    batches = len(summaries)
    assert batches >= 3
    assert rows(qualified_so_far(spark, paths)) == plain
    assert sum(s["total"] for s in summaries.values()) == 142
    assert qualified_so_far(spark, paths, 0).count() == summaries[0]["total"]

    partial = snapshot_of_all(contacts, paths, 0, F.lit(NOW))
    assert partial.count() == 142
    unfinished = partial.filter("s1_error is null")
    assert unfinished.count() > 0
    assert {(r["final_score"], r["lead_tier"]) for r in unfinished.collect()} == {(0.0, "cold")}
    finished = rows(snapshot_of_all(contacts, paths, batches - 1, F.lit(NOW)).filter("s1_error is not null"))
    assert finished == [r for r in plain if "'no_website'" not in r]

    # Restarting processes only what is new.
    start()
    assert len(summaries) == batches
    fx.contacts(spark, SF).limit(5).withColumn("contact_id", F.col("contact_id") + 100000).coalesce(1).write.mode("append").parquet(path)
    start()
    assert len(summaries) == batches + 1


def test_metrics_of_a_stream(spark, tables, tmp_path):
    contacts, _, _, path = tables
    seen, totals = [], []
    listener = ProgressListener("Stage 1", lambda stage, n: seen.append((stage, n)), totals.append)
    spark.streams.addListener(listener)
    try:
        stream = with_run_metrics(contacts_stream(spark, path, contacts.schema, files_per_batch=3), F.trim("website") != "")
        query = (
            stream.writeStream.format("parquet")
            .option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    everyone = spark.read.parquet(str(tmp_path / "out"))
    assert seen[-1] == ("Stage 1", everyone.filter("trim(website) <> ''").count())
    assert totals == sorted(totals) and totals[-1] == everyone.count() and len(totals) >= 2


def test_pages_are_landed_as_computed(spark, tables):
    _, pages, _, _ = tables
    assert rows(pages, pages.columns) == rows(page_texts(fx.table(spark, SF, "pages")), pages.columns)
