"""Asking a service from within a run: nothing that has a reply is asked twice, whatever fails."""

from datetime import datetime, timezone
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sievework.functions.keys import cache_key
from sievework.operators.contacts import skipped
from sievework.plans.asking import REPLY_SCHEMA, Asking, ask, replied, replies_to, stored_replies, with_replies
from sievework.plans.person import run_people
from sievework.plans.qualify import ASKING_NAME, STAGE_NAME, RunPaths, run
from sievework.sources.tables import answers_from_replies, page_texts, profiles_from_responses
from sievework.streaming.incremental import contacts_stream, qualified_so_far, start_incremental_run

NOW = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
GOOD = '{"q1_sells_payments":true,"q2_is_independent_iso":true}'
QUICK = Asking(per_wave=10, tasks=2, at_once=3, attempts=2, first_wait=0.0, longest_wait=0.0, give_up=2)


def requests(spark, n):
    key = F.concat(F.lit("k"), F.col("id").cast("string"))
    return spark.range(n).select(key.alias("cache_key"), F.lit("s").alias("system"), F.col("id").cast("string").alias("user"), F.lit(1).alias("max_tokens"))


def service(log, fails=lambda keys, calls: False):
    """A provider that notes each key it replies to as a line of a file; where ``fails`` says so it dies in the middle."""

    def provider(batches):
        for batch in batches:
            calls = len(Path(log).read_text().split()) if Path(log).exists() else 0
            for i, row in enumerate(batch.itertuples()):
                if fails(row.cache_key, calls) and i >= len(batch) // 2:
                    raise ConnectionError("gone")
                with open(log, "a") as file:
                    file.write(row.cache_key + "\n")
                yield pd.DataFrame({"answer_key": [row.cache_key], "raw_answer": [GOOD]})

    return provider


def test_calls_of_one_batch():
    batch = pd.DataFrame({"cache_key": ["a", "b", "c", "b"], "user": "u"})
    seen = []

    def flaky(batches):
        for b in batches:
            seen.append(list(b["cache_key"]))
            yield pd.DataFrame({"answer_key": ["a", "a", "x"], "raw_answer": ["1", "2", "3"]})
            if len(seen) < 3:
                raise TimeoutError("slow")
            yield pd.DataFrame({"answer_key": ["b", "c"], "raw_answer": ["4", None]})

    got = replies_to(batch, flaky, Asking(first_wait=0.0))
    assert seen == [["a", "b", "c", "b"], ["b", "c", "b"], ["b", "c", "b"]]
    want = [("a", "1", None), ("b", "4", None), ("c", None, "NoReply: the service left the request out")]
    assert list(got.itertuples(index=False, name=None)) == want
    down = replies_to(batch.head(1), lambda b: (_ for _ in ()).throw(TimeoutError("slow")), QUICK)
    assert list(down.itertuples(index=False, name=None)) == [("a", None, "TimeoutError: slow")]


def test_a_provider_that_dies_is_asked_no_key_twice(spark, tmp_path):
    folder, log, told = str(tmp_path / "asked"), str(tmp_path / "log"), []
    # After some 25 replies the service fails for good: the task gives up, and so does the call.
    first = ask(requests(spark, 60), service(log, lambda key, calls: calls > 25), folder, QUICK, on_replies=told.append)
    got = first.filter("raw_answer is not null").count()
    assert 0 < got < 60 and got == len(Path(log).read_text().split()) and told == sorted(told)
    assert first.filter("raw_answer is null").filter("answer_error like 'api_error: ConnectionError: gone'").count() > 0
    second = ask(requests(spark, 60), service(log), folder, QUICK)
    asked = Path(log).read_text().split()
    assert len(asked) == len(set(asked)) == 60
    assert second.filter("raw_answer is not null and answer_error is null").count() == second.count() == 60
    # Nothing is open any more.
    ask(requests(spark, 60), service(log), folder, QUICK)
    assert len(Path(log).read_text().split()) == 60


def test_a_job_that_is_killed_between_waves_goes_on_where_it_was(spark, tmp_path):
    folder, log = str(tmp_path / "asked"), str(tmp_path / "log")

    def killed(total):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        ask(requests(spark, 40), service(log), folder, QUICK, on_replies=killed)
    once = len(Path(log).read_text().split())
    assert 0 < once < 40
    ask(requests(spark, 40), service(log), folder, QUICK)
    asked = Path(log).read_text().split()
    assert sorted(asked) == sorted(f"k{i}" for i in range(40))


def test_bad_replies_are_asked_again_on_demand(spark, tmp_path):
    folder = str(tmp_path / "asked")

    def says(raw):
        return lambda batches: (pd.DataFrame({"answer_key": b["cache_key"], "raw_answer": raw}) for b in batches)

    def raws(answers):
        return {r["raw_answer"] for r in answers.collect()}

    assert raws(ask(requests(spark, 5), says("no json"), folder, QUICK)) == {"no json"}
    assert raws(ask(requests(spark, 5), says(GOOD), folder, QUICK)) == {"no json"}
    assert raws(ask(requests(spark, 5), says(GOOD), folder, QUICK, retry_errors=True)) == {GOOD}
    assert raws(ask(requests(spark, 5), says("{}"), folder, QUICK, retry_errors=True)) == {GOOD}
    assert ask(requests(spark, 0), says("{}"), str(tmp_path / "none"), QUICK).isEmpty()
    assert stored_replies(spark, str(tmp_path / "none")).isEmpty() and replied(spark, folder).count() == 5


def test_added_replies(spark):
    def answers(*rows):
        return answers_from_replies(spark.createDataFrame(rows, REPLY_SCHEMA))

    given = answers(("a", GOOD, None), ("b", "bad", None), ("c", None, "T: 1"), ("d", None, None))
    more = answers(("a", "bad", None), ("b", "worse", None), ("c", GOOD, None), ("e", None, "T: 2"))
    got = {r["answer_key"]: (r["raw_answer"], r["answer_error"]) for r in with_replies(given, more).collect()}
    assert got == {"a": (GOOD, None), "b": ("worse", None), "c": (GOOD, None), "d": (None, None), "e": (None, "api_error: T: 2")}


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("world"))
    site = F.concat(F.lit("https://s"), (F.col("id") % 12).cast("string"), F.lit(".example"))
    person = F.concat(F.lit("https://p/"), (F.col("id") % 6).cast("string"))
    contacts = spark.range(30).select(
        F.col("id").alias("contact_id"), F.lit("N").alias("name"), F.lit("C").alias("company"),
        F.when(F.col("id") < 24, site).otherwise("").alias("website"), person.alias("linkedin_url"),
    )
    contacts.repartition(4).write.parquet(path + "/contacts")
    url = F.concat(F.lit("https://s"), F.col("id").cast("string"), F.lit(".example"))
    pages = page_texts(spark.range(12).select(F.col("id").alias("page_id"), url.alias("url"), F.lit("<p>text</p>").alias("html")))
    pages.write.parquet(path + "/pages")
    return spark.read.parquet(path + "/contacts"), spark.read.parquet(path + "/pages"), path + "/contacts"


def no_answers(spark):
    return answers_from_replies(spark.createDataFrame([], "answer_key string, raw_answer string"))


def test_a_run_with_a_provider(spark, world, tmp_path):
    contacts, pages, _ = world
    paths, log, calls = RunPaths(str(tmp_path / "out"), str(tmp_path / "cache")), str(tmp_path / "log"), []
    told = lambda stage, n: calls.append((stage, n))
    known = no_answers(spark).unionByName(
        spark.range(1).select(cache_key(F.lit("s1"), F.lit("https://s0.example")).alias("answer_key"), F.lit(GOOD).alias("raw_answer"), F.lit(None).cast("string").alias("answer_error"))
    )
    small = Asking(per_wave=4, tasks=1, at_once=2, attempts=1, first_wait=0.0)
    summary = run(contacts, pages, known, paths, "r1", NOW, on_progress=told, provider=service(log), asking=small)
    assert (summary["total"], summary["tiers"]["warm"] + summary["tiers"].get("hot", 0)) == (30, 24) and skipped(contacts).isEmpty()
    assert len(Path(log).read_text().split()) == 11
    waves = [n for stage, n in calls if stage == ASKING_NAME]
    assert waves == sorted(waves) and waves[-1] == 11 and len(waves) > 1
    assert [n for stage, n in calls if stage == STAGE_NAME] == [0, 24]
    # The same run again asks nothing; another one finds all in the cache and reports that first.
    assert run(contacts, pages, known, paths, "r1", NOW, provider=service(log), asking=small) == summary
    calls.clear()
    run(contacts, pages, known, RunPaths(str(tmp_path / "again"), paths.cache), "r2", NOW, on_progress=told, provider=service(log))
    assert len(Path(log).read_text().split()) == 11 and calls == [(STAGE_NAME, 24), (STAGE_NAME, 24)]


def test_a_person_run_with_a_provider(spark, world, tmp_path):
    contacts, _, _ = world
    found = profiles_from_responses(spark.range(6).select(F.concat(F.lit("https://p/"), "id").alias("profile_url"), F.lit('{"full_name":"A"}').alias("data")), "data")

    def yes(batches):
        reply = '{"q1_person_sells_payments":true,"q2_person_at_independent_iso":true,"title":"T"}'
        return (pd.DataFrame({"answer_key": b["cache_key"], "raw_answer": reply}) for b in batches)

    results = run_people(contacts, found, no_answers(spark), str(tmp_path / "out"), str(tmp_path / "cache"), "r1", NOW, provider=yes, asking=QUICK)
    assert {(r["s2_score"], r["s2_error"]) for r in results.collect()} == {(6, "")} and results.count() == 6


def test_a_stream_with_a_provider_and_a_folded_cache(spark, world, tmp_path):
    contacts, pages, path = world
    paths, log, calls, totals = RunPaths(str(tmp_path / "out"), str(tmp_path / "cache")), str(tmp_path / "log"), [], []
    query = start_incremental_run(
        contacts_stream(spark, path, contacts.schema, files_per_batch=1), lambda s: (pages, no_answers(s)), paths, "inc", NOW,
        str(tmp_path / "checkpoint"), on_total=totals.append, on_progress=lambda stage, n: calls.append((stage, n)),
        provider=service(log), asking=QUICK, fold_every=2,
    )
    query.awaitTermination()
    asked = Path(log).read_text().split()
    assert len(asked) == len(set(asked)) == 12
    assert totals == sorted(totals) and totals[-1] == 30 and len(totals) >= 3
    processed = [n for stage, n in calls if stage == STAGE_NAME]
    assert processed == sorted(processed) and processed[-1] == 24 and len(set(processed)) > 1
    assert qualified_so_far(spark, paths).filter("s1_score = 6").count() == 24
