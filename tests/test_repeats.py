"""Repeated replies, responses and runs; hot keys without a limit; folders of CSV files."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from sievework.functions.keys import cache_key
from sievework.functions.stages import PERSON, WEBSITE
from sievework.operators.cache import cache_entries
from sievework.operators.lookup import spread_left_join
from sievework.plans.person import run_people
from sievework.plans.qualify import RunPaths, qualify, run
from sievework.sinks.cache import append_entries, clear_cache
from sievework.sources.cache import read_cache
from sievework.sources.contacts import read_contacts
from sievework.sources.tables import answers_from_replies, page_texts, profiles_from_responses
from sievework.streaming.incremental import snapshot_of_all

NOW = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
GOOD = '{"q1_sells_payments":true,"q2_is_independent_iso":true}'
FENCED = "```json\n{}\n```"


def test_every_hot_key_is_cut(spark):
    left = spark.range(3000).select(F.col("id").alias("row"), (F.col("id") % 300).cast("string").alias("key"))
    right = spark.range(200).select(F.col("id").cast("string").alias("key"), F.col("id").alias("value"))
    joined = spread_left_join(left, right, "key", "row", rows_per_piece=2)
    assert joined.count() == 3000 and joined.filter("value is not null").count() == 2000
    assert joined.filter("value is not null and cast(key as long) <> value").isEmpty()
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "GlobalLimit" not in plan and "LocalLimit" not in plan


def test_replies_that_decode_come_first_then_the_newest(spark):
    rows = [
        ("a", FENCED, None, "2024-01-09"), ("a", GOOD, None, "2024-01-01"), ("a", "", None, "2024-01-08"),
        ("b", '{"x":1}', None, "2024-01-01"), ("b", '{"x":2}', None, "2024-01-03"), ("b", '{"x":3}', None, "2024-01-02"),
        ("c", None, "Timeout: 1", "2024-01-01"), ("c", FENCED, None, None), ("d", None, None, None), ("d", None, "Timeout: 2", None),
    ]
    replies = spark.createDataFrame(rows, "answer_key string, raw_answer string, failure string, replied_at string")
    got = {r["answer_key"]: (r["raw_answer"], r["answer_error"]) for r in answers_from_replies(replies).collect()}
    assert got == {"a": (GOOD, None), "b": ('{"x":2}', None), "c": (FENCED, None), "d": (None, "api_error: Timeout: 2")}


def test_a_person_comes_before_an_empty_response(spark):
    rows = [("u", "null"), ("u", '{"full_name":"A"}'), ("u", "[]"), ("v", "null"), ("w", None), ("w", "{}")]
    found = profiles_from_responses(spark.createDataFrame(rows, "profile_url string, data string"), "data")
    got = {r["profile_url"]: r["found"] for r in found.select("profile_url", F.col("person").isNotNull().alias("found")).collect()}
    assert got == {"u": True, "v": False, "w": False}


@pytest.fixture(scope="module")
def one_site(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("one"))
    contacts = spark.createDataFrame([(1, "N", "C", "https://x.example", "")], "contact_id long, name string, company string, website string, linkedin_url string")
    pages = page_texts(spark.createDataFrame([(1, "https://x.example", "<p>some text</p>")], "page_id long, url string, html string"))
    contacts.write.parquet(path + "/contacts")
    pages.write.parquet(path + "/pages")
    return spark.read.parquet(path + "/contacts"), spark.read.parquet(path + "/pages")


def replies(spark, *raw):
    key = cache_key(F.lit("s1"), F.lit("https://x.example"))
    return answers_from_replies(spark.createDataFrame([(r,) for r in raw], "raw_answer string").withColumn("answer_key", key))


def test_a_bad_reply_is_asked_again_and_a_good_one_replaces_it(spark, one_site, tmp_path):
    contacts, pages = one_site
    paths = RunPaths(str(tmp_path / "out"), str(tmp_path / "cache"))

    def requests(part):
        return spark.read.schema("cache_key string").json(paths.of("requests", part)).count()

    run(contacts, pages, replies(spark, FENCED), paths, "r1", NOW, part="/batch=1")
    assert requests("/batch=1") == 0
    run(contacts, pages, replies(spark, FENCED), paths, "r2", NOW, part="/batch=2", retry_errors=True)
    assert requests("/batch=2") == 1
    run(contacts, pages, replies(spark, FENCED, GOOD), paths, "r3", NOW, part="/batch=3", retry_errors=True)
    assert spark.read.parquet(paths.of("qualified", "/batch=3")).first()["final_score"] == 6.0
    # The fourth finds the site in the cache; its snapshot holds it nevertheless.
    run(contacts, pages, replies(spark), paths, "r4", NOW, part="/batch=4")
    snapshot = snapshot_of_all(contacts, paths, 4, F.lit(NOW)).drop("batch")
    want = qualify(contacts, pages, replies(spark, GOOD), F.lit(NOW))
    assert snapshot.select(want.columns).collect() == want.collect()


def test_stages_and_runs_have_cache_folders_of_their_own(spark, tmp_path):
    path = str(tmp_path / "cache")

    def entries(stage, *keys):
        shape = read_cache(spark, path, stage)
        columns = [F.lit(k).alias("cache_key") for k in keys]
        rows = [spark.range(1).select(c, F.lit("").alias(stage.error_column)) for c in columns]
        frame = rows[0]
        for more in rows[1:]:
            frame = frame.unionByName(more)
        for f in shape.schema["result"].dataType.fields:
            if f.name != stage.error_column:
                frame = frame.withColumn(f.name, F.lit(None).cast(f.dataType))
        return cache_entries(frame, stage, F.lit(NOW))

    append_entries(entries(WEBSITE, "a", "b"), path, "run 1/x", WEBSITE)
    append_entries(entries(PERSON, "p"), path, "run 1/x", PERSON)
    assert {r["cache_key"] for r in read_cache(spark, path, WEBSITE).collect()} == {"a", "b"}
    assert [(r["cache_key"], r["stage"], r["run_id"]) for r in read_cache(spark, path, PERSON).collect()] == [("p", "s2", "run 1/x")]
    append_entries(entries(WEBSITE, "a").limit(0), path, "run 1/x", WEBSITE)
    assert read_cache(spark, path, WEBSITE).isEmpty() and read_cache(spark, path, PERSON).count() == 1
    clear_cache(spark, path, PERSON)
    assert read_cache(spark, path, PERSON).isEmpty()


@pytest.mark.parametrize("multi_line", [True, False])
def test_a_file_with_another_header_is_refused(spark, tmp_path, multi_line):
    (tmp_path / "a.csv").write_text("Name,company,WebSite\nn1,c1,w1\n")
    (tmp_path / "b.csv").write_text("Name,company,WebSite\nn2,c2,w2\n")
    contacts, _ = read_contacts(spark, str(tmp_path), multi_line)
    assert {(r["name"], r["company"], r["website"]) for r in contacts.collect()} == {("n1", "c1", "w1"), ("n2", "c2", "w2")}
    (tmp_path / "c.csv").write_text("company,Name,WebSite\nc3,n3,w3\n")
    with pytest.raises(Exception, match="c.csv"):
        read_contacts(spark, str(tmp_path), multi_line)[0].collect()


def test_a_stored_person_run_and_its_cache(spark, tmp_path):
    path = str(tmp_path / "contacts")
    shape = "contact_id long, name string, company string, website string, linkedin_url string"
    spark.createDataFrame([(1, "A", "C", "", "https://p/a"), (2, "B", "C", "", "https://p/b"), (3, "C", "C", "", "https://p/a")], shape).write.parquet(path)
    contacts = spark.read.parquet(path)
    found = profiles_from_responses(spark.createDataFrame([("https://p/a", '{"full_name":"A"}'), ("https://p/b", "null")], "profile_url string, data string"), "data")
    key = cache_key(F.lit("s2"), F.lit("https://p/a"))
    reply = '{"q1_person_sells_payments":true,"q2_person_at_independent_iso":true,"title":"T"}'
    empty = answers_from_replies(spark.createDataFrame([], "answer_key string, raw_answer string"))
    answered = answers_from_replies(spark.range(1).select(key.alias("answer_key"), F.lit(reply).alias("raw_answer")))

    def results(answers, run_id):
        root = str(tmp_path / run_id)
        rows = run_people(contacts, found, answers, root, str(tmp_path / "cache"), run_id, NOW).collect()
        return {r["profile"]: (r["s2_score"], r["s2_error"]) for r in rows}, spark.read.schema("cache_key string").json(root + "/person_requests").count()

    assert results(empty, "r1") == ({"https://p/a": (0, "no_answer"), "https://p/b": (0, "profile_not_found")}, 1)
    assert results(answered, "r2") == ({"https://p/a": (6, ""), "https://p/b": (0, "profile_not_found")}, 0)
    assert results(empty, "r3") == ({"https://p/a": (6, ""), "https://p/b": (0, "profile_not_found")}, 0)
