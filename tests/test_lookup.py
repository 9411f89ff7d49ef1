from pyspark.sql import functions as F

from sievework.functions.stages import WEBSITE
from sievework.operators.cache import cache_entries, cache_hits, cache_misses, cache_stats, latest_entries, payload_columns
from sievework.operators.distinct import distinct_profiles, distinct_sites
from sievework.operators.lookup import page_flags_for_sites, page_for_sites, spread_left_join
from sievework.operators.profiles import trimmed_profile
from sievework.operators.stage_results import default_rows
from sievework.sinks.cache import append_entries, clear_cache, delete_keys
from sievework.sources.cache import read_cache
from sievework.sources.tables import answers_from_replies, page_texts, profiles_from_responses, read_answers, read_profiles


def test_spread_join_equals_plain_join_and_spreads_a_hot_key(spark):
    # A third of the rows share one key, another third have none.
    left = spark.range(6000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 50)).alias("key")
    )
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 50, 2)] + [("unused", 7)], "key string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        joined = spread_left_join(left, right, "key", "id", rows_per_piece=100)
        plain = left.join(right, "key", "left").select("id", "key", "v")
        assert sorted(map(str, joined.select("id", "key", "v").collect())) == sorted(map(str, plain.collect()))
        parts = joined.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in parts) < 0.25 * 6000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)


def contacts(spark, rows):
    return spark.createDataFrame(rows, "contact_id long, name string, company string, website string, site string, profile string")


def test_smallest_contact_represents_a_site(spark):
    rows = [(5, "e", "E", " HTTP://A.com ", "http://a.com", None), (3, "c", "C", "http://A.COM", "http://a.com", "p"), (9, "i", "I", "", None, "p")]
    for order in (rows, rows[::-1]):
        df = contacts(spark, order).repartition(3)
        (site,) = distinct_sites(df).collect()
        assert (site["company"], site["url"], site["fetch_url"], site["first_contact_id"]) == ("C", "http://A.COM", "http://a.com", 3)
        (person,) = distinct_profiles(df).collect()
        assert (person["profile"], person["name"]) == ("p", "c")


def test_smallest_page_stands_for_its_url(spark):
    pages = page_texts(
        spark.createDataFrame(
            [(2, "HTTP://a.com", "two", None), (1, "http://a.com ", "one", None), (3, "b.org", "", "Timeout: x")],
            "page_id long, url string, html string, fetch_error string",
        )
    )
    sites = spark.createDataFrame([("http://a.com",), ("https://b.org",), ("https://none",)], "fetch_url string")
    found = {r["fetch_url"]: (r["page_id"], r["page_text"]) for r in page_for_sites(sites, pages).collect()}
    assert found == {"http://a.com": (1, "one"), "https://b.org": (3, ""), "https://none": (None, None)}
    flags = {r["fetch_url"]: (r["page_blank"], r["page_error"]) for r in page_flags_for_sites(sites, pages).collect()}
    assert flags == {"http://a.com": (False, None), "https://b.org": (True, "fetch_error: Timeout: x"), "https://none": (None, None)}


def test_profiles_and_trimming(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        '{"profile_url":" HTTPS://L/A ","data":{"full_name":"A","skills":null,"experience":[%s],"other":1,"industry":3}}\n'
        % ",".join(f'{{"n":{i}}}' for i in range(12))
        + '{"profile_url":"https://l/b","data":{}}\n{"profile_url":"https://l/c"}\n'
        + '{"profile_url":"https://l/d","data":{"experience":"long ago"}}\n'
    )
    people = read_profiles(spark, str(tmp_path / "p.json"))
    texts = {r["profile_url"]: r["j"] for r in people.filter("person is not null").select("profile_url", trimmed_profile(F.col("person")).alias("j")).collect()}
    entries = ",".join(f'{{"n":{i}}}' for i in range(10))
    assert texts == {
        "https://l/a": f'{{"full_name":"A","experience":[{entries}],"skills":null,"industry":3}}',
        "https://l/d": '{"experience":"long ago"}',
    }
    failed = spark.createDataFrame([("u", None, "HTTP: 500"), ("v", '{"full_name":"V"}', "HTTP: 500")], "profile_url string, data string, lookup_error string")
    assert {r["profile_url"]: (r["person"] is None, r["profile_error"]) for r in profiles_from_responses(failed, "data").collect()} == {
        "u": (True, "pdl_error: HTTP: 500"),
        "v": (False, None),
    }


def test_answers_are_one_per_key(spark, tmp_path):
    rows = [("k", "b", None), ("k", '{"a":1}', None), ("k", None, "Api: down"), ("e", None, "Api: down"), ("w", None, None)]
    df = spark.createDataFrame(rows, "answer_key string, raw_answer string, failure string")
    df.write.json(str(tmp_path / "a"))
    for answers in (answers_from_replies(df), read_answers(spark, str(tmp_path / "a"), "json")):
        found = {r["answer_key"]: (r["raw_answer"], r["answer_error"]) for r in answers.collect()}
        assert found == {"k": ('{"a":1}', None), "e": (None, "api_error: Api: down"), "w": (None, None)}


def results(spark, rows):
    schema = "cache_key string, " + ", ".join(
        f"{c} {'string' if c in ('s1_error', 's1_reasoning') else 'int' if c == 's1_score' else 'boolean'}" for c in payload_columns(WEBSITE)
    )
    return spark.createDataFrame([(k, True, True, False, False, False, s, e, "") for k, s, e in rows], schema)


def test_cache_life(spark, tmp_path):
    path = str(tmp_path / "cache")
    at = lambda day: F.lit(f"2024-01-0{day}").cast("timestamp")
    assert read_cache(spark, path, WEBSITE).count() == 0

    append_entries(cache_entries(results(spark, [("a", 6, ""), ("b", 0, "empty_page"), ("c", 0, "no_answer")]), WEBSITE, at(1)), path, "r1")
    append_entries(cache_entries(results(spark, [("b", 7, ""), ("d", 0, "json_parse_error")]), WEBSITE, at(2)), path, "r2")
    # Repeating a run replaces its entries.
    append_entries(cache_entries(results(spark, [("b", 8, ""), ("d", 0, "json_parse_error")]), WEBSITE, at(2)), path, "r2")
    cache = read_cache(spark, path, WEBSITE)
    assert cache.count() == 4
    latest = latest_entries(cache, WEBSITE)
    assert {r["cache_key"]: r["result"]["s1_score"] for r in latest.collect()} == {"a": 6, "b": 8, "d": 0}

    keys = spark.createDataFrame([("a",), ("d",), ("x",)], "cache_key string")
    assert {r["cache_key"] for r in cache_hits(keys, latest, WEBSITE).collect()} == {"a", "d"}
    assert {r["cache_key"] for r in cache_misses(keys, latest).collect()} == {"x"}
    assert {r["cache_key"] for r in cache_hits(keys, latest, WEBSITE, retry_errors=True).collect()} == {"a"}
    assert {r["cache_key"] for r in cache_misses(keys, latest, retry_errors=True).collect()} == {"d", "x"}
    stats = cache_stats(latest).first()
    assert stats["size"] == 3 and stats["volume_bytes"] > 0

    delete_keys(cache, keys, str(tmp_path / "cache2"))
    assert {r["cache_key"] for r in read_cache(spark, str(tmp_path / "cache2"), WEBSITE).collect()} == {"b"}
    clear_cache(spark, path, WEBSITE)
    assert read_cache(spark, path, WEBSITE).count() == 0
    assert cache_stats(latest_entries(read_cache(spark, path, WEBSITE), WEBSITE)).first().asDict() == {"size": 0, "volume_bytes": 0}
    append_entries(cache_entries(results(spark, [("z", 6, "")]), WEBSITE, at(3)), path, "r3")
    assert read_cache(spark, path, WEBSITE).count() == 1


def test_default_rows(spark):
    everyone = spark.createDataFrame([(1,), (2,)], "contact_id long")
    (row,) = default_rows(everyone, everyone.filter("contact_id = 1"), WEBSITE, "no_website").collect()
    assert row.asDict() == {"contact_id": 2, **{q.column: False for q in WEBSITE.questions}, "s1_score": 0, "s1_error": "no_website"}
