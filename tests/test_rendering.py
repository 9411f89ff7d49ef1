"""Short pages are rendered on request, and runs end with the rendered texts."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from sievework.functions.keys import cache_key
from sievework.operators.rendering import render_requests, rendered_texts, with_renderings
from sievework.plans.qualify import RunPaths, run
from sievework.sources.tables import answers_from_replies, page_texts

NOW = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
LONG = "<p>" + "word " * 60 + "</p>"
SHAPE = "page_id long, rendered_html string, render_error string, rendered_at string"


def texts(spark, *rows):
    return page_texts(spark.createDataFrame(rows, "page_id long, url string, html string, fetch_error string"))


def test_what_is_asked_for_and_what_replaces_it(spark):
    static = texts(
        spark, (1, "https://a", LONG, None), (2, "https://b", "<p>x</p>", None), (3, "https://c", None, "Timeout: 1"),
        (4, "https://d", "", None), (5, "https://e", "<p>y</p>", None), (6, "https://f", LONG, "Timeout: 2"), (7, "https://g", "z", None),
    )
    come = rendered_texts(
        spark.createDataFrame(
            [
                (1, "<p>never asked</p>", None, None), (2, "<p>old</p>", None, "1"), (2, "<p>new</p>", None, "2"), (2, None, "T: 9", "3"),
                (3, None, "T: 1", "1"), (3, None, "T: 2", "2"), (3, None, None, "9"), (4, "", None, "1"), (6, LONG, None, None), (7, None, None, None),
                (99, "<p>no page</p>", None, None),
            ],
            SHAPE,
        )
    )
    ids = lambda df: {r["page_id"] for r in df.collect()}
    assert ids(render_requests(static)) == {2, 3, 4, 5, 6, 7}
    assert ids(render_requests(static, come)) == {5} and ids(render_requests(static, come, retry_errors=True)) == {3, 5}
    merged = with_renderings(static, come)
    assert merged.columns == static.columns
    got = {r["page_id"]: (r["page_text"], r["page_blank"], r["page_error"]) for r in merged.collect()}
    long = ("word " * 60).strip()
    assert got == {
        1: (long, False, None), 2: ("new", False, None), 3: ("", True, "fetch_error: T: 2"), 4: ("", True, None),
        5: ("y", False, None), 6: (long, False, None), 7: ("", True, None),
    }
    none = spark.createDataFrame([], SHAPE)
    assert sorted(map(str, with_renderings(static, rendered_texts(none)).collect())) == sorted(map(str, static.collect()))
    assert with_renderings(static.limit(0), come).isEmpty()


def test_only_short_texts_are_shuffled(spark):
    static = texts(spark, (1, "https://a", LONG, None))
    plan = with_renderings(static, rendered_texts(spark.createDataFrame([], SHAPE)))._jdf.queryExecution().optimizedPlan()
    (union,) = [plan] if plan.nodeName() == "Union" else []
    sides = [union.children().apply(i).toString() for i in range(2)]
    assert sum("Join" in s for s in sides) == 1  # the side of long texts is a filter alone


def test_two_runs_end_with_rendered_texts(spark, tmp_path):
    path = str(tmp_path / "contacts")
    rows = [(1, "N", "C", "https://a.example", ""), (2, "N", "C", "https://b.example", "")]
    spark.createDataFrame(rows, "contact_id long, name string, company string, website string, linkedin_url string").write.parquet(path)
    contacts = spark.read.parquet(path)
    static = texts(spark, (1, "https://a.example", LONG, None), (2, "https://b.example", "<div id=root></div>", None))
    paths, none = RunPaths(str(tmp_path / "out"), str(tmp_path / "cache")), answers_from_replies(spark.createDataFrame([], "answer_key string, raw_answer string"))
    run(contacts, static, none, paths, "r1", NOW)
    asked = spark.read.schema("cache_key string, user string").json(paths.of("requests"))
    assert asked.count() == 1
    wanted = render_requests(static)
    assert [(r["page_id"], r["page_url"]) for r in wanted.collect()] == [(2, "https://b.example")]
    come = rendered_texts(wanted.select("page_id", F.lit("<p>made by a script</p>").alias("rendered_html")))
    run(contacts, with_renderings(static, come), none, paths, "r2", NOW, retry_errors=True)
    again = asked.sparkSession.read.schema("cache_key string, user string").json(paths.of("requests"))
    assert {r["cache_key"] for r in again.collect()} == {
        r[0] for r in spark.range(1).select(F.explode(F.array(*[cache_key(F.lit("s1"), F.lit(f"https://{x}.example")) for x in "ab"]))).collect()
    }
    assert again.filter("user like '%made by a script%'").count() == 1
