"""Inputs in the library's shapes, derived from the test tables row by row; see FIXTURES.md."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions.answers import decodable
from sievework.functions.keys import cache_key
from sievework.functions.stages import WEBSITE
from sievework.operators.cache import cache_entries
from sievework.plans.qualify import prepared
from sievework.plans.website import website_results
from sievework.sources.tables import answers_from_replies, page_texts, profiles_from_responses

RUN_TIME = "2024-05-01 12:00:00"
# A row of customer becomes about a kilobyte of JSON; a task that sorts so many holds some 40 MB.
ROWS_PER_TASK = 50_000


def run_time() -> Column:
    return F.lit(RUN_TIME).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers, dealt out by key while they are narrow: a file that is one task's share may hold any number of them."""
    customer = table(spark, sf_dir, "customer")
    tasks = -(-customer.count() // ROWS_PER_TASK)
    return customer.repartition(tasks, "c_custkey") if tasks > 1 else customer


def by_case(number: Column, values: dict[int, str], otherwise: str) -> Column:
    chain = None
    for case, value in values.items():
        chain = (F if chain is None else chain).when(number == case, value)
    return chain.otherwise(otherwise)


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts with blank, padded, upper-case, scheme-less, dead and plain websites."""
    customer, pages = customers(spark, sf_dir), table(spark, sf_dir, "pages").select("page_id", "url")
    key = F.col("c_custkey")
    joined = customer.withColumn("page_id", key % pages.select(F.count("*")).scalar()).join(pages, "page_id")
    shape = key % 10
    website = (
        F.when(shape == 0, "")
        .when(shape == 1, "   ")
        .when(shape == 2, F.concat(F.lit(" "), F.upper("url"), F.lit(" ")))
        .when(shape == 3, F.replace(F.replace("url", F.lit("https://"), F.lit("")), F.lit("http://"), F.lit("")))
        .when(shape == 4, F.concat(F.lit("https://missing.example.com/"), (key % 40).cast("string")))
        .otherwise(F.col("url"))
    )
    return joined.select(
        key.alias("contact_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("Company "), F.col("c_nationkey").cast("string")).alias("company"),
        website.alias("website"),
        F.when(key % 4 == 0, "").otherwise(_profile_url(key)).alias("linkedin_url"),
        F.col("c_mktsegment").alias("segment"),
    )


def _profile_url(key: Column) -> Column:
    return F.concat(F.lit("https://linkedin.example.com/in/"), key.cast("string"))


REPLIES = {
    0: '{"q1_sells_payments":true,"q2_is_independent_iso":true,"q3_zero_cost_pricing":true,"q4_value_added_products":true,"q5_has_agent_program":true,"reasoning":"all"}',
    1: '{"q1_sells_payments":true,"q2_is_independent_iso":true,"reasoning":"gates only"}',
    2: '{"q1_sells_payments":false,"q2_is_independent_iso":true,"q5_has_agent_program":true}',
    3: '{"q1_sells_payments":true,"q2_is_independent_iso":false,"q3_zero_cost_pricing":true}',
    4: '{"q1_sells_payments":"false","q2_is_independent_iso":1,"q3_zero_cost_pricing":0}',
    5: '{"q1_sells_payments":true,"q2_is_independent_iso":true,"q5_has_agent_program":true,"q4_value_added_products":null}',
    6: '```json\n{"q1_sells_payments":true}\n```',
    7: '{"q1_sells_payments":true} trailing',
    8: "[true, true]",
    9: "",
    10: '{"q1_sells_payments":[0],"q2_is_independent_iso":{"a":1},"q4_value_added_products":[]}',
    11: '  {"q1_sells_payments":true,"q2_is_independent_iso":true,"q3_zero_cost_pricing":true,"q5_has_agent_program":true}  ',
    12: "{}",
}
OTHER_REPLY = '{"q1_sells_payments":true,"q2_is_independent_iso":true,"q4_value_added_products":true,"q5_has_agent_program":true}'


def website_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reply per page; a NULL one is still awaited."""
    page = F.col("page_id")
    raw = F.when(page % 9 != 8, by_case(page % 14, REPLIES, OTHER_REPLY))
    return table(spark, sf_dir, "pages").select(
        "page_id", cache_key(F.lit("s1"), F.col("url")).alias("answer_key"), raw.alias("raw_answer")
    )


def website_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replies, with worse ones to the same keys: older ones that can't be decoded, and newer ones beside good ones."""
    replies = website_replies(spark, sf_dir).withColumn("replied_at", F.lit("2024-04-01"))
    worse = F.when(F.col("page_id") % 5 == 0, F.lit("2024-03-01"))
    worse = worse.when((F.col("page_id") % 5 == 1) & decodable(F.col("raw_answer")), F.lit("2024-04-20"))
    copies = replies.filter(F.col("raw_answer").isNotNull()).withColumn("replied_at", worse).filter("replied_at is not null")
    return answers_from_replies(replies.unionByName(copies.withColumn("raw_answer", F.lit("```json\n{}\n```"))))


def crawled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages, some of which were crawled again later: of equal URLs the smallest page_id counts."""
    pages = table(spark, sf_dir, "pages")
    again = pages.filter("page_id % 4 = 1").withColumn("page_id", F.col("page_id") + 10_000_000)
    return pages.unionByName(again.withColumn("html", F.lit("<p>crawled again</p>")))


def prepared_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(crawled_pages(spark, sf_dir))


def failing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages, some of which could not be fetched."""
    failed = F.when(F.col("page_id") % 50 == 7, F.concat(F.lit("TimeoutError: page "), F.col("page_id").cast("string")))
    return table(spark, sf_dir, "pages").withColumn("fetch_error", failed)


def static_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of the pages as they were fetched first: a quarter is made by scripts and holds its id only."""
    bare = F.concat(F.lit("<div id=root>"), F.col("page_id").cast("string"), F.lit("</div>"))
    return page_texts(failing_pages(spark, sf_dir).withColumn("html", F.when(F.col("page_id") % 4 == 2, bare).otherwise(F.col("html"))))


def renderings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a browser gave for a third of the pages, twice the markup; some failed, once or before they succeeded."""
    page = F.col("page_id")
    pages = table(spark, sf_dir, "pages").filter(page % 3 == 0)
    good = pages.filter(page % 9 != 0).select("page_id", F.concat("html", "html").alias("rendered_html"), F.lit(None).cast("string").alias("render_error"))
    failed = pages.filter(page % 6 != 3).select("page_id", F.lit(None).cast("string").alias("rendered_html"), F.lit("TimeoutError: rendering").alias("render_error"))
    return good.unionByName(failed)


def padded_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents between spaces of several kinds."""
    pads = {1: " \t", 2: "\u00a0\u2003", 3: "\x1f\u3000 ", 4: "\n\n"}
    pad = by_case(F.col("doc_id") % 6, pads, "")
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(pad, "text", pad).alias("text"))


PHRASES = {
    0: "We offer merchant services and a merchant account.",
    1: "An independent ISO; payment processing, cash discounting.",
    2: "An Independent ISO of Fiserv with CARD PROCESSING",
    3: "zero-cost surcharges, payroll and ATM",
    4: "our referral program pays residuals",
    5: "paymentprocessing, misopayroll and surchargeable",
}


def texts_with_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrase = by_case(F.col("doc_id") % 8, PHRASES, "")
    return table(spark, sf_dir, "documents").select("doc_id", F.concat("text", F.lit("\n"), phrase).alias("text"))


def profile_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of a people service: nested records, some with a null field, some without a person."""
    key = F.col("c_custkey")
    company = F.concat(F.lit("Company "), F.col("c_nationkey").cast("string"))
    entry = lambda i: F.struct(
        F.concat(F.lit("Role "), i.cast("string")).alias("title"),
        F.concat(F.lit("Firm "), ((key + i) % 97).cast("string")).alias("company"),
    )
    person = F.to_json(
        F.struct(
            F.col("c_name").alias("full_name"),
            by_case(key % 3, {0: "Founder", 1: "Sales Agent"}, "Engineer").alias("job_title"),
            company.alias("job_company_name"),
            F.transform(F.sequence(F.lit(1), (key % 25 + 1).cast("int")), entry).alias("experience"),
            F.array(F.lower("c_mktsegment")).alias("skills"),
            F.lower("c_mktsegment").alias("industry"),
            F.lit("not kept").alias("interests"),
        )
    )
    # An explicit null is a present field.
    person = F.when(key % 2 == 0, F.replace(person, F.lit('{"full_name"'), F.lit('{"headline":null,"full_name"'))).otherwise(person)
    return customers(spark, sf_dir).select(
        key.alias("c_custkey"), _profile_url(key).alias("profile_url"), F.when(key % 5 != 0, person).alias("data")
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The responses, with empty ones to some of the same URLs."""
    responses = profile_responses(spark, sf_dir).select("profile_url", "data")
    empty = responses.filter(F.crc32(F.col("profile_url").cast("binary")) % 3 == 0)
    return profiles_from_responses(responses.unionByName(empty.withColumn("data", F.lit("null"))), "data")


def person_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")

    def boolean(condition: Column) -> Column:
        return F.when(condition, "true").otherwise("false")

    raw = F.concat(
        F.lit('{"q1_person_sells_payments":'),
        boolean(key % 7 != 0),
        F.lit(',"q2_person_at_independent_iso":'),
        boolean(key % 6 != 0),
        F.lit(',"q3_person_is_decision_maker":'),
        boolean(key % 3 == 0),
        F.lit(',"q4_person_has_payments_experience":'),
        F.when(key % 2 == 0, "1").otherwise("0"),
        F.lit(',"q5_person_manages_team":'),
        F.when(key % 11 == 0, '"yes"').otherwise('""'),
        F.lit(',"title":"T'),
        key.cast("string"),
        F.lit('"}'),
    )
    return customers(spark, sf_dir).select(
        key, cache_key(F.lit("s2"), _profile_url(key)).alias("answer_key"), raw.alias("raw_answer")
    )


def first_person_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the replies; the others are still awaited."""
    replies = person_replies(spark, sf_dir)
    return answers_from_replies(replies.withColumn("raw_answer", F.when(F.col("c_custkey") % 2 == 0, F.col("raw_answer"))))


def person_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers_from_replies(person_replies(spark, sf_dir))


def website_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache after two earlier runs: one over a market segment, a later one over that and another."""
    ready = prepared(contacts(spark, sf_dir))
    results = website_results(ready, prepared_pages(spark, sf_dir), website_answers(spark, sf_dir))
    segment = F.col("segment")
    dates = F.when(segment == "BUILDING", F.array(F.lit("2024-01-01"), F.lit("2024-02-01"))).when(
        segment == "MACHINERY", F.array(F.lit("2024-02-01"))
    )
    sites = ready.filter(F.col("site").isNotNull()).select("site", F.explode(dates).alias("day")).distinct()
    return cache_entries(results.join(sites, "site"), WEBSITE, F.col("day").cast("timestamp"))


def job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, kind, user = F.col("event_id"), F.col("event_type"), F.col("user_id")
    progress = kind.isin("view", "click")
    return table(spark, sf_dir, "events").select(
        (user % 50).alias("job_id"),
        event.alias("seq"),
        F.when(kind == "signup", "total").when(kind == "purchase", "done").when(kind == "error", "error").otherwise("progress").alias("kind"),
        F.when(kind == "signup", user % 7 + 100).alias("total"),
        F.when(progress, event % 100).alias("processed"),
        F.when(progress, F.concat(F.lit("Stage "), (event % 2 + 1).cast("string"))).alias("stage"),
        F.when(kind == "purchase", F.concat(F.lit("run "), event.cast("string"))).alias("summary"),
        F.when(kind == "error", F.concat(F.lit("failed at "), event.cast("string"))).alias("message"),
    )


def text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage columns as they come back from a text file."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        order.alias("row_id"),
        by_case(order % 5, {0: "True", 1: "TRUE", 2: " true ", 3: "false"}, None).alias("s1_sells_payments"),
        by_case(customer % 3, {0: "true", 1: "True"}, "no").alias("s1_is_independent_iso"),
        by_case(
            order % 8, {0: "10", 1: "x", 2: "nan", 4: "7.125", 5: "8.005", 6: " 6 ", 7: "1e1"}, None
        ).alias("s1_score"),
        by_case(order % 7, {1: "  ", 3: "empty_page", 4: "fetch_error: Timeout", 0: "", 5: "", 6: ""}, None).alias("s1_error"),
    )
