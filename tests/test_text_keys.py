import hashlib

from pyspark.sql import functions as F

from sievework.functions.errors import error_kind, prefixed
from sievework.functions.keys import cache_key, fetch_url, with_scheme
from sievework.functions.prompts import filled
from sievework.functions.text import WHITESPACE, collapse_whitespace, strip

TEXTS = ["", "  ", "\t a  ", "　x ", "\x1c\x1f y z \x85", "a​b ", "İstanbul ", "a \t\n b", "    c  d", "x \x1d y"]


def python_key(*parts):
    return hashlib.sha256("|".join(p.strip().lower() for p in parts if p).encode()).hexdigest()


def test_whitespace_is_what_python_strips():
    assert len(WHITESPACE) == 29
    assert WHITESPACE.strip() == ""


def test_strip_and_collapse(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    rows = df.select("t", strip(F.col("t")).alias("s"), collapse_whitespace(F.col("t")).alias("c")).collect()
    for r in rows:
        assert r["s"] == r["t"].strip()
        assert r["c"] == " ".join(r["t"].split())


def test_cache_key(spark):
    df = spark.createDataFrame([(t, u) for t in TEXTS for u in ("", " ", "B")], "t string, u string")
    for r in df.select("t", "u", cache_key(F.lit("s1"), F.col("t"), F.col("u")).alias("k")).collect():
        assert r["k"] == python_key("s1", r["t"], r["u"])


def test_urls(spark):
    urls = {
        "": "",
        "a.com": "https://a.com",
        " A.com\t": "https://a.com",
        "http://a.com": "http://a.com",
        "HTTPS://A.com/X": "https://a.com/x",
        " https://b.org": "https://b.org",
        "ftp://c": "https://ftp://c",
    }
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r["u"]: r["f"] for r in df.select("u", fetch_url(F.col("u")).alias("f")).collect()} == urls
    cased = df.select(with_scheme(strip(F.col("u"))).alias("f")).collect()
    assert [r["f"] for r in cased][2:5] == ["https://A.com", "http://a.com", "HTTPS://A.com/X"]


def test_errors_and_templates(spark):
    df = spark.createDataFrame([("fetch_error: T: m", "x"), ("", ""), ("empty_page", None)], "e string, d string")
    rows = df.select(error_kind(F.col("e")).alias("k"), prefixed("fetch_error", F.col("d")).alias("p")).collect()
    assert [tuple(r) for r in rows] == [("fetch_error", "fetch_error: x"), ("", None), ("empty_page", None)]
    text = df.select(filled('{{"a": {d}}} {e}', {"d": F.lit(1).cast("string"), "e": F.lit("{d}")}).alias("t")).first()["t"]
    assert text == '{"a": 1} {d}'
