"""Page text: hand-made cases, and random markup against the parser."""

import random
import time

import pytest
from pyspark.sql import functions as F

from sievework.functions.html import MAX_CHARS, rendered_or_static, visible_text, with_page_text
from sievework.sources.tables import page_texts

CASES = {
    "inline tags split words": ("<p>pay<b>ment</b></p>", "pay ment"),
    "title is text": ("<html><head><title>T</title></head><body>b</body></html>", "T b"),
    "dropped elements": (
        "a<script>1</script>b<style>2</style>c<noscript>3</noscript>d<header>4</header>e<footer>5</footer>f<nav>6</nav>g",
        "a b c d e f g",
    ),
    "comment and doctype": ("<!DOCTYPE html>a<!-- x -->b", "a b"),
    "upper case": ("a<NAV class='x'>no</NAV>b", "a b"),
    "nested nav": ("a<nav>1<nav>2</nav>3</nav>b", "a b"),
    "unclosed footer": ("<div>a<footer>b</div>c", "a c"),
    "footer open to the end": ("a<footer>b<p>c", "a"),
    "closed through an ancestor": ("<div><nav>x</div>shown</nav> end", "shown end"),
    "misnested but even": ("<div><nav>x</div>shown<div></nav>more</div>", "shown more"),
    "greater-than in attribute": ('<a title="x>y">z</a>', "z"),
    "greater-than in single quotes": ("<a title='x>y'>z</a>", "z"),
    "less-than in text": ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
    "known entities": ("a&nbsp;b &copy; &amp;lt; &lt;b&gt; &mdash;", "a b © &lt; <b> —"),
    "rare entity": ("&eacute;t&eacute;", "été"),
    "numeric entities": ("&#8217;&#x41;&#150;", "’A–"),
    "entity without semicolon": ("AT&amp T", "AT& T"),
    "glued entity": ("x&ampy", "x&ampy"),
    "unknown entity": ("&foo; bar", "&foo bar"),
    "bare ampersand": ("R & D, A&B Co", "R & D, A&B Co"),
    "unicode spaces": (" a 　b\x1cc\n\n d ", "a b c d"),
    "script only": ("<script>var a = '<b>x</b>';</script>", ""),
    "script holding a comment start": ("<script>a='<!--'</script>shown<!-- c -->", "shown"),
    "comment holding a script": ("a<!-- <script> -->b", "a b"),
    "nav end inside a comment": ("a<nav>x<!-- </nav> -->y</nav>b", "a b"),
    "self-closing nav": ("a<nav/>b", "a b"),
    "self-closing nav with space": ("a<nav />b</nav>c", "a b c"),
    "void elements": ("a<br>b<img src=x>c<hr/>d", "a b c d"),
    "template and ruby text": ("a<template>t</template><ruby>k<rt>r</rt><rp>(</rp></ruby>b", "a k b"),
    "cdata": ("a<![CDATA[b]]>c", "a b c"),
    "processing instruction": ("a<?php echo 1 ?>b", "a b"),
    "empty": ("", ""),
}


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(name, html) for name, (html, _) in CASES.items()]
    return {r["name"]: r["page_text"] for r in with_page_text(spark.createDataFrame(rows, "name string, html string")).collect()}


@pytest.mark.parametrize("name", CASES)
def test_case(texts, name):
    assert texts[name] == CASES[name][1]


def test_null_and_length(spark):
    long = "<p>" + "é" * (MAX_CHARS + 1) + "</p>"
    rows = with_page_text(spark.createDataFrame([(1, None), (2, long)], "id int, html string")).orderBy("id").collect()
    assert rows[0]["page_text"] is None
    assert rows[1]["page_text"] == "é" * MAX_CHARS


FRAGMENTS = [
    "<nav>", "</nav>", "<nav class='a'>", "<div>", "</div>", "<div class=\"b\">", "<footer>", "</footer>", "<header>",
    "</header>", "<script>", "</script>", "<style>x{}</style>", "<!-- c -->", "<!--", "-->", "<br>", "<br/>", "<li>", "</li>",
    "<ul>", "</ul>", "<p>", "</p>", "<a href='?a=1&b=2'>", "</a>", '<a title="x>y">', "<img src=x>", "text", " more ", "&amp;",
    "&amp", "&nbsp;", "&eacute;", "&foo;", "&#65;", "& ", "<", ">", "\n", " ", "<rt>", "</rt>", "<template>", "</template>",
    "<noscript>", "</noscript>", "<navy>", "</navy>", "<nav/>", "<b />", "</b>", "<NAV>", "</Nav >", "'", '"', "=", "<?pi?>",
    "<![CDATA[x]]>", "</>", "<title>", "</title>",
]


def test_random_markup_equals_parser(spark):
    rng = random.Random(7)
    pages = []
    for i in range(6000):
        size = rng.randint(1, 14)
        # Half of the pages are built from few kinds of fragments, so that misnesting of those is frequent.
        pool = FRAGMENTS if i % 2 else rng.sample(FRAGMENTS, 6)
        pages.append((i, "".join(rng.choice(pool) for _ in range(size))))
    found = with_page_text(spark.createDataFrame(pages, "id int, html string").repartition(8)).collect()
    wrong = [(r["html"], r["page_text"], visible_text(r["html"])) for r in found if r["page_text"] != visible_text(r["html"])[:MAX_CHARS]]
    assert not wrong, (len(wrong), wrong[:5])


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_real_pages_equal_parser(spark, sf):
    pages = spark.read.parquet(f"/root/testdata/sf{sf}/pages.parquet").repartition(8)
    found = with_page_text(pages).collect()
    assert [r["page_id"] for r in found if r["page_text"] != visible_text(r["html"])[:MAX_CHARS]] == []


def test_rendered_text(spark):
    rows = [("x" * 199, "r"), ("x" * 200, "r"), ("x" * 199, None), ("short", "")]
    df = spark.createDataFrame(rows, "s string, r string")
    chosen = [r[0] for r in df.select(rendered_or_static(F.col("s"), F.col("r"))).collect()]
    assert chosen == ["r", "x" * 200, "", ""]
    kept = [r[0] for r in df.select(rendered_or_static(F.col("s"), None)).collect()]
    assert kept[3] == "short"


def test_rendered_pages_are_used_where_the_static_text_is_short(spark):
    rows = [(1, "a.com", "<p>short</p>", "<p>rendered</p>"), (2, "b.com", "x" * 200, "<p>rendered</p>"), (3, "c.com", None, "<p>only</p>"), (4, "d.com", "", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, rendered_html string")
    found = {r["page_id"]: (r["page_text"], r["page_blank"]) for r in page_texts(pages).collect()}
    assert found == {1: ("rendered", False), 2: ("x" * 200, False), 3: ("only", False), 4: ("", True)}


@pytest.mark.parametrize("fragment", ["<!--x ", "<?x ", "<![CDATA[x ", "<a href='", '<a b="', "<b ", "</x ", "<!--x --!", "<div></b>", "<p></nav>", "&#", "<script>", "< ", "<nav a=\"'>"])
def test_a_page_takes_time_in_proportion_to_its_length(fragment):
    page = fragment * (1_000_000 // len(fragment))
    begun = time.process_time()
    visible_text(page)
    assert time.process_time() - begun < 5  # a second on an idle machine; a scan that searches again and again takes minutes


def test_large_page_of_unclosed_comments(spark):
    rows = [(i, "shown " + "<!--x " * 170_000 + "<p>end</p>") for i in range(2)]
    found = with_page_text(spark.createDataFrame(rows, "id int, html string"), max_chars=20).collect()
    assert {r["page_text"] for r in found} == {"shown <!--x <!--x <!"}


def test_odd_markup():
    cases = {
        "a<![weird]>b": "a b", "a<![if x]>b<![endif]>c": "a b c", "a<![CDATA[x <b> y]]>c": "a x <b> y c", "a</>b": "ab", "x &#65 y &#xe9; &# z": "x A y é &# z",
        "<a href='x>y</a> z": "<a href='x>y z", "a<nav x=1/>b</nav>c": "a c", "a<nav x='1'/>b": "a b", "<script>x</ script>y": "y", "<b a = 'x>y' c>t</b>": "t",
        "a<": "a<", "a<b": "a<b", "&am": "&am", "<B>x</b><NAV>y</Nav\n>z": "x z",
    }
    assert {html: visible_text(html) for html in cases} == cases
