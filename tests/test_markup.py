"""Pages that patterns break on."""

import pytest
from pyspark.sql import functions as F

from tidecast.functions import markup
from tidecast.functions.markup import Block
from tidecast.plans import catalog

PAGES = [
    ("<h1>One</h1><p>a</p><p>b</p>", "One", "a\nb"),
    ('<h1 title="a > b">Two</h1><p data-x=\'</p>\'>kept <b>bold</b></p>', "Two", "kept bold"),
    ("<!-- <h1>no</h1><p>no > no</p> --><h1>Three</h1><p>x<!-- > -->y</p>", "Three", "xy"),
    ("<script>if (a < b) { p = '<p>no</p>' }</script><style>p > a {}</style><p>yes</p>", "", "yes"),
    ("<p>caf&eacute; &hellip; &#8364; &#x1F600; &copy 2024 &unknown; &amp;lt;</p>", "", "café … € 😀 © 2024 &unknown; &lt;"),
    ("<P CLASS=a>one<p>two<BR>three</P>", "", "one\ntwo\nthree"),
    ("<h1>First</h1><h1>Second</h1><p>left open", "First", "left open"),
    ("<h1>never closed", "never closed", ""),
    ("plain text & no tags", "", ""),
    ("", "", ""),
    (None, None, None),
    ("<textarea><p>no</p></textarea><p>a<script>x</script>b</p>", "", "ab"),
    ("<p>" + "w " * 50_000 + "</p>", "", ("w " * 50_000).strip()),
    ("<p>a < b and c > d</p>", "", "a < b and c > d"),
    ("<p>unclosed <!-- comment", "", "unclosed"),
]


@pytest.mark.parametrize("html, headline, article", PAGES)
def test_planted_pages(html, headline, article):
    got = markup.read_page(html)
    assert got[0] == headline
    assert (got[1] or "").rstrip() == (article or "") and (got[1] is None) == (article is None)


def test_paragraphs_by_attribute():
    page = '<div data-component="text-block"><div>in</div> one</div><div>no</div><p data-reactid="x.paragraph-2">two</p><p>no</p>'
    blocks = (Block("div", "data-component", "text-block"), Block("p", "data-reactid", "paragraph"))
    assert markup.read_page(page, blocks)[1] == "in one\ntwo"


def test_columns_equal_single_pages(spark):
    df = spark.createDataFrame([(k, p[0]) for k, p in enumerate(PAGES)], "id int, html string")
    got = {r["id"]: (r["page"]["headline"], r["page"]["article"]) for r in df.select("id", markup.page_article("html").alias("page")).collect()}
    assert got == {k: markup.read_page(p[0]) for k, p in enumerate(PAGES)}
    assert df.limit(0).select(markup.page_article("html").alias("page")).collect() == []


def test_agrees_with_the_patterns_on_plain_pages(spark, sf_dir):
    tokens = catalog.QUERIES["page_markup"](spark, sf_dir)
    patterns = catalog.QUERIES["page_article"](spark, sf_dir).toDF("page_id", "h", "a")
    both = tokens.join(patterns, "page_id")
    assert both.count() == tokens.count() > 0
    assert both.where((F.trim("headline") == F.trim("h"))).count() == both.count()
