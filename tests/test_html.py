"""The page reader and the index record on small pages."""

import datetime as dt
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.functions import html
from pagemill.functions import text as T
from pagemill.plans import index as plan


@pytest.mark.parametrize(
    "page,want",
    [
        ('<html lang="de"><head><title>A &amp; B</title></head><body><h1>Hi</h1><p>Text</p></body></html>', {"titles": ["A & B"], "h1": ["Hi"], "text": "A & B. Hi. Text.", "language": "de"}),
        ("<article><h1>T</h1><p><b>x<br><p>y</p></article><footer>z</footer>", {"h1": ["T"], "bold": [{"text": "x y z", "n": 1, "first": 0}], "articles": [], "text": "T. x. y. z."}),
        ("<p>a</p><!--googleoff: index--><p>b</p><!--googleon: index--><p>c</p>", {"text": "a. c."}),
        ('<script>var t="</p>";</script><p>k</p>', {"text": "k."}),
        ("text \x01", {"binary": True}),
        ('<link rel="stylesheet" href="/a.css">', {"css": [], "anchors": []}),
        ('<img src="/i.png" width="550px" height="10" alt="Cat.">', {"images": [{"url": "http://h/i.png", "alt": "Cat.", "width": 550, "height": 10}]}),
        ("space&nbsp;t&auml;st &foo;", {"text": "space täst &foo;"}),
        ("N 52° 28.025' E 13° 20.299'", {"lat": 52 + 28.025 / 60, "lon": 13 + 20.299 / 60}),
        ("<p>see http://b.org/x</p>", {"anchors": [{"url": "http://b.org/x", "text": "", "name": "", "rel": ""}]}),
        (None, {"text": "", "titles": []}),
    ],
)
def test_reader(page, want):
    got = html.parse(page, "http://h/x")
    for k, v in want.items():
        assert got[k] == v


def test_microdata_and_rdfa():
    page = """<div itemscope itemtype="http://schema.org/Person"><span itemprop="name">Ann</span><a itemprop="url" href="/a">x</a><div itemprop="address" itemscope itemtype="http://schema.org/Place"><meta itemprop="city" content="Ulm"></div></div>
    <p vocab="http://schema.org" typeof="Event"><b property="name">Fair</b></p><i itemprop="lost">no item</i>"""
    ld = [json.loads(x) for x in html.parse(page, "http://h/")["ld"]]
    assert ld[0] == {"@context": "http://schema.org", "@type": "Person", "name": ["Ann"], "url": ["http://h/a"], "address": [{"@context": "http://schema.org", "@type": "Place", "city": ["Ulm"]}]}
    assert ld[1] == {"@context": "http://schema.org", "@type": "Event", "name": ["Fair"]}
    assert len(ld) == 2


def test_references():
    assert html.decode("space&nbsp;t&auml;st &foo; &amp;lt; &#65;&#x42;") == "space täst &foo; < AB"


@given(st.text(alphabet="<>/!-ab \"'=&;", max_size=60))
@settings(max_examples=200, deadline=None)
def test_reader_takes_anything(page):
    html.parse(page, "http://h/")


def record(spark, page, url="http://h/x", headers=None, **more):
    df = spark.createDataFrame([(url, page, headers or {})], "url string, html string, headers map<string,string>")
    return plan.index_record(html.with_html(df), F.lit("2024-01-01").cast("timestamp"), **more).first()


def test_links_counted_and_listed_by_different_rules(spark):
    r = record(spark, '<a href="http://a.org/x">1</a><a href="http://sub.a.org/y">2</a><a href="http://b.org/">3</a>', "http://www.a.org/")
    assert (r.inboundlinkscount_i, r.outboundlinkscount_i) == (2, 1)
    assert (len(r.inboundlinks_sxt), len(r.outboundlinks_sxt)) == (1, 2)


def test_robots_and_headings(spark):
    r = record(spark, '<meta name="robots" content="noindex,follow"><h1>a</h1><h3>b</h3>', headers={"x-robots-tag": "none"})
    assert r.robots_i == 4 + 8 + 512 + 1024
    assert r.htags_i == 5
    assert record(spark, '<meta name="robots" content="index, follow">').robots_i == 6


def test_styles_are_ordered_by_count_then_arrival(spark):
    r = record(spark, "<b>x</b><b>y</b><b>y</b><b>z</b>")
    assert (r.bold_txt, r.bold_val) == (["y", "z", "x"], [2, 1, 1])


def test_canonical(spark):
    df = spark.createDataFrame([("http://h/x", '<link rel="canonical" href="/c">'), ("http://h/y", "<p>k</p>")], "url string, html string")
    index = plan.index_record(html.with_html(df), F.lit("2024-01-01").cast("timestamp"))
    own, other = plan.canonical_split(index)
    assert [r.url_s for r in own.collect()] == ["http://h/y"]
    assert [r.canonical_s for r in other.collect()] == ["http://h/c"]
    assert {r.status for r in plan.crawler_status(index, F.current_timestamp()).collect()} == {"parsed", "noncanonical"}


def test_collections_and_dates(spark):
    r = record(spark, "<p>Donnerstag, 18. Dezember 2014 xyz</p>", collections=[("h", "http://h/.*"), ("x", "https.*")], run_date=dt.date(2020, 6, 1))
    assert r.collection_sxt == ["h"]
    assert r.dates_in_content_dts == [dt.date(2014, 12, 18)]


def test_word_count(spark):
    df = spark.createDataFrame([("",), ("a",), ("a  b",), (None,)], "t string")
    assert [r.n for r in df.select(T.word_count(F.col("t")).alias("n")).collect()] == [0, 1, 3, 0]


def test_of_too_many_links_the_oldest_go():
    page = "".join(f'<a href="/{i}">x</a>' for i in range(html.MAX_LINKS + 5))
    got = html.parse(page, "http://h/")["anchors"]
    assert len(got) == html.MAX_LINKS and got[0]["url"] == "http://h/5" and got[-1]["url"] == f"http://h/{html.MAX_LINKS + 4}"
