"""Pages go to Python a hundred at a time, so that a worker's memory does not grow with the table; what they give stays the same."""

import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as entry
from pagemill.functions import html
from pagemill.sources import warc


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_no_arrow_batches_of_pages(spark, sf_dir, capsys):
    for name in ("html_index_wide", "graph_edges", "html_text_wordcount"):
        plan = plan_of(entry.queries()[name](spark, sf_dir), capsys)
        assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan and "MapInArrow" not in plan, name


def test_payloads_are_decoded_a_few_at_a_time(spark, sf_dir, capsys):
    plan = plan_of(entry.queries()["stream_jobs"](spark, sf_dir), capsys)
    assert plan.count("BatchEvalPython") == 2 and "ArrowEvalPython" not in plan
    assert plan.count("MapInArrow") == 1  # files that give many records


def test_a_payload_that_is_null_empty_or_no_text(spark):
    rows = [(None, None), (b"", None), ("ä".encode(), "text/html; charset=utf-8"), (b"\xe4", "text/html; charset=none-such"), (b"\xff\xfe\x3d\xd8\x00\xde", None)]
    df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "n int, payload binary, content_type string")
    got = df.select("n", warc.decoded(F.col("payload"), F.col("content_type")).alias("t")).collect()
    assert [r.t for r in sorted(got)] == [None, "", "ä", "ä", "\U0001f600"]


def test_a_page_is_read_once_whatever_is_filtered(spark, sf_dir, capsys):
    p = html.with_html(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    plan = plan_of(p.where(F.size("page.titles") > 0).where(F.col("page.text") != "").select("url", "page.text", "page.li"), capsys)
    assert plan.count("BatchEvalPython") == 1


def test_values_beside_and_in_a_page(spark):
    page = '<meta name="author" content="Ann"><link rel="alternate" hreflang="de" href="/de"><link rel="next" href="/n"><b>x</b><b>x</b><img src="/a" width="3000000000" height="1"><img src="/b" width="2147483647">'
    when = dt.datetime(1900, 1, 1, 0, 0, 0, 7)
    df = spark.createDataFrame([(when, {"k": "v"}, page, "http://h/x"), (None, None, None, None)], "at timestamp, headers map<string,string>, html string, url string")
    got = html.with_html(df)
    assert got.columns == ["at", "headers", "url", "page"]
    one, none = sorted(got.collect(), key=lambda r: r.url is None)
    assert (one["at"], one.headers, one.url) == (when, {"k": "v"}, "http://h/x")
    assert (one.page.metas, one.page.hreflang, one.page.navigation) == ({"author": "Ann"}, {"de": "http://h/de"}, {"next": "http://h/n"})
    assert [x.asDict() for x in one.page.bold] == [{"text": "x", "n": 2, "first": 0}]
    assert [(x.url, x.width, x.height) for x in one.page.images] == [("http://h/b", 2147483647, -1)]
    assert (none["at"], none.headers, none.page.text, none.page.lat, none.page.binary) == (None, None, "", 0.0, False)
