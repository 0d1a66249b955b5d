"""Linked data, pattern models, feeds and operators on small tables."""

import json

from pyspark.sql import functions as F

from pagemill.functions import jsonld
from pagemill.operators import documents, feeds, joins, lookup, patterns, scores, setops


def test_forms():
    f = jsonld.forms(['{"@context":{"n":"http://schema.org/name","knows":{"@id":"http://x/knows"}},"@id":"a","n":"A","knows":{"@id":"b","n":"B"}}', "{broken"])
    assert json.loads(f["ld"]) == [{"@id": "a", "http://schema.org/name": [{"@value": "A"}], "http://x/knows": [{"@id": "b", "http://schema.org/name": [{"@value": "B"}]}]}]
    assert [n["@id"] for n in json.loads(f["flat"])] == ["a", "b"]
    assert json.loads(f["tree"]) == [{"@id": "a", "schema:name": "A", "http://x/knows": {"@id": "b", "schema:name": "B"}}]


def test_circles_end():
    f = jsonld.forms(['{"@context":"https://schema.org","@graph":[{"@id":"a","knows":{"@id":"b"}},{"@id":"b","knows":{"@id":"a"}}]}'])
    assert json.loads(f["tree"])[0]["@id"] == "a"


def test_feeds(spark):
    m = spark.createDataFrame([({"dc:title": "T", "guid": "g"},), ({"summary": "s", "link": "l"},)], "v map<string,string>")
    got = m.select(feeds.token(F.col("v"), "title").alias("t"), feeds.guid(F.col("v")).alias("g")).collect()
    assert [(r.t, r.g) for r in got] == [("T", "g"), (None, "l")]
    xml = '<OpenSearchDescription><ShortName>S</ShortName><Url type="application/rss+xml" template="http://h/?q={searchTerms}"/></OpenSearchDescription>'
    r = feeds.open_search(spark.createDataFrame([(xml,)], "x string"), "x").first()
    assert (r.name, r.rss) == ("S", "http://h/?q={searchTerms}")
    cells = feeds.table_cells(spark.createDataFrame([('<table name="t"><row key="1"><prop name="a">x</prop><prop name="b">y</prop></row></table>',)], "x string"), "x").collect()
    assert [(c.table, c.row, c.key, c.value) for c in cells] == [("t", "1", "a", "x"), ("t", "1", "b", "y")]
    s = feeds.settings(spark.createDataFrame([(0, "# on"), (1, "key"), (2, "#off")], "position int, value string")).collect()
    assert [(r.key, r.enabled, r.comment) for r in s] == [("key", True, "on"), ("off", False, None)]


def test_icons(spark):
    df = spark.createDataFrame([([("big", ["64x64"]), ("small", ["16x16", "24x24"]), ("none", [])],)], "i array<struct<url:string,sizes:array<string>>>")
    assert df.select(patterns.closest_icon(F.col("i"), 20, 20).alias("u")).first().u == "small"


def test_empty_tables_give_empty_results(spark):
    kv = spark.createDataFrame([], "k long, v string")
    full = spark.createDataFrame([(1, "a")], "k long, v string")
    assert joins.nway_join([full, kv, full], "k", "v").count() == 0
    assert setops.rotate(kv, [F.col("k")], 5).count() == 0
    assert scores.shrink_to_size(spark.createDataFrame([], "element string, score long, arrival long"), 3).count() == 0
    assert documents.latest(kv, "k", ["v"]).count() == 0


def test_shrinking_drops_whole_classes(spark):
    sm = spark.createDataFrame([("a", 3, 0), ("b", 2, 1), ("c", 2, 2), ("d", 1, 3)], "element string, score long, arrival long")
    assert {r.element for r in scores.shrink_to_size(sm, 2).collect()} == {"a"}
    assert {r.element for r in scores.shrink_to_size(sm, 3).collect()} == {"a", "b", "c"}


def test_places(spark):
    g = spark.createDataFrame([("Ulm", 1, 1.0, 1.0, 10_001), ("ULM", 2, 2.0, 2.0, 9_999)], "name string, id int, lat double, lon double, population long")
    got = lookup.find_places(spark.createDataFrame([("ulm",)], "q string"), "q", g).orderBy("rank").collect()
    assert [r.id for r in got] == [1, 2]
