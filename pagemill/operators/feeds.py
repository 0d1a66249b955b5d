"""Feeds and other small XML: items with bounded history, search descriptions, tables, configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Names under which feeds give the same token, the first present one counting.
TOKENS = {"title": ("title", "dc:title"), "link": ("link", "guid"), "description": ("description", "summary", "content:encoded", "dc:description"), "author": ("author", "dc:creator", "creator"), "date": ("pubDate", "dc:date", "updated", "published"), "subject": ("category", "dc:subject")}


def token(values: Column, name: str) -> Column:
    """A token of a map by any of its names."""
    return F.coalesce(*[F.try_element_at(values, F.lit(n)) for n in TOKENS[name]])


def guid(values: Column) -> Column:
    """The item's own id, or one made of link and title."""
    own = F.coalesce(F.try_element_at(values, F.lit("guid")), F.try_element_at(values, F.lit("id")))
    return F.coalesce(own, token(values, "link"), F.md5(F.coalesce(token(values, "title"), F.lit(""))))


def latest_items(items: DataFrame, feed: str, key: str, order: str, most: int = 10_000) -> DataFrame:
    """One row per item, the last; of each feed the newest so many."""
    rest = [c for c in items.columns if c not in (feed, key, order)]
    one = items.groupBy(feed, key).agg(F.max(F.struct(order, *rest)).alias("_l")).select(feed, key, *[F.col(f"_l.{c}").alias(c) for c in (order, *rest)])
    return one.withColumn("_r", F.row_number().over(Window.partitionBy(feed).orderBy(F.col(order).desc(), key))).where(F.col("_r") <= most).drop("_r")


def open_search(df: DataFrame, xml: str) -> DataFrame:
    """Templates of a search description: name, html, rss and atom addresses."""
    url = lambda kind: F.regexp_extract(F.col(xml), rf"(?is)<Url[^>]*type=\"{kind}\"[^>]*template=\"([^\"]*)\"", 1)
    return df.select(F.regexp_extract(F.col(xml), r"(?is)<ShortName[^>]*>([^<]*)", 1).alias("name"), url("text/html").alias("html"), url(r"application/rss\+xml").alias("rss"), url(r"application/atom\+xml").alias("atom"))


def table_cells(df: DataFrame, xml: str) -> DataFrame:
    """(table, row, key, value) of <table name><row key><prop name>value texts."""
    rows = F.regexp_extract_all(F.col(xml), F.lit(r"(?s)<table name=\"[^\"]*\">.*?</table>"), 0)
    t = df.select(F.explode(rows).alias("t")).select(F.regexp_extract("t", "name=\"([^\"]*)\"", 1).alias("table"), F.explode(F.regexp_extract_all(F.col("t"), F.lit("(?s)<row key=\"[^\"]*\">.*?</row>"), 0)).alias("r"))
    p = t.select("table", F.regexp_extract("r", "key=\"([^\"]*)\"", 1).alias("row"), F.explode(F.regexp_extract_all(F.col("r"), F.lit("<prop name=\"[^\"]*\">[^<]*"), 0)).alias("p"))
    return p.select("table", "row", F.regexp_extract("p", "name=\"([^\"]*)\"", 1).alias("key"), F.regexp_extract("p", ">(.*)$", 1).alias("value"))


def settings(lines: DataFrame) -> DataFrame:
    """(key, enabled, comment) of lines ``key`` and ``#key``; a line with # and a blank is the comment of the next, which ``position`` orders."""
    w = Window.orderBy("position")  # a settings file is small
    kind = F.when(F.col("value").rlike(r"^\s*#\s"), "comment").when(F.trim("value") == "", "none").otherwise("key")
    before = lines.withColumn("kind", kind).withColumn("comment", F.when(F.lag("kind").over(w) == "comment", F.regexp_replace(F.lag("value").over(w), r"^\s*#\s*", "")))
    return before.where("kind = 'key'").select(F.regexp_replace(F.trim("value"), "^#", "").alias("key"), (~F.trim("value").startswith("#")).alias("enabled"), "comment")


def envelope(df: DataFrame, group: str, row: Column) -> DataFrame:
    """A JSON answer for each group: its rows and their number."""
    return df.groupBy(group).agg(F.to_json(F.struct(F.array_sort(F.collect_list(row)).alias("data"), F.count(F.lit(1)).alias("count"))).alias("answer"))
