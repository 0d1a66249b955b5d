"""Writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_lines(df: DataFrame, path: str, compression: str = "gzip", mode: str = "errorifexists") -> None:
    """One record per line; absent keys for nulls."""
    df.write.mode(mode).option("ignoreNullFields", "true").option("compression", compression).json(path)


def text_lines(df: DataFrame, path: str, compression: str = "gzip", mode: str = "errorifexists") -> None:
    """A frame of one string column, such as bulk lines."""
    df.write.mode(mode).option("compression", compression).text(path)


def upsert(old: DataFrame, new: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The latest state of each key over both; write it to a new place and swap."""
    from pagemill.operators.documents import latest

    return latest(old.unionByName(new), key, order)


def _escape(c: Column) -> Column:
    out = c
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def dublin_core(df: DataFrame) -> DataFrame:
    """XML records of title, creator, publisher, subject, text, and the place if there is one."""
    cdata = lambda c: F.concat(F.lit("<![CDATA["), F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("]]>"), F.lit("]]]]><![CDATA[>")), F.lit("]]>"))
    one = lambda tag, body: F.concat(F.lit(f"<dc:{tag}>"), body, F.lit(f"</dc:{tag}>"))
    geo = F.when((F.col("lat") != 0) & (F.col("lon") != 0), F.concat(F.lit("<geo:lat>"), F.col("lat").cast("string"), F.lit("</geo:lat><geo:long>"), F.col("lon").cast("string"), F.lit("</geo:long>"))).otherwise(F.lit(""))
    return df.select(F.concat(F.lit("<record>"), one("title", cdata("title")), one("creator", cdata("creator")), one("publisher", cdata("publisher")), one("subject", cdata("subject")), one("text", cdata("text")), one("identifier", _escape(F.col("url"))), geo, F.lit("</record>")).alias("value"))


def rss_items(df: DataFrame) -> DataFrame:
    return df.select(F.concat(F.lit("<item><title>"), _escape(F.col("title")), F.lit("</title><link>"), _escape(F.col("url")), F.lit("</link><guid>"), _escape(F.col("id")), F.lit("</guid></item>")).alias("value"))


def rdf_nodes(df: DataFrame) -> DataFrame:
    """(subject, predicate, object) rows as one RDF description per subject."""
    each = lambda x: F.concat(F.lit("<"), x["predicate"], F.lit(">"), _escape(x["object"]), F.lit("</"), x["predicate"], F.lit(">"))
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("predicate", "object"))), each), "")
    return df.groupBy("subject").agg(parts.alias("p")).select(F.concat(F.lit('<rdf:Description rdf:about="'), _escape(F.col("subject")), F.lit('">'), F.col("p"), F.lit("</rdf:Description>")).alias("value"))


def property_lines(df: DataFrame, key: str, value: str) -> DataFrame:
    esc = lambda c: F.replace(F.replace(F.replace(F.col(c), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("="), F.lit("\\="))
    return df.select(F.concat(esc(key), F.lit("="), esc(value)).alias("value"))


def word_list(words: DataFrame, word: str) -> DataFrame:
    return words.select(F.col(word).alias("value")).distinct().orderBy("value")
