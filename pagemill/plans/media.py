"""Links of many documents by what they lead to, each target once; of several mentions the latest describes it.

Rows have url, the struct ``page`` of pagemill.functions.html and a column that orders documents. Targets that many
documents share are combined before the shuffle, as the latest mention is a maximum. Documents that are equal
in order are told apart by their address; a document without order comes first. Null addresses of documents count as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.functions import url as U
from pagemill.plans.index import media_class

P = "page."


def meta(name: str) -> Column:
    return F.coalesce(F.try_element_at(P + "metas", F.lit(name)), F.lit(""))


def title() -> Column:
    heads = F.concat(*[F.col(f"{P}h{k}") for k in range(1, 7)])
    return F.coalesce(F.try_element_at(P + "titles", F.lit(1)), F.nullif(meta("title"), F.lit("")), F.try_element_at(heads, F.lit(1)), F.lit(""))


def subject() -> Column:
    """The document's title, its description if that says something else, and its keywords."""
    about = F.coalesce(F.nullif(meta("description"), F.lit("")), F.nullif(meta("dc.description"), F.lit("")), F.nullif(meta("og:description"), F.lit("")))
    return F.concat(title(), F.when(about.isNotNull() & (about != title()), F.concat(F.lit(" "), about)).otherwise(""), F.lit(" "), F.array_join(T.keywords(meta("keywords")), ","))


def description(subject: Column, own: Column, name: Column) -> Column:
    """The subject of the document, and after a dash the link's text or else the words of the document's address."""
    said = F.when(F.coalesce(name, F.lit("")) == "", own).otherwise(name)
    return F.trim(F.concat(subject, F.when(said != "", F.concat(F.lit(" - "), said)).otherwise("")))


def mentions(*groups: Column) -> Column:
    """Arrays of (url, kind, name), later groups later, each with its place."""
    def ranked(rank: int):
        return lambda x, i: F.struct(x["url"].alias("url"), x["kind"].alias("kind"), x["name"].alias("name"), F.lit(rank).alias("rank"), i.alias("place"))

    return F.concat(*[F.transform(g, ranked(rank)) for rank, g in enumerate(groups)])


def mention(url: Column, kind: Column, name: Column) -> Column:
    return F.struct(url.alias("url"), kind.cast("string").alias("kind"), name.cast("string").alias("name"))


def latest(found: DataFrame, value: str, *keys: str) -> DataFrame:
    at = F.struct("order", "from", "rank", "place", value)
    return found.groupBy(*keys).agg(F.max(at)[value].alias(value), F.count(F.lit(1)).alias("mentions"))


def media_links(docs: DataFrame, order: str) -> DataFrame:
    """(kind, url, description, mentions): images, audio, video and programs that documents show or link to. A link to an image counts as an image and says more than the image shown."""
    shown = F.transform(P + "images", lambda i: mention(U.normal_form(i["url"]), F.lit("image"), i["alt"]))
    linked = F.filter(F.transform(P + "anchors", lambda a: mention(U.normal_form(a["url"]), media_class(U.normal_form(a["url"])), a["text"])), lambda x: x["kind"].isNotNull())
    url = F.coalesce("url", F.lit(""))
    told = docs.select(F.col(order).alias("order"), url.alias("from"), subject().alias("subject"), F.array_join(U.tokens(url), " ").alias("own"), mentions(shown, linked).alias("m"))
    each = told.select("order", "from", "subject", "own", F.explode_outer("m").alias("m")).where("m is not null")  # what the document says is worked out once; outer, so that no filter on the array works it out again
    named = each.select("order", "from", "m.kind", "m.url", "m.rank", "m.place", description(F.col("subject"), F.col("own"), F.col("m.name")).alias("description"))
    return latest(named, "description", "kind", "url")


def hyperlinks(docs: DataFrame, order: str, with_nofollow: bool = True) -> DataFrame:
    """(url, text, mentions): targets of links with their texts, and those of refresh, canonical, frame, iframe and embed with that word, which a document says last."""
    one = lambda url, word: F.when(F.coalesce(url, F.lit("")) == "", F.expr("cast(array() as array<struct<url:string,kind:string,name:string>>)")).otherwise(F.array(mention(url, F.lit(None), F.lit(word))))
    all_of = lambda urls, word: F.transform(urls, lambda u: mention(U.normal_form(u), F.lit(None), F.lit(word)))
    anchors = F.filter(P + "anchors", lambda a: F.lit(with_nofollow) | ~a["rel"].contains("nofollow"))
    refresh = F.regexp_extract(meta("refresh"), r"(?i)url\s*=\s*['\"]?([^'\"\s]+)", 1)
    found = mentions(
        F.transform(anchors, lambda a: mention(U.normal_form(a["url"]), F.lit(None), a["text"])), one(refresh, "refresh"), one(U.normal_form(F.col(P + "canonical")), "canonical"),
        all_of(P + "frames", "frame"), all_of(P + "iframes", "iframe"), all_of(F.transform(P + "embeds", lambda e: e["url"]), "embed"),
    )
    each = docs.select(F.col(order).alias("order"), F.coalesce("url", F.lit("")).alias("from"), F.explode(found).alias("m"))
    return latest(each.select("order", "from", "m.url", "m.rank", "m.place", F.col("m.name").alias("text")), "text", "url")
