"""Pattern models over document elements, and vocabularies read from CSS classes."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.arrow import map_rows
from pagemill.functions import html
from pagemill.operators import literals

# The elements that patterns may name.
ELEMENTS = "text title bodyclass divid csspath metagenerator url scriptpath scriptcode framepath iframepath imgpath apath comment".split()


LINE_END = re.compile(r"[\r\n]")


def evaluate(elements: DataFrame, models: DataFrame) -> DataFrame:
    """(id, model, subject, n): how many elements of a document match a subject's patterns in full.
    ``elements`` has id, element and value; ``models`` model, subject, element and pattern, of any number."""
    met = literals.matches(elements, "value", models.where(F.col("element").isin(*ELEMENTS)), on=("element",))
    return met.groupBy("id", "model", "subject").agg(F.count(F.lit(1)).alias("n"))


class ElementReader(html.Reader):
    """What patterns are held against: (element, value) in the order of the page. Addresses of frames are resolved, others are as they are written."""

    def __init__(self, url: str):
        super().__init__(url)
        self.found: list[dict] = []
        self.add("url", url)

    def add(self, element: str, value: str) -> None:
        self.found.append({"element": element, "value": value})

    def words(self, raw: str, inside: str | None) -> None:
        if not self.off and inside not in ("script", "style"):
            self.add("text", html.decode(raw))

    def remark(self, comment: str) -> None:
        super().remark(comment)
        self.add("comment", LINE_END.sub(" ", comment[4:].removesuffix("-->")))

    def opened(self, name: str, a: dict[str, str]) -> None:
        if name == "body":
            self.add("bodyclass", a.get("class", ""))

    def single(self, name: str, a: dict[str, str]) -> None:
        if name == "base":
            super().single(name, a)
        elif name == "img":
            self.add("imgpath", a.get("src", ""))
        elif name in ("frame", "iframe") and a.get("src"):
            self.add(name + "path", self.resolve(a["src"]))
        elif name == "meta" and a.get("name", "").lower() == "generator":
            self.add("metagenerator", a.get("content", ""))
        elif name == "link" and (a.get("rel", "").lower(), a.get("type", "").lower()) == ("stylesheet", "text/css"):
            self.add("csspath", a.get("href", ""))

    def closed(self, e: html.Element) -> None:
        if e.name == "a":
            inner = "".join(e.parts)
            if len(inner) < html.MAX_ANCHOR:
                self.add("apath", e.attrs.get("href", ""))
        elif e.name == "div":
            self.add("divid", e.attrs.get("id", ""))
        elif e.name == "title":
            self.add("title", html.plain("".join(e.parts)))
        elif e.name == "script" and e.attrs.get("src"):
            self.add("scriptpath", e.attrs["src"])
        elif e.name == "script":
            self.add("scriptcode", LINE_END.sub(" ", "".join(e.parts)))

    learn = lambda self, *_: None


def page_elements(pages: DataFrame, id_col: str, markup: str, url: str) -> DataFrame:
    """(id, element, value) of all that ``evaluate`` knows, of pages as they are; null and binary markup gives the address alone, a null address none."""

    def rows(it):
        for r in it:
            reader = ElementReader(r[url] or "")
            if r[markup] and not html._CONTROL.search(r[markup]):
                reader.read(r[markup])
            yield {"id": r[id_col], "found": reader.found[r[url] is None :]}

    kind = pages.schema[id_col].dataType.simpleString()
    got = map_rows(pages.select(id_col, markup, url), rows, f"id {kind}, found array<struct<element:string,value:string>>")
    return got.select("id", F.inline("found"))


def with_models(records: DataFrame, id_col: str, scores: DataFrame, models: list[str]) -> DataFrame:
    """The records with ext_<model>_txt and ext_<model>_val for each of these models: its subjects, most frequent first and equal ones by name, and
    how often each was found. null where a model found nothing. ``scores`` is what ``evaluate`` gives."""
    if len(set(models)) != len(models):
        raise ValueError("a model is named twice")
    if not models:
        return records
    lists = [F.array_sort(F.collect_list(F.when(F.col("model") == m, F.struct((-F.col("n")).alias("n"), "subject")))).alias(f"_{k}") for k, m in enumerate(models)]
    found = scores.where(F.col("model").isin(models)).groupBy(F.col("id").alias(id_col)).agg(*lists)
    out = records.join(found, id_col, "left")
    for k, m in enumerate(models):
        some = F.size(f"_{k}") > 0
        out = out.withColumns({f"ext_{m}_txt": F.when(some, F.transform(f"_{k}", lambda x: x["subject"])), f"ext_{m}_val": F.when(some, F.transform(f"_{k}", lambda x: -x["n"]))}).drop(f"_{k}")
    return out


#: Markup in pieces, where quotes in a tag may hold what ends one.
TOKEN = re.compile(r"<!--.{1,}?-.>|<!--.*\Z|<(?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+(?:>|(?=<)|\Z)|[^<]+", re.S)


class ClassReader(html.Reader):
    """Only the texts of elements with a class, in the order in which they close."""

    token = TOKEN

    def __init__(self):
        super().__init__("")
        self.found: list[dict] = []

    def closed(self, e: html.Element) -> None:
        names = e.attrs.get("class", "").split()
        if names and (text := html.plain("".join(e.parts))):
            self.found += [{"class": n, "text": text, "place": len(self.found)} for n in names]

    def words(self, raw: str, inside: str | None) -> None:
        pass

    learn = single = properties = lambda self, *_: None


def class_texts(pages: DataFrame, id_col: str, markup: str) -> DataFrame:
    """(id, class, text, place) of the elements with a class, by the reader's tree: whatever the quotes, with the text of all that they hold. Empty ones are left out."""

    def rows(it):
        for r in it:
            reader = ClassReader()
            if r[markup] and not html._CONTROL.search(r[markup]):
                reader.read(r[markup])
            yield {"id": r[id_col], "found": reader.found}

    kind = pages.schema[id_col].dataType.simpleString()
    got = map_rows(pages.select(id_col, markup), rows, f"id {kind}, found array<struct<class:string,text:string,place:int>>")
    return got.select(F.col("id").alias(id_col), F.inline("found"))


def class_terms(pages: DataFrame, id_col: str, markup: str, rules: dict[str, str] | DataFrame) -> DataFrame:
    """(document, vocabulary, term): for each vocabulary the text of the first element of its classes. Rules are pairs of class and vocabulary, of any number."""
    if isinstance(rules, dict):
        rules = pages.sparkSession.createDataFrame(list(rules.items()), "class string, vocabulary string")
    met = class_texts(pages, id_col, markup).join(rules.select("class", "vocabulary"), "class")
    return met.groupBy(id_col, "vocabulary").agg(F.min_by("text", F.struct("place", "class")).alias("term"))


def links(pages: DataFrame, id_col: str, markup: str, black_list: list[str]) -> DataFrame:
    """Targets of links, without those that a black list's pattern finds something in."""
    found = F.array_distinct(F.regexp_extract_all(F.col(markup), F.lit(r"(?i)href\s*=\s*[\"']([^\"'#][^\"']*)[\"']"), 1))
    if black_list:
        found = F.filter(found, lambda u: ~u.rlike("|".join(f"(?:{p})" for p in black_list)))
    return pages.select(id_col, F.explode(found).alias("target"))


def closest_icon(icons, width: int, height: int):
    """Of an array of icon structs (url, rels, sizes as texts like 16x16) the address of the one nearest in size."""
    def distance(s):
        w, h = F.split_part(s, F.lit("x"), F.lit(1)).try_cast("int"), F.split_part(s, F.lit("x"), F.lit(2)).try_cast("int")
        return F.abs(w - width) + F.abs(h - height)

    scored = F.transform(icons, lambda i: F.struct(F.coalesce(F.array_min(F.transform(i["sizes"], distance)), F.lit(1 << 30)).alias("d"), i["url"].alias("url")))
    return F.array_min(scored)["url"]
