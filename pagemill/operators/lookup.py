"""Vocabularies, synonyms and gazetteers. Their tables are joined; Spark broadcasts those it measures to be small."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions import geo
from pagemill.functions import text as T
from pagemill.operators.joins import recommend


def vocabulary(lines: DataFrame, name: Column) -> DataFrame:
    """Lines ``term:syn,syn#link`` (also with = or a tab) as (vocabulary, term, synonym, objectlink); a term is its own synonym. Comment lines start with #."""
    raw = lines.where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    link = F.when(F.col("value").contains("#"), F.trim(F.regexp_extract("value", "#(.*)$", 1)))
    body = F.regexp_replace("value", "#.*$", "")
    sep = F.when(body.contains(":"), ":").when(body.contains("="), "=").otherwise("\t")
    term = F.trim(F.split_part(body, sep, F.lit(1)))
    words = F.array_union(F.array(T.normalized_term(term)), F.filter(F.transform(F.split(F.substring(body, F.length(term) + 2, F.length(body)), ","), lambda x: T.normalized_term(x)), lambda w: w != ""))
    return raw.select(name.alias("vocabulary"), term.alias("term"), F.explode(words).alias("synonym"), link.alias("objectlink"))


def facets(docs: DataFrame, id_col: str, text: str, vocab: DataFrame) -> DataFrame:
    """(document, vocabulary, terms): the terms of each vocabulary whose synonyms a text holds, of any number of words.

    The vocabulary meets the distinct words of a text by the first word of each synonym; only where that is found the synonym is looked for."""
    words = F.filter(F.split(T.normalized_term(F.regexp_replace(F.col(text), r"[.!?;:()]", " ")), " +"), lambda w: w != "")
    w = docs.select(id_col, words.alias("w"))
    starts = vocab.select(F.split_part("synonym", F.lit(" "), F.lit(1)).alias("word"), F.struct("vocabulary", "term", "synonym").alias("s"))
    wanted = w.select(id_col, F.explode(F.array_distinct("w")).alias("word")).join(starts, "word").groupBy(id_col).agg(F.collect_set("s").alias("s"))
    run = w.select(id_col, F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")).alias("run"))
    hit = run.join(wanted, id_col).select(id_col, F.explode(F.filter("s", lambda x: F.contains("run", F.concat(F.lit(" "), x["synonym"], F.lit(" "))))).alias("s")).select(id_col, "s.*")
    return hit.groupBy(id_col, "vocabulary").agg(F.array_sort(F.collect_set("term")).alias("terms"))


def synonym_sets(lines: DataFrame) -> DataFrame:
    """Lines ``{a,b,c}`` as (set_id, word); words of one character are dropped."""
    words = F.split(F.regexp_replace(F.lower("value"), "[{}]", ""), ",")
    return lines.select(F.col("set_id"), F.explode(F.transform(words, lambda x: F.trim(x))).alias("word")).where(F.length("word") > 1).distinct()


def synonyms(words: DataFrame, word: str, sets: DataFrame) -> DataFrame:
    """Each known word with the others of the first set that holds it."""
    first = sets.groupBy(F.col("word").alias(word)).agg(F.min("set_id").alias("set_id"))
    return words.select(word).distinct().join(first, word).join(sets, "set_id").where(F.col("word") != F.col(word)).groupBy(word).agg(F.array_sort(F.collect_set("word")).alias("synonyms"))


def first_per_vocabulary(hits: DataFrame, by: list[str], pos: str) -> DataFrame:
    return hits.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(pos))).where("_r = 1").drop("_r")


def geonames(path_rows: DataFrame, words: DataFrame | None = None, least_population: int = 0) -> DataFrame:
    """Tab-separated gazetteer lines as (name, id, lat, lon, population); names are those of columns 1 to 3, of four characters or more and not dictionary words."""
    c = F.split("value", "\t")
    names = F.array_distinct(F.filter(F.transform(F.concat(F.array(c[1], c[2]), F.split(c[3], ",")), lambda x: F.trim(x)), lambda n: F.length(n) >= 4))
    rows = path_rows.where(F.size(c) >= 15).select(F.explode(names).alias("name"), c[0].cast("int").alias("id"), c[4].cast("float").alias("lat"), c[5].cast("float").alias("lon"), F.coalesce(c[14].try_cast("long"), F.lit(0)).alias("population")).where(F.col("population") >= least_population)
    return rows if words is None else rows.join(words.select(F.lower("word").alias("_w")), F.lower("name") == F.col("_w"), "left_anti")


def find_places(asked: DataFrame, name: str, gazetteer: DataFrame) -> DataFrame:
    """All places of a name, whatever its case, the largest first."""
    g = gazetteer.select(F.lower("name").alias("_k"), F.col("name").alias("place"), "id", "lat", "lon", "population")
    hit = asked.select(name).distinct().join(g, F.lower(F.col(name)) == F.col("_k")).drop("_k")
    return hit.withColumn("rank", F.row_number().over(Window.partitionBy(name).orderBy(F.col("population").desc(), "id")))


#: How a name was understood, in the order in which the ways are tried.
WAYS = ("name", "plate", "dial", "zip")


def find_by_any_name(asked: DataFrame, name: str, services: list[DataFrame]) -> DataFrame:
    """Places that begin with a name (whatever its case), or have it as plate, dialling code or postal code, over several gazetteers.

    A gazetteer has name, id, lat, lon and population, and plate, dial and zip, which may be null. Result: (name, service, id, place, how, population, rank): each place once for
    a name and service, by the first way that finds it; larger places first, then service and id."""
    out = []
    for k, g in enumerate(services):
        g = g.select(F.col("name").alias("place"), "id", "lat", "lon", "population", "plate", "dial", "zip")
        begins = recommend(g, asked, "place", name, ignore_case=True, longer=False).select(F.col("query").alias("q"), F.col("word").alias("place")).join(g, "place").withColumn("how", F.lit(0))
        ways = F.array(*[F.struct(F.lit(i).alias("how"), F.col(w).cast("string").alias("q")) for i, w in enumerate(WAYS[1:], 1)])
        codes = g.select("*", F.inline(ways)).where("q is not null").join(asked.select(F.col(name).alias("q")).distinct(), "q")
        both = begins.unionByName(codes.select(begins.columns)).groupBy("q", "id").agg(F.min_by(F.struct("place", "lat", "lon", "population", "how"), F.struct("how", "place")).alias("p"))
        out.append(both.select(F.col("q").alias(name), F.lit(k).alias("service"), "id", "p.place", "p.lat", "p.lon", F.try_element_at(F.array(*map(F.lit, WAYS)), F.col("p.how") + 1).alias("how"), "p.population"))
    met = reduce(DataFrame.unionByName, out)
    order = Window.partitionBy(name).orderBy(*geo.place_key(F.col("population"), F.col("service")), "id")
    return met.withColumn("rank", F.row_number().over(order))


def by_number(asked: DataFrame, number: str, gazetteer: DataFrame, longest: int = 15) -> DataFrame:
    """Each number with the place of the longest dialling code that it begins with; signs between digits do not count. Numbers meet codes by equality, once for each length up to ``longest``."""
    digits = F.regexp_replace(F.col(number), "[^0-9]", "")
    heads = asked.select(number).distinct().withColumn("_d", digits).where("_d <> ''").withColumn("dial", F.explode(F.transform(F.sequence(F.lit(1), F.least(F.length("_d"), F.lit(longest))), lambda n: F.left("_d", n))))
    g = gazetteer.where("dial is not null").groupBy("dial").agg(F.min_by(F.struct("name", "id"), F.struct(-F.col("population"), F.col("id"))).alias("p"))
    met = heads.join(g, "dial").groupBy(number).agg(F.max_by(F.struct("dial", "p"), F.length("dial")).alias("b"))
    return met.select(number, F.col("b.dial").alias("dial"), F.col("b.p.name").alias("place"), F.col("b.p.id").alias("id"))


def put(vocab: DataFrame, additions: DataFrame) -> DataFrame:
    """A vocabulary with further rows; those of a term that is there already replace its object link."""
    new = additions.groupBy("vocabulary", "term").agg(F.max("objectlink").alias("new"))
    both = vocab.unionByName(additions).groupBy("vocabulary", "term", "synonym").agg(F.max("objectlink").alias("objectlink"))
    return both.join(new, ["vocabulary", "term"], "left").select("vocabulary", "term", "synonym", F.coalesce("new", "objectlink").alias("objectlink"))


def delete(vocab: DataFrame, terms: DataFrame) -> DataFrame:
    return vocab.join(terms.select("term"), "term", "left_anti").select(vocab.columns)


def vocabulary_lines(vocab: DataFrame) -> DataFrame:
    """Lines that the reader takes, one per term."""
    syn = F.array_join(F.array_sort(F.collect_set("synonym")), ",")
    return vocab.groupBy("vocabulary", "term").agg(syn.alias("s"), F.max("objectlink").alias("l")).select("vocabulary", F.concat(F.col("term"), F.lit(":"), F.col("s"), F.when(F.col("l").isNotNull(), F.concat(F.lit("#"), F.col("l"))).otherwise(F.lit(""))).alias("value"))


def places_vocabulary(gazetteer: DataFrame) -> DataFrame:
    """Places as a vocabulary: each name with the point of its largest place."""
    best = gazetteer.groupBy(F.lower("name").alias("k")).agg(F.max_by(F.struct("name", "lat", "lon"), F.struct("population", -F.col("id"))).alias("p"))
    return best.select(F.lit("locations").alias("vocabulary"), F.col("p.name").alias("term"), T.normalized_term(F.col("p.name")).alias("synonym"), F.concat(F.lit("geo:"), F.col("p.lat").cast("string"), F.lit(","), F.col("p.lon").cast("string")).alias("objectlink"))
