"""Readers of small text formats: maps, lists, words, vocabularies, gazetteers, rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators import lookup


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): lines of plain, .gz and .bz2 files, with the file's name without its extension."""
    return spark.read.text(path).select(F.regexp_replace(F.element_at(F.split(F.input_file_name(), "/"), -1), r"\..*$", "").alias("file"), "value")


def without_comments(df: DataFrame) -> DataFrame:
    """Text before a # at the start of a line or after a blank, trimmed; empty lines are dropped."""
    v = F.trim(F.regexp_replace("value", r"(^|\s)#.*$", ""))
    return df.withColumn("value", v).where("value <> ''")


def word_list(df: DataFrame, least: int = 4) -> DataFrame:
    return without_comments(df).select(F.lower("value").alias("word")).where(F.length("word") >= least).distinct()


def frequency_list(df: DataFrame, least: int = 4) -> DataFrame:
    """First fields of lines; comment lines are dropped."""
    return df.where(~F.col("value").startswith("#")).select(F.lower(F.split_part(F.trim("value"), F.lit(" "), F.lit(1))).alias("word")).where(F.length("word") >= least).distinct()


def property_map(df: DataFrame, many: bool = False) -> DataFrame:
    """key=value lines with escapes; the greatest value of a repeated key, or all of them."""
    marked = F.replace(F.replace(F.col("value"), F.lit("\\\\"), F.lit("\u0001")), F.lit("\\="), F.lit("\u0002"))
    back = lambda c: F.replace(F.replace(F.replace(c, F.lit("\\n"), F.lit("\n")), F.lit("\u0002"), F.lit("=")), F.lit("\u0001"), F.lit("\\"))
    kv = without_comments(df).select(marked.alias("m")).where(F.instr("m", "=") > 0).select(F.lower(F.trim(back(F.substring_index("m", "=", 1)))).alias("key"), F.trim(back(F.regexp_extract("m", "(?s)^[^=]*=(.*)$", 1))).alias("v"))
    return kv.groupBy("key").agg(F.array_sort(F.collect_list("v")).alias("values") if many else F.max("v").alias("value"))


def rewrite_rules(df: DataFrame) -> list[tuple[str, str]]:
    """pattern=replacement lines in order; s/ lines and patterns that are no regular expressions are left out. At most 10000, as they go into a plan."""
    import re

    out = []
    rules = without_comments(df).where(~F.col("value").startswith("s/"))
    if rules.count() > 20_000:  # they come to the driver
        raise ValueError("more than 20000 lines of rewrite rules")
    for r in rules.collect():
        pattern, eq, new = r["value"].partition("=")
        try:
            re.compile(pattern)
        except re.error:
            continue
        if eq:
            out.append((pattern, new))
    if len(out) > 10_000:
        raise ValueError("more than 10000 rules")
    return out


def vocabularies(spark: SparkSession, folder: str) -> DataFrame:
    return lookup.vocabulary(lines(spark, f"{folder}/*.vocabulary"), F.col("file"))


def geonames(spark: SparkSession, path: str, words: DataFrame | None = None, least_population: int = 0) -> DataFrame:
    return lookup.geonames(spark.read.text(path), words, least_population)


def opengeodb(df: DataFrame) -> DataFrame:
    """(id, kind, value, lat, lon) from the insert lines of a dump: names, dial prefixes, zips, plates and coordinates."""
    # The type codes of the dump.
    kinds = {"500100000": "name", "500400000": "dial", "500300000": "zip", "500500000": "plate"}
    c = F.split(F.regexp_replace("value", r"^INSERT INTO \w+ VALUES \(|\);?\s*$", ""), r",\s*(?=(?:[^']*'[^']*')*[^']*$)")
    unquote = lambda x: F.regexp_replace(F.trim(x), "^'|'$", "")
    points = df.where(F.col("value").startswith("INSERT INTO geodb_coordinates")).select(c[0].cast("int").alias("id"), F.lit("point").alias("kind"), F.lit(None).cast("string").alias("text"), c[2].cast("float").alias("lat"), c[3].cast("float").alias("lon"))
    code = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])
    texts = df.where(F.col("value").startswith("INSERT INTO geodb_textdata")).select(c[0].cast("int").alias("id"), F.try_element_at(code, F.trim(c[1])).alias("kind"), unquote(c[2]).alias("text"), F.lit(None).cast("float").alias("lat"), F.lit(None).cast("float").alias("lon")).where("kind is not null")
    return points.unionByName(texts)


def bayes_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(context, category, text): lines of files; the folder is the context, the file the category."""
    parts = F.split(F.input_file_name(), "/")
    return spark.read.option("recursiveFileLookup", "true").text(folder).select(F.element_at(parts, -2).alias("context"), F.regexp_replace(F.element_at(parts, -1), r"\..*$", "").alias("category"), F.col("value").alias("text"))


def pattern_models(df: DataFrame) -> DataFrame:
    """(model, subject, element, pattern) from subject_element=pattern lines; the file names the model."""
    key = F.split_part("value", F.lit("="), F.lit(1))
    return without_comments(df).select(F.col("file").alias("model"), F.regexp_extract(key, "^(.*)_[^_]*$", 1).alias("subject"), F.regexp_extract(key, "_([^_]*)$", 1).alias("element"), F.regexp_extract("value", "^[^=]*=(.*)$", 1).alias("pattern"))


def fixed_records(spark: SparkSession, path: str, length: int) -> DataFrame:
    """Records of equal length with their place in the file."""
    return spark.read.format("binaryFile").load(path).select("path", F.posexplode(F.transform(F.sequence(F.lit(0), F.floor((F.octet_length("content") - 1) / length).cast("int")), lambda i: F.substring(F.col("content"), i * length + 1, F.lit(length)))).alias("index", "record"))


def key_list(df: DataFrame) -> DataFrame:
    """Distinct small-letter keys of an append-only list."""
    return without_comments(df).select(F.lower("value").alias("key")).distinct()


def files(spark: SparkSession, path: str, pattern: str = ".*") -> DataFrame:
    """path, length and time of files under a folder whose whole path matches; their contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime").where(F.col("path").rlike(f"^(?:{pattern})$"))
