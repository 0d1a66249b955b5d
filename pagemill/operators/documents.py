"""Merging and folding of documents, latest states, grep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def in_order(value: Column, order: Column) -> Column:
    """All values of a group as an array in this order."""
    return F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v")))), lambda x: x["v"])


def merge(df: DataFrame, key: str, order: str, text: str, title: str | None = None) -> DataFrame:
    """One document per key: texts joined by line ends, distinct titles in order."""
    out = [F.array_join(in_order(F.col(text), F.col(order)), "\n").alias("text"), F.count(F.lit(1)).alias("parts")]
    if title:
        out.append(F.array_join(F.array_distinct(in_order(F.col(title), F.col(order))), ",").alias("titles"))
    return df.groupBy(key).agg(*out)


def phrases(df: DataFrame, order: str, parts: Column) -> DataFrame:
    """(phrase, n, documents, first_document, first_place): how often each phrase of an array column occurs, in how many documents, and where
    first. A phrase of all documents is combined before the shuffle; a document's repeated phrases count before that."""
    each = df.select(F.col(order).alias("_d"), F.posexplode(parts).alias("_p", "phrase"))
    within = each.groupBy("_d", "phrase").agg(F.count(F.lit(1)).alias("_n"), F.min("_p").alias("_p"))
    first = F.min(F.struct("_d", "_p"))
    return within.groupBy("phrase").agg(F.sum("_n").alias("n"), F.count("_d").alias("documents"), first.alias("_f")).select("phrase", "n", "documents", F.col("_f._d").alias("first_document"), F.col("_f._p").alias("first_place"))


def fold(parent: DataFrame, children: DataFrame, key: str, order: str, value: Column, out: str) -> DataFrame:
    """Parents with their children's values appended in order."""
    return parent.join(children.groupBy(key).agg(in_order(value, F.col(order)).alias(out)), key, "left")


def latest(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last state per key: an upsert as an aggregate, so a key of very many rows is combined before the shuffle."""
    rest = [c for c in df.columns if c != key and c not in order]
    return df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("_l")).select(key, *[F.col(f"_l.{c}").alias(c) for c in [*order, *rest]])


def grep(df: DataFrame, group: str, order: str, match: Column, after: int) -> DataFrame:
    """Matching rows and so many that follow them."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(-after, 0)
    return df.withColumn("_hit", F.max(match.cast("int")).over(w)).where("_hit = 1").drop("_hit")


def top_per_group(df: DataFrame, group: str, order: list[Column], k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= k)
