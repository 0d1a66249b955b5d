"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.base import written


def _large(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _print(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node, root (the least node of its component), for all nodes with an edge. Edges: a, b (long).

    Each round is written to the shared folder; rounds end when the edges are stars around
    their least nodes, after about the logarithm of the longest path. A node of very many
    neighbours only meets partial aggregates and joins that Spark may split.
    """
    now = written(edges.where("a <> b").distinct(), name)
    before = _print(now)
    while before[0]:
        now = written(_small(written(_large(now), name)), name)
        after = _print(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
