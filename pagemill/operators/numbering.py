"""Numbers for the rows of a whole sorted table, without one task for all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill import shared

_WITHIN = (1 << 33) - 1  # an id made by Spark is the partition's number, then 33 bits of the row's


def numbered(df: DataFrame, order: list[Column], name: str, start: int = 1, parts: int | None = None) -> DataFrame:
    """The rows with ``name``: their place in the order, from ``start``; rows that are equal in it stand in any order.

    The rows are dealt out by ranges of the order and sorted within each, where Spark numbers them on its own; what the ranges before have together is added. Many rows
    that are equal in the whole order lie in one range, so the order should tell rows apart."""
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = shared.written(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    within, part = F.col("_at").bitwiseAND(_WITHIN), F.shiftright("_at", 33)
    sizes = sorted((r["part"], r["n"]) for r in own.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())  # a row for each range
    before, total = [], start
    for k, size in sizes:
        before.append((k, total))
        total += size
    spark = df.sparkSession
    offsets = spark.createDataFrame(before, "_part long, _before long")
    return own.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn(name, (within + F.col("_before")).cast("long")).drop("_part", "_before", "_at")
