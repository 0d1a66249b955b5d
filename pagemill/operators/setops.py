"""Unions, rotations and other operations on sorted tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.arrow import map_rows
from pagemill.operators.numbering import numbered


def merge_first_wins(tables: list[DataFrame], key: str, value: str) -> DataFrame:
    """Union by key; of equal keys the value of the earliest table (within a table the least value)."""
    ranked = reduce(DataFrame.unionByName, [t.select(key, value, F.lit(i).alias("_source")) for i, t in enumerate(tables)])
    return ranked.groupBy(key).agg(F.min_by(F.col(value), F.struct("_source", F.col(value))).alias(value))


def merge_equal(tables: list[DataFrame], key: str, value: str, merge: Callable, held: int = 100_000) -> DataFrame:
    """Union by key; of equal keys the values are merged by a function of two values, that of the earlier table first. It has to be associative, and for values of one table commutative.
    A null value is no value.

    A task merges what it has of a key before the rows are shuffled, so a key of very many rows arrives as one row from each
    task; it holds at most so many keys at once."""
    both = reduce(DataFrame.unionByName, [t.select(key, value, F.lit(i).alias("_source")) for i, t in enumerate(tables)])
    kind = both.schema

    def combine(it):
        known: dict = {}
        for r in it:
            if r[value] is None:
                continue
            k = (r["_source"], r[key])
            known[k] = merge(known[k], r[value]) if k in known else r[value]
            if len(known) >= held:
                yield from ({key: a, value: v, "_source": s} for (s, a), v in known.items())
                known.clear()
        yield from ({key: a, value: v, "_source": s} for (s, a), v in known.items())

    def together(it):
        now, last = None, object()
        for r in it:
            if now is not None and r[key] == last:
                now[value] = merge(now[value], r[value])
            else:
                if now is not None:
                    yield now
                now, last = dict(r), r[key]
        if now is not None:
            yield now

    early = map_rows(both, combine, kind, size=5000)
    return map_rows(early.repartition(key).sortWithinPartitions(key, "_source"), together, kind, size=5000).select(key, value)


def stack(tables: list[DataFrame]) -> DataFrame:
    """All rows of all tables; None counts as an empty one."""
    return reduce(DataFrame.unionByName, [t for t in tables if t is not None])


def adjacent_unique(df: DataFrame, order: list[str], key: str) -> DataFrame:
    """Of rows that are equal in ``key`` the last in the order."""
    last = df.groupBy(key).agg(F.max(F.struct(*order)).alias("_last"))
    return last.select(key, *[F.col(f"_last.{c}").alias(c) for c in order if c != key])


def rotate(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows of an endless repetition of the sorted table, numbered from 0 in ``position``."""
    size = df.count()
    if not size:
        return df.withColumn("position", F.lit(0).cast("long"))
    some = numbered(df, order, "_n", start=0).where(F.col("_n") < n)
    rounds = F.expr(f"sequence(0L, ({n}L - 1 - _n) div {size}L)")
    return some.withColumn("_round", F.explode(rounds)).withColumn("position", F.col("_round") * size + F.col("_n")).drop("_n", "_round")


def from_key(df: DataFrame, key: str, start, up: bool = True) -> DataFrame:
    """Rows from a start key on, upwards or downwards."""
    c = F.col(key)
    return df.where(c >= F.lit(start)).orderBy(c.asc()) if up else df.where(c <= F.lit(start)).orderBy(c.desc())
