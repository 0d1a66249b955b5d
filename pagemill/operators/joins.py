"""Joins and differences of keyed tables. Spark picks the strategy; nothing is broadcast by hand."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill import shared
from pagemill.arrow import map_rows
from pagemill.operators import literals


def map_join(left: DataFrame, right: DataFrame, key: str, value: str, concat: bool = False, merge: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Common keys with the left value, with both values one after the other, or with what ``merge`` makes of the two."""
    r = right.select(key, F.col(value).alias("_other"))
    v = merge(F.col(value), F.col("_other")) if merge else F.concat(F.col(value), F.col("_other")) if concat else F.col(value)
    return left.select(key, value).join(r, key).select(key, v.alias(value))


def nway_join(tables: list[DataFrame], key: str, value: str, concat: bool = False) -> DataFrame:
    """Keys common to all tables. No tables, or an empty one among them, give an empty result."""
    return reduce(lambda a, b: map_join(a, b, key, value, concat), tables)


def intersection(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).join(right.select(key), key, "left_semi").distinct()


def difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of the left table whose key the right one lacks. A null key has no partner, so it stays."""
    return left.join(right.select(key), key, "left_anti")


def included(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: whether all keys of the left table are in the right one."""
    return difference(left.select(key).distinct(), right, key).agg((F.count(F.lit(1)) == 0).alias("included"))


def matching_rules(subject: Column, rules: list[tuple[str, str]]) -> Column:
    """Names of the rules whose pattern matches the whole subject, in the order of the rules."""
    return F.filter(F.array(*[F.when(subject.rlike(f"^(?:{p})$"), F.lit(n)) for n, p in rules]), lambda x: x.isNotNull())


def matching_rule_rows(df: DataFrame, subject: str, rules: DataFrame) -> DataFrame:
    """The same for rules in a table (name, pattern) of any size: one row per match."""
    return literals.matches(df, subject, rules)


#: Words of a range; ranges are as many at most, since their first words are known to the driver.
RANGE_WORDS, MOST_RANGES = 100_000, 20_000


def beyond(prefix: str) -> str | None:
    """The least text above all that begin with a prefix; None if there is none."""
    for i in range(len(prefix) - 1, -1, -1):
        c = ord(prefix[i])
        if c < 0x10FFFF:
            return prefix[:i] + chr(0xE000 if c == 0xD7FF else c + 1)
    return None


def recommend(words: DataFrame, asked: DataFrame, word: str, query: str, at: str = "start", ignore_case: bool = False, longer: bool = True, range_words: int = RANGE_WORDS) -> DataFrame:
    """(query, word): words that start, or end, with a query; strictly longer ones, unless equal ones are wanted too. An empty query finds nothing.

    The distinct words are sorted into ranges of about ``range_words``. A query goes to the ranges that its words can lie in, and is a stretch of each
    range's sorted words there; so a query of one character costs no more than its result, and many words with one first letter are many ranges."""
    fold = F.lower if ignore_case else (lambda c: c)
    key = (lambda c: F.reverse(fold(c))) if at == "end" else fold
    w = words.select(F.col(word).cast("string").alias("word")).where("word is not null").distinct().withColumn("k", key(F.col("word")))
    q = asked.select(F.col(query).cast("string").alias("query")).where("query <> ''").distinct().withColumn("p", key(F.col("query")))
    n = w.count()
    ranges = max(1, min(-(-n // range_words), MOST_RANGES))
    w = shared.written(w.repartitionByRange(ranges, "k").withColumn("r", F.spark_partition_id()), "words")
    edges = sorted((r["least"], r["most"], r["r"]) for r in w.groupBy("r").agg(F.min("k").alias("least"), F.max("k").alias("most")).collect())
    least, most, number = ([e[i] for e in edges] for i in range(3))

    def rows(it):
        for r in it:
            end = beyond(r["p"])
            for i in range(bisect_left(most, r["p"]), len(least) if end is None else bisect_left(least, end)):
                yield r | {"r": number[i]}

    sent = map_rows(q, rows, "query string, p string, r int", size=5000)

    def meet(_, ws: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        order = sorted(zip(ws["k"], ws["word"]))
        keys = [k for k, _ in order]
        first = [bisect_left(keys, p) for p in qs["p"]]
        last = [len(keys) if (e := beyond(p)) is None else bisect_left(keys, e) for p in qs["p"]]
        found = [order[i][1] for a, b in zip(first, last) for i in range(a, b)]
        return pd.DataFrame({"query": qs["query"].repeat([b - a for a, b in zip(first, last)]).to_numpy(), "word": np.array(found, object)})

    out = w.groupBy("r").cogroup(sent.groupBy("r")).applyInPandas(lambda key, ws, qs: meet(key, ws, qs), "query string, word string")
    return out.where(F.length("word") > F.length("query")) if longer else out
