"""Score maps: counts of elements with an order by count, then by arrival."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.operators.numbering import numbered


def scores(df: DataFrame, element: str, position: str, inc: Column | None = None, by: list[str] | None = None) -> DataFrame:
    """element, score, arrival (least position) within each group."""
    return df.groupBy(*(by or []), element).agg((F.sum(inc) if inc is not None else F.count(F.lit(1))).cast("long").alias("score"), F.min(position).alias("arrival"))


def ranked(sm: DataFrame, by: list[str] | None = None, up: bool = False) -> DataFrame:
    """Rank by score, then arrival, both in one direction. Without groups the whole map is numbered, by ranges."""
    d = (lambda c: F.col(c).asc()) if up else (lambda c: F.col(c).desc())
    if not by:
        return numbered(sm, [d("score"), d("arrival")], "rank")
    return sm.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(d("score"), d("arrival"))))


def ordered_texts(pairs: Column) -> Column:
    """Of an array of (text, n, first): by n, then arrival, both from the top."""
    return F.array_sort(pairs, lambda a, b: F.when(a["n"] != b["n"], b["n"] - a["n"]).otherwise(b["first"] - a["first"]))


def merged(maps: list[DataFrame], element: str) -> DataFrame:
    """Sums of the positive scores of several maps."""
    out = maps[0]
    for m in maps[1:]:
        out = out.unionByName(m)
    return out.where("score > 0").groupBy(element).agg(F.sum("score").cast("long").alias("score"))


def lower_half(sm: DataFrame) -> DataFrame:
    """Elements below the whole mean of the scores. The mean is one row, joined to all."""
    mean = sm.agg(F.floor(F.avg("score")).alias("_mean"))
    return sm.join(F.broadcast(mean), F.col("score") < F.col("_mean")).drop("_mean")


def shrink_to_score(sm: DataFrame, least: int) -> DataFrame:
    return sm.where(F.col("score") >= least)


def shrink_to_size(sm: DataFrame, size: int) -> DataFrame:
    """Whole score classes from the top while they fit. Classes are far fewer than elements, so they are numbered in one task."""
    classes = sm.groupBy("score").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    fits = classes.withColumn("_all", F.sum("_n").over(w)).where(F.col("_all") <= size).agg(F.min("score").alias("_least"))
    return sm.join(F.broadcast(fits), F.col("score") >= F.col("_least")).drop("_least")


def common_words(docs: DataFrame, text: str, least_length: int, size: int) -> DataFrame:
    """The most frequent words of some length, exactly counted; ties go to the lesser word."""
    words = docs.select(F.explode(F.split(F.lower(F.col(text)), r"[^\p{L}]+")).alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("score")).orderBy(F.col("score").desc(), "word").limit(size)


def shrunk(counts: dict[str, int], capacity: int) -> int:
    """Leaves at most so many counters by taking the same from all; says how much. What is no longer there had no more than that."""
    if len(counts) <= capacity:
        return 0
    cut = sorted(counts.values(), reverse=True)[capacity]
    for w in [w for w, n in counts.items() if n <= cut]:
        del counts[w]
    for w in counts:
        counts[w] -= cut
    return cut


def long_enough(words: pa.Array, least: int) -> pa.Array:
    return words.filter(pc.greater_equal(pc.utf8_length(words), least))


def counters(words: DataFrame, column: str, capacity: int, least_length: int = 1) -> DataFrame:
    """(word, n) of at most ``capacity`` words of each task, and (null, n) with what its counts may lack. ``column`` is an array of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        lost = 0
        for b in batches:
            for at in range(0, b.num_rows, 500):
                got = long_enough(b.column(0).slice(at, min(500, b.num_rows - at)).flatten(), least_length).value_counts()
                for w, n in zip(got.field("values").to_pylist(), got.field("counts").to_pylist()):
                    counts[w] = counts.get(w, 0) + n
                if len(counts) > 2 * capacity:
                    lost += shrunk(counts, capacity)
        lost += shrunk(counts, capacity)
        yield pa.RecordBatch.from_arrays([pa.array([*counts, None], pa.string()), pa.array([*counts.values(), lost], pa.int64())], names=["word", "n"])

    return words.select(column).mapInArrow(run, "word string, n long")


def exact_counts(words: DataFrame, column: str, wanted: list[str]) -> DataFrame:
    """(word, n): how often each of the wanted words occurs; a row for each of them and task is shuffled."""
    known = pa.array(wanted, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known), np.int64)
        for b in batches:
            at = pc.index_in(b.column(0).flatten(), value_set=known).drop_null().to_numpy()
            total += np.bincount(at, minlength=len(known))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([known.take(pa.array(some)), pa.array(total[some])], names=["word", "n"])

    return words.select(column).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("score"))


def frequent_words(docs: DataFrame, text: str, least_length: int, size: int, capacity: int = 50_000) -> DataFrame:
    """The same as ``common_words``, (word, score), without a shuffle of all words.

    Each task keeps a bounded number of counters; where there are too many it takes the same from all and drops those that come to
    nothing (Misra and Gries), so a count lacks no more than it took. The counters' sums give the words that may be among the most frequent, which are then counted exactly. If a word
    that was not counted could still belong to them, there are four times as many counters in the next round; the counts are always those of all words."""
    words = docs.where(F.col(text).isNotNull()).select(F.split(F.lower(F.col(text)), r"[^\p{L}]+").alias("w"))
    while True:
        told = counters(words, "w", capacity, max(1, least_length)).groupBy("word").agg(F.sum("n").alias("n"))
        top = told.orderBy(F.col("word").isNotNull(), F.col("n").desc(), "word").limit(4 * size + 1).collect()
        lost = next((r["n"] for r in top if r["word"] is None), 0)
        seen = [r for r in top if r["word"] is not None]
        best = exact_counts(words, "w", [r["word"] for r in seen]).orderBy(F.col("score").desc(), "word").limit(size)
        if len(seen) < 4 * size and not lost:
            return best  # every word was counted
        found = best.collect()
        # what was not counted exactly has at most this: no counter, or a lesser one than all that were taken
        most = (seen[-1]["n"] if len(seen) == 4 * size else 0) + lost
        if len(found) == size and found[-1]["score"] > most:
            return docs.sparkSession.createDataFrame([tuple(r) for r in found], best.schema)
        capacity *= 4
        if capacity > 20_000_000:
            return common_words(docs, text, least_length, size)
