"""Quality rules with an isolation forest on their statistics.

Each text gives a vector of rule statistics. Random binary trees are grown over
vectors of labelled rows of good quality; a vector that they isolate after few splits is unlike
those rows. The score from which a document is rejected is calibrated on
labelled rows of both kinds.

Half of the labelled good rows grow the trees, the threshold is calibrated on the others and the bad ones. An id
with labels of both kinds is left out.

Defined results: a null text counts as empty; an empty text has no words and
fails the base rule; repeated rows are judged alike; a null doc_id is kept as it
is; other columns are ignored; an empty table gives no rows. Without usable
labels only the base rule decides.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.base import WORD, begin, map_arrow, slices, texts

SYMBOLS = re.compile(r"[#*$%&|<>]")
UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
MARK = re.compile(r"[!?]")
DIGIT = re.compile(r"[0-9]")
WINDOW = 5
STATS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, features array<double>"


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words that lie in a window of so many words found twice or more in the text; exact, without hashing."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    code, base = ids[: len(words)], len(number)
    if base**window < 2**62:
        code = ids[:n].copy()
        for k in range(1, window):
            code *= base
            code += ids[k : k + n]
    else:  # number the prefixes anew after each word, so that the codes stay small
        code = ids[:n]
        for k in range(1, window):
            code = np.unique(code * base + ids[k : k + n], return_inverse=True)[1].astype(np.int64)
    order = np.argsort(code, kind="stable")
    sorted_code = code[order]
    same = sorted_code[1:] == sorted_code[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += twice
    edge[window : window + n] -= twice
    return int((np.cumsum(edge)[:-1] > 0).sum())


def repeated_lines(text: str) -> int:
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in seen:
                again += 1
            else:
                seen.add(line)
    return again


def statistics(text: str) -> tuple[int, int, int, int, int, bool, list[float]]:
    """The contract's counts, the base verdict, and the features of the forest: shares of symbols, repeated words, capitals
    and marks, length of words, share of repeated lines, number of words, share of digits."""
    words = WORD.findall(text)
    n = len(words)
    chars = sum(map(len, words))
    symbols = len(SYMBOLS.findall(text))
    dup, repeat = repeated_lines(text), repeated_words(words)
    failed = n < 10 or 100 * repeat > 20 * n
    per_word = 1 / max(n, 1)
    lines = sum(1 for line in text.split("\n") if WORD.search(line)) if dup else 1
    features = [
        symbols * per_word, repeat * per_word, len(UPPER.findall(text)) / max(chars, 1), len(MARK.findall(text)) * per_word,
        math.log2(1 + chars * per_word), dup / lines, math.log2(1 + n), len(DIGIT.findall(text)) / max(chars, 1),
    ]
    return n, chars, symbols, dup, repeat, failed, features


def rule_statistics(docs: DataFrame) -> DataFrame:
    """One row of statistics for each document; a narrow pass over the texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in slices(batches):
            got = [statistics(t) for t in texts(b.column("text"))]
            cols = list(zip(*got)) if got else [[]] * 7
            yield {"doc_id": b.column("doc_id"), "n_words": cols[0], "word_chars": cols[1], "n_symbols": cols[2], "n_dup_lines": cols[3], "n_repeat_words": cols[4], "base_failed": cols[5], "features": cols[6]}

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), rows, STATS)


@dataclass
class Forest:
    """Trees as flat arrays; a node's feature is -1 at a leaf, whose depth then is its path length."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    depth: np.ndarray
    levels: int
    norm: float
    threshold: float = math.inf

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / expected path length): near 1 for vectors isolated at once."""
        rows, total = np.arange(len(x)), np.zeros(len(x))
        for feature, cut, left, depth in zip(self.feature, self.cut, self.left, self.depth):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.levels):
                f = feature[at]
                down = left[at] + (x[rows, np.maximum(f, 0)] >= cut[at])
                at = np.where(f >= 0, down, at)
            total += depth[at]
        return np.exp2(-total / len(self.feature) / self.norm)


def expected_path(n: float) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n keys."""
    return 0.0 if n <= 1 else 1.0 if n <= 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def grow(x: np.ndarray, spread: np.ndarray | None = None, n_trees: int = 100, sample: int = 256, seed: int = 7) -> Forest:
    """Trees over random samples of ``x``. A split is drawn from the range of the node's rows widened by
    ``spread`` on both sides, so that a vector beyond all of them parts from them after few splits, also
    in a feature that is constant among them."""
    rng = np.random.default_rng(seed)
    sample = min(sample, len(x))
    levels = max(1, math.ceil(math.log2(max(sample, 2)))) + 2
    spread = np.zeros(x.shape[1]) if spread is None else spread
    trees = []
    for _ in range(n_trees):
        feature, cut, left, depth = [-1], [0.0], [0], [0.0]
        todo = [(0, x[rng.choice(len(x), sample, replace=False)], 0)]
        while todo:
            node, rows, level = todo.pop()
            if level >= levels or len(rows) <= 1:
                depth[node] = level + expected_path(len(rows))
                continue
            low, high = rows.min(0) - spread, rows.max(0) + spread
            open_ = np.flatnonzero(high > low)
            if not len(open_):
                depth[node] = level + expected_path(len(rows))
                continue
            f = int(rng.choice(open_))
            at = rng.uniform(low[f], high[f])
            at = at if at > low[f] else high[f]
            feature[node], cut[node], left[node] = f, at, len(feature)
            right = rows[:, f] >= at
            for part in (rows[~right], rows[right]):
                todo.append((len(feature), part, level + 1))
                feature.append(-1), cut.append(0.0), left.append(0), depth.append(0.0)
        trees.append((feature, cut, left, depth))
    width = max(len(t[0]) for t in trees)
    pad = lambda k, fill, kind: np.array([t[k] + [fill] * (width - len(t[k])) for t in trees], kind)
    return Forest(pad(0, -1, np.int64), pad(1, 0.0, float), pad(2, 0, np.int64), pad(3, 0.0, float), levels, max(expected_path(sample), 1e-9))


def calibrate(scores: np.ndarray, good: np.ndarray, keep: float = 0.995) -> float:
    """Of the score cuts that keep this share of good rows, the one that rejects most bad rows, less ten times the share of good ones."""
    if not good.any() or good.all():
        return math.inf
    order = np.argsort(-scores, kind="stable")
    s, g = scores[order], good[order]
    lost, caught = np.cumsum(g) / g.sum(), np.cumsum(~g) / (~g).sum()
    last = np.append(s[1:] != s[:-1], True)
    ok = last & (lost <= 1 - keep)
    if not ok.any():
        return math.inf
    gain = np.where(ok, caught - 10 * lost, -1)  # a good row lost weighs as ten bad ones
    at = int(np.argmax(gain))
    if gain[at] <= 0:
        return math.inf
    return float(s[at] if at + 1 == len(s) else (s[at] + s[at + 1]) / 2)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, keep: float = 0.995) -> Forest | None:
    """A forest from at most ``max_rows`` labelled rows, those of least hash of the id: the bound of what comes to the driver."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most").drop("most")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    wanted = {r[0]: r[1] for r in chosen.collect()}
    if not wanted:
        return None
    spark = docs.sparkSession
    few = spark.createDataFrame(list(wanted.items()), "doc_id long, quality int")
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(few.select("doc_id")), "doc_id", "left_semi")
    got = rule_statistics(some).select("doc_id", "features", "base_failed").toPandas()
    if not len(got):
        return None
    # of texts that share an id the one with the least features
    got = got.assign(features=got["features"].map(tuple)).sort_values(["doc_id", "features"]).drop_duplicates("doc_id")
    x = np.array(got["features"].tolist(), float)
    good = np.array([wanted[int(d)] == 1 for d in got["doc_id"]])
    usual = good & ~got["base_failed"].to_numpy(bool)
    if usual.sum() < 8:
        return None
    # a range on both sides, so that a vector that lies apart in one feature only parts from the others early, too
    # every other good row grows the trees; the threshold comes from the rows that did not
    grown = usual & (np.cumsum(usual) % 2 == 0)
    forest = grow(x[grown], np.maximum(x.std(0), np.ptp(x[usual], axis=0)))
    held = ~got["base_failed"].to_numpy(bool) & ~grown
    forest.threshold = calibrate(forest.scores(x[held]), good[held], keep)
    return forest


def judge(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """Statistics and verdict of each document; the forest is a small constant of the tasks."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in slices(batches):
            got = [statistics(t) for t in texts(b.column("text"))]
            if not got:
                continue
            n, chars, symbols, dup, repeat, failed, features = zip(*got)
            score = forest.scores(np.array(features)) if forest else np.zeros(len(got))
            odd = score > forest.threshold if forest else np.zeros(len(got), bool)
            yield {"doc_id": b.column("doc_id"), "n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeat, "base_failed": failed, "kept": [not f and not o for f, o in zip(failed, odd.tolist())], "anomaly": score.tolist()}

    return map_arrow(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), rows,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, anomaly double",
    )


def filter_documents(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """The rows that pass, with all their columns: judged in place, so no join back is needed."""
    names = docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        for b in slices(batches):
            got = [statistics(t) for t in texts(b.column("text"))]
            if got:
                ok = ~np.array([g[5] for g in got])
                if forest:
                    ok &= forest.scores(np.array([g[6] for g in got])) <= forest.threshold
                yield b.filter(pa.array(ok)).select(names)

    from pagemill import ship

    ship.ensure(docs.sparkSession)
    return docs.mapInArrow(keep, docs.schema)
