"""Features of rolling time windows, their order statistics by offline parallel binary search.

Rows become weighted events (key, time, value, kind, how many). A key's time is cut into tiles as
long as the longest window; an event goes to its own tile and to those whose windows reach back to
it, so a task has one tile of one key and the stretch before it. In a tile all windows bisect the
sorted values together. A round needs, for each window, how many of its events have a value below
the window's middle; for that the events are replayed in the order of their values into a Fenwick
tree over the positions in time. A replay up to a middle leaves in a node the number of its events
of lesser value, so a node keeps its events in that order and the counts so far, and all replays of
a round are read off at once.

A key of very many rows is spread by its tiles, and rows of one time, value and kind are one event before they
are shuffled: a tile holds at most (times in two longest windows) x (pairs of value and kind) of
them, however many rows there are. All windows that end at one time are one window. The features
return to the rows by a join on key and time. Nothing is broadcast or goes to the driver.

Defined results: a null key is a key; a null time has no window (counts and sums 0, no order
statistics) and belongs to none; a null value counts as an event but has no length; a null kind
is no kind; rows that are equal count each; a window without values has null order statistics;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill import ship
from pagemill.llm.base import written

#: Order statistics as (name, n, d): of m values, ascending, number ceil(n * m / d).
QUANTILES = (("median", 1, 2), ("high", 90, 100))


class Replay:
    """A Fenwick tree over positions that has seen events in the order of their ranks, and knows its nodes' counts at every moment."""

    def __init__(self, position: np.ndarray, rank: np.ndarray, weight: np.ndarray, positions: int, ranks: int):
        order = np.argsort(rank, kind="stable")
        position, rank, weight = position[order], rank[order], weight[order]
        self.wide = ranks + 1
        self.levels = []
        for level in range(max(1, int(positions).bit_length())):
            at = position >> level
            mine = np.flatnonzero((at & 1) == 0)  # the others are in nodes of higher levels
            mine = mine[np.argsort(at[mine], kind="stable")]
            node = at[mine] >> 1
            moment = node * self.wide + rank[mine]
            seen = np.concatenate([[0], np.cumsum(weight[mine])])
            first = np.searchsorted(moment, np.arange((positions >> level) // 2 + 2) * self.wide)
            self.levels.append((moment, seen, first))

    def below(self, end: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The weight of events at positions before ``end`` with a lesser rank, for all pairs."""
        out = np.zeros(len(end), np.int64)
        for level, (moment, seen, first) in enumerate(self.levels):
            on = np.flatnonzero((end >> level) & 1)
            if len(on):
                node = ((end[on] >> level) - 1) >> 1
                out[on] += seen[np.searchsorted(moment, node * self.wide + rank[on])] - seen[first[node]]
        return out


def order_statistics(tree: Replay, begin: np.ndarray, end: np.ndarray, wanted: np.ndarray, ranks: int) -> np.ndarray:
    """For each window of positions the rank of its ``wanted``-th event (from 1); all bisect together."""
    low, high = np.zeros(len(begin), np.int64), np.full(len(begin), max(ranks - 1, 0), np.int64)
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_]) >> 1
        n = tree.below(end[open_], middle + 1) - tree.below(begin[open_], middle + 1)
        enough = n >= wanted[open_]
        high[open_[enough]] = middle[enough]
        low[open_[~enough]] = middle[~enough] + 1
    return low


def tile_features(events: pd.DataFrame, own_from: int, own_to: int, windows: list[int], quantiles=QUANTILES) -> pd.DataFrame:
    """The features of all windows that end at a time of [own_from, own_to) with an event. Events: time, value, kind, n."""
    time, n = events["time"].to_numpy(np.int64), events["n"].to_numpy(np.int64)
    has = events["value"].notna().to_numpy(bool)
    value = events["value"].where(has, 0).to_numpy(np.int64)
    times, position = np.unique(time, return_inverse=True)
    size = len(times)
    order = np.argsort(position, kind="stable")
    upto = np.concatenate([[0], np.cumsum(np.bincount(position, minlength=size))])  # events before each position
    sums = lambda x: np.concatenate([[0], np.cumsum(x[order])])[upto]
    count, total, valued = sums(n), sums(value * n * has), sums(n * has)
    values, rank = np.unique(value[has], return_inverse=True)
    tree = Replay(position[has], rank, n[has], size, len(values))

    # of each kind, a position and the one before it: a window has a kind where the one before lies outside
    kinds = events["kind"]
    known = kinds.notna().to_numpy(bool)
    pairs = np.unique(np.stack([pd.factorize(kinds[known])[0].astype(np.int64), position[known]], 1), axis=0) if known.any() else np.zeros((0, 2), np.int64)
    before = np.zeros(len(pairs), np.int64)
    if len(pairs):
        same = pairs[1:, 0] == pairs[:-1, 0]
        before[1:][same] = pairs[:-1, 1][same] + 1
    first_seen = Replay(pairs[:, 1], before, np.ones(len(pairs), np.int64), size, size + 1)

    asked = times[(times >= own_from) & (times < own_to)]
    out = []
    for w in windows:
        begin, end = np.searchsorted(times, asked - w), np.searchsorted(times, asked)
        of = lambda before: before[end] - before[begin]
        m = of(valued)
        part = {"time": asked, "window": np.full(len(asked), w), "n_events": of(count), "sum": of(total), "n_kinds": first_seen.below(end, begin + 1) - first_seen.below(begin, begin + 1)}
        some = np.flatnonzero(m > 0)
        b = np.concatenate([begin[some]] * len(quantiles))
        e = np.concatenate([end[some]] * len(quantiles))
        k = np.concatenate([-(-(m[some] * a) // d) for _, a, d in quantiles])
        found = np.split(order_statistics(tree, b, e, k, len(values)), len(quantiles)) if len(some) else [np.zeros(0, np.int64)] * len(quantiles)
        for (name, _, _), r in zip(quantiles, found):
            column = pd.array(np.zeros(len(asked), np.int64), "Int64")
            column[:] = pd.NA
            if len(some):
                column[some] = values[r]
            part[name] = column
        out.append(pd.DataFrame(part))
    return pd.concat(out)


def rolling(rows: DataFrame, windows: list[int], quantiles=QUANTILES, tile: int | None = None) -> DataFrame:
    """For rows of key (string), time, value (long) and kind (string): for each (key, time) and window w the features of the key's rows with
    time - w <= their time < time: key, time, window, n_events, sum, n_kinds and a column for each of ``quantiles``."""
    ship.ensure(rows.sparkSession)
    longest = max(windows)
    step = tile or longest
    events = rows.where("time is not null").groupBy("key", "time", "value", "kind").agg(F.count(F.lit(1)).alias("n"))
    down = lambda c: F.expr(f"({c} - pmod({c}, {step}L)) div {step}L")
    dealt = events.withColumn("tile", F.explode(F.sequence(down("time"), down(f"(time + {longest}L)"))))
    names = [q[0] for q in quantiles]

    def features(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        at = int(key[1]) * step
        out = tile_features(pdf, at, at + step, windows, quantiles)
        out.insert(0, "key", key[0] if isinstance(key[0], str) else None)
        return out

    return dealt.groupBy("key", "tile").applyInPandas(features, f"key string, time long, window long, n_events long, sum long, n_kinds long, {', '.join(f'{q} long' for q in names)}")


def event_time(doc_id: str = "doc_id"):
    """60 * floor((doc_id + crc32(doc_id) mod 10000) / 6), in whole numbers."""
    x = F.col(doc_id) + F.crc32(F.col(doc_id).cast("string").cast("binary")) % 10000
    return (x - F.pmod(x, F.lit(6))) * 10


def document_windows(docs: DataFrame, windows: tuple[int, ...] = (600, 43200), tile: int | None = None) -> DataFrame:
    """Rolling features of the lengths and languages of a source's documents, a row for each document and window."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("key"), F.length(F.col("text").cast("string")).cast("long").alias("value"), F.col("lang").cast("string").alias("kind")).withColumn("time", event_time())
    narrow = written(narrow, "lengths")  # the texts are read once
    found = rolling(narrow, list(windows), tile=tile)
    per_time = found.groupBy("key", "time").agg(F.collect_list(F.struct("window", "n_events", "sum", "n_kinds", "median", "high")).alias("w"))  # as many as there are windows
    met = narrow.select("doc_id", "key", "time").join(per_time.withColumnsRenamed({"key": "k", "time": "t"}), F.col("key").eqNullSafe(F.col("k")) & (F.col("time") == F.col("t")), "left")
    none = F.array(*[F.struct(F.lit(w).cast("long").alias("window"), *[F.lit(0).cast("long").alias(c) for c in ("n_events", "sum", "n_kinds")], *[F.lit(None).cast("long").alias(c) for c in ("median", "high")]) for w in windows])
    out = met.select("doc_id", "time", F.explode(F.coalesce("w", none)).alias("x"))
    return out.select("doc_id", F.col("x.window").alias("window_s"), F.col("time").alias("event_s"), F.col("x.n_events").alias("n_events"), F.col("x.sum").alias("sum_chars"), F.col("x.n_kinds").alias("n_langs"), F.col("x.median").alias("median_chars"), F.col("x.high").alias("high_chars"))
