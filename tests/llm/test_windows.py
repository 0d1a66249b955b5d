"""Rolling windows against sorting each of them."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.llm import windows
from pagemill.llm.queries import oracle_sql, queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long, time long, key string, value long, w string"


def rows():
    r = random.Random(4)
    out = [(i, "é" * r.choice([0, 1, 1, 2, 5, 5, 300]), r.choice(["en", "de", None]), r.choice(["a", "a", "a", "b", None, ""]), 3, 1, "k", 2, "w") for i in range(400)]
    out += [(7, None, "xx", "a", None, None, None, None, None), (7, None, "xx", "a", None, None, None, None, None), (None, "no id", "en", "a", 1, 1, "a", 1, "")]
    return out + [(-9, "below zero", "fr", "a", 0, 0, "", 0, ""), (50_000, "alone", None, "far", 0, 0, "", 0, "")]


def brute(rows, sizes=(600, 43200)):
    out = []
    at = [None if d is None else 60 * ((d + zlib.crc32(str(d).encode()) % 10000) // 6) for d, *_ in rows]
    for (d, _, _, source, *_), now in zip(rows, at):
        for w in sizes:
            inside = [] if now is None else [r for r, t in zip(rows, at) if t is not None and now - w <= t < now and r[3] == source]
            n = sorted(len(r[1]) for r in inside if r[1] is not None)
            m = len(n)
            out.append((d, w, now, len(inside), sum(n), len({r[2] for r in inside} - {None}), n[-(-m // 2) - 1] if m else None, n[-(-90 * m // 100) - 1] if m else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("tile", [None, 600, 7000, 10**7])
def test_windows(spark, tile):
    docs = spark.createDataFrame(rows(), DOCS).repartition(3)
    got = windows.document_windows(docs, tile=tile).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows())


def test_empty(spark):
    assert windows.document_windows(spark.createDataFrame([], DOCS)).count() == 0


def test_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    res = con.execute(oracle_sql()["op13_window_bisection"])
    names = [c[0] for c in res.description]
    got = queries()["op13_window_bisection"](spark, sf_dir).select(names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(res.fetchall(), key=repr)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 6), st.integers(1, 4)), min_size=1, max_size=40), st.integers(0, 21), st.integers(0, 21))
def test_a_replay_counts_what_a_scan_counts(events, a, b):
    p, r, w = (np.array(x) for x in zip(*events))
    tree = windows.Replay(p, r, w, 21, 7)
    begin, end = np.array([min(a, b)]), np.array([max(a, b)])
    inside = (p >= begin[0]) & (p < end[0])
    for rank in range(8):
        assert tree.below(end, np.array([rank]))[0] - tree.below(begin, np.array([rank]))[0] == w[inside & (r < rank)].sum()
    flat = np.sort(np.repeat(r[inside], w[inside]))
    for k in range(1, len(flat) + 1):
        assert windows.order_statistics(tree, begin, end, np.array([k]), 7)[0] == flat[k - 1]


def test_rows_of_one_time_are_one_event(spark):
    """A hot key and time meets as few events as it has different ones; no query is repeated."""
    many = spark.range(20_000).selectExpr("'hot' as key", "600 * (id % 3) as time", "id % 5 as value", "'k' as kind")
    got = {(r.time, r.window): r for r in windows.rolling(many, [600, 1200]).collect()}
    assert len(got) == 6 and got[1200, 1200].n_events == sum(1 for i in range(20_000) if i % 3 < 2)
    assert got[1200, 1200].median == 2 and got[1200, 1200].high == 4 and got[0, 600].median is None
