"""Prefix and suffix ranges against comparing every word with every query."""

import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from pagemill.operators import joins


def brute(words, asked, end, ignore_case, longer):
    fold = str.lower if ignore_case else str
    meets = lambda w, q: fold(w).endswith(fold(q)) if end == "end" else fold(w).startswith(fold(q))
    return sorted({(q, w) for q in asked if q for w in words if w is not None and meets(w, q) and (not longer or len(w) > len(q))})


@pytest.mark.parametrize("end", ["start", "end"])
@pytest.mark.parametrize("ignore_case, longer", [(False, True), (True, False)])
@pytest.mark.parametrize("range_words", [7, 100_000])
def test_against_all_pairs(spark, end, ignore_case, longer, range_words):
    r = random.Random(6)
    words = ["".join(r.choices("aaaabAB\U0001f600é", k=r.randint(0, 6))) for _ in range(300)] + [None, "apple", "apricot", "a", "", "\U0010ffff", "\U0010ffffz"]
    asked = ["a", "e", "t", "aa", "A", "", None, "\U0010ffff", "zzz", "apple", "\U0001f600", "a"]
    got = joins.recommend(spark.createDataFrame([(w,) for w in words], "w string").repartition(3), spark.createDataFrame([(q,) for q in asked], "q string"), "w", "q", end, ignore_case, longer, range_words)
    assert sorted((x.query, x.word) for x in got.collect()) == brute(words, asked, end, ignore_case, longer)


def test_no_words_and_no_queries(spark):
    some, none = spark.createDataFrame([("ab",)], "w string"), spark.createDataFrame([], "w string")
    assert joins.recommend(none, some, "w", "w").count() == joins.recommend(some, none, "w", "w").count() == 0


@given(st.text(max_size=4), st.text(max_size=4))
def test_beyond_is_above_all_of_a_prefix(prefix, rest):
    end = joins.beyond(prefix)
    assert end is None or prefix + rest < end
    if end is not None:
        assert not end.startswith(prefix)
