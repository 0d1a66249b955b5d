"""Weak supervision: the label model against known voters, and held-out accuracy on tables and planted texts."""

import random
import zlib

import numpy as np
import pytest

from pagemill.llm import weak

DOCS = "doc_id long, text string, lang string, source string, votes string, label int, terms long"


def held(d):
    return zlib.crc32(b"" if d is None else str(d).encode()) % 4 == 2


def planted(n=1500, seed=2):
    """Texts of invented words; toxic ones hold some of thirty invented insults that share a beginning."""
    r = random.Random(seed)
    part = ["lo", "mi", "ra", "te", "su", "vok", "an", "der", "il", "po"]
    clean = ["".join(r.choices(part, k=r.randint(2, 4))) for _ in range(400)]
    bad = ["grux" + "".join(r.choices(part, k=2)) for _ in range(30)]
    rows, labels = [], []
    for i in range(n):
        toxic = r.random() < 0.12
        words = r.choices(clean, k=r.randint(20, 120))
        if toxic:
            for w in r.choices(bad, k=r.randint(2, 8)):
                words.insert(r.randrange(len(words)), w)
        rows.append((i, " ".join(words).capitalize() + ".", "xx", "s", "v", 1, 2))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def made(spark):
    rows, labels = planted()
    return spark.createDataFrame(rows, DOCS).repartition(3).cache(), spark.createDataFrame([(d, 1, t) for d, t in labels if d % 2 == 0], "doc_id long, quality int, toxic int").cache(), dict(labels)


def test_planted_texts_are_found(made):
    docs, labels, truth = made
    got = weak.score_documents(docs, labels).collect()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    unseen = [r for r in got if r.held_out or r.doc_id % 2]
    hit = sum(r.predicted for r in unseen if truth[r.doc_id])
    assert hit >= 0.97 * sum(truth[r.doc_id] for r in unseen)
    assert sum(r.predicted for r in unseen if not truth[r.doc_id]) <= 3


def test_only_permitted_labels_are_used(spark, made):
    """Labels of held-out rows, and languages, sources and extra columns, change nothing."""
    docs, labels, _ = made
    one = {r.doc_id: r.score for r in weak.score_documents(docs, labels).collect()}
    from pyspark.sql import functions as F

    wrong = labels.withColumn("toxic", F.when(weak.crc_mod(n=4) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = docs.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.col("doc_id").cast("string"))
    assert one == pytest.approx({r.doc_id: r.score for r in weak.score_documents(other, wrong).collect()}, abs=1e-9)


def test_held_out_accuracy_on_the_table(spark):
    folder = "/root/testdata/sf0.1"
    got = weak.score_documents(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")).where("held_out").toPandas()
    m = got.merge(spark.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id")
    right = int(((m.predicted == 1) & (m.toxic == 1)).sum())
    assert right >= 0.85 * (m.toxic == 1).sum() and right >= 0.93 * (m.predicted == 1).sum()


def test_odd_rows(spark):
    texts = [(1, None), (1, None), (2, ""), (3, "   \n"), (4, "You are an idiot and a pathetic loser, shut up"), (None, "you are an idiot, moron"), (5, "a calm text about trees"), (6, "tree " * 100_000), (7, "you 1d1ot"), (7, "you 1d1ot")]
    docs = spark.createDataFrame([(d, t, None, None, None, None, None) for d, t in texts], DOCS)
    labels = spark.createDataFrame([(5, 1), (5, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    got = sorted((str(r.doc_id), r.predicted, round(r.score, 9)) for r in weak.score_documents(docs, labels).collect())
    assert len(got) == len(texts)
    by = {d: p for d, p, _ in got}
    assert by["4"] == by["None"] == 1 and by["5"] == by["6"] == by["1"] == by["2"] == by["3"] == 0
    assert len({x for x in got if x[0] in ("1", "7")}) == 2


def test_empty(spark):
    assert weak.score_documents(spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, toxic int")).count() == 0


def test_the_label_model_finds_accuracies_and_who_follows_whom():
    """Voters with known rates, one of which mostly repeats another: rates, dependence and posterior come out of unlabelled votes and few labels."""
    r = np.random.default_rng(5)
    n, k = 40_000, 6
    y = r.random(n) < 0.2
    rate1, rate0 = np.array([0.7, 0.6, 0.5, 0.6, 0.4, 0.5]), np.array([0.05, 0.02, 0.1, 0.02, 0.01, 0.05])
    votes = (r.random((n, k)) < np.where(y[:, None], rate1, rate0)).astype(int)
    copy = r.random(n) < 0.9
    votes[:, 5] = np.where(copy, votes[:, 2], votes[:, 5])
    label = np.where(np.arange(n) < 300, y, -1)
    code, at = np.unique(votes @ (1 << np.arange(k)) * 4 + label + 1, return_inverse=True)
    distinct, times = (code // 4)[:, None] >> np.arange(k) & 1, np.bincount(at)
    model = weak.LabelModel(k)
    model.fit(distinct, code % 4 - 1, times.astype(float), np.where(distinct.sum(1) > 1, 0.9, 0.1))
    assert abs(model.share - 0.2) < 0.03
    assert model.parent[5] == 2 or model.parent[2] == 5  # the tree joins the two that go together
    free = [j for j in range(k) if j not in (2, 5)]
    for j in free:
        got1 = sum(model.table[j, a, 1] * p for a, p in enumerate([0.5, 0.5])) if model.parent[j] < 0 else np.average(model.table[j, :, 1], weights=[(votes[y, model.parent[j]] == a).mean() for a in (0, 1)])
        assert abs(got1 - rate1[j]) < 0.06
    q = model.posterior(votes)
    assert ((q > 0.5) == y).mean() > 0.93
    # two voters that say the same are not counted twice
    both, one = np.array([[0, 0, 1, 0, 0, 1]]), np.array([[0, 0, 1, 0, 0, 0]])
    assert abs(model.odds(both)[0] - model.odds(one)[0]) < 1.2


def test_the_classifier_learns_soft_labels():
    r = np.random.default_rng(1)
    rows = [np.flatnonzero(r.random(20) < 0.2).astype("<u4") for _ in range(3000)]
    target = np.array([1 / (1 + np.exp(-(2.0 * (3 in x) - 1.5 * (7 in x) - 1))) for x in rows])
    c = weak.train([x.tobytes() for x in rows], target, np.ones(len(rows)), 20)
    assert abs(c.weight[3] - 2) < 0.2 and abs(c.weight[7] + 1.5) < 0.2 and np.abs(np.delete(c.weight, [3, 7])).max() < 0.1


def test_patterns():
    seen = lambda t: {n for n in weak.VOTERS if weak.pattern_votes(t, len(t.split())) & weak.V[n]}
    assert seen("such an 1d1ot") == seen("st*pid that") == seen("a l0ser he") == seen("m*r*n") == {"masked"}
    assert seen("room 1d1 is 3 metres") == seen("call 0123") == seen("a*b*c") == seen("***") == set()
    assert seen("you are an x") == {"aimed"} and seen("shut up now") == {"threat"} and seen("ALL OF IT") == {"shouting"} and seen("no!! yes??") == {"marks"}


def test_signal():
    assert weak.signal(1, 10, 0.1) == 0 and weak.signal(0, 0, 0.1) == 0
    assert weak.signal(6, 6, 0.1) == pytest.approx(12 * np.log(10)) and weak.signal(5, 6, 0.1) < weak.signal(6, 6, 0.1)
    assert weak.terms_of("Ab abcd ABCE x") == {"ab", "abcd", "abce", "x", "abc-", "abc-2"}
