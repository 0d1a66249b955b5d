"""The pipeline against a plain version of its stages."""

import zlib

import numpy as np

import corpus_pipeline as cp
from pagemill.llm import pii, quality, tokens
from pagemill.llm.queries import oracle_sql, queries, tokenizer_file


def test_stages_have_their_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = [docs]
    for _, f in cp.STAGES[:-1]:
        steps.append(f(spark, steps[-1], sf_dir).cache())
        assert steps[-1].columns == docs.columns
    first = {r.doc_id for r in quality.judge(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))).where("kept").collect()}
    assert {r.doc_id for r in steps[1].collect()} == first
    second = {r.doc_id for r in steps[2].collect()}
    assert second < first
    for r in steps[3].collect():
        assert not pii.base_spans(r.text)
    packed = cp.run(spark, sf_dir).collect()
    encode = tokens.load(tokenizer_file("word_bpe_49k.json"))
    text = {r.doc_id: r.text for r in steps[3].collect()}
    assert {r.doc_id for r in packed} == set(text)
    for r in packed[:200]:
        ids = np.array([*encode.encode(text[r.doc_id], add_special_tokens=False).ids, 1], "<u4")
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


ODD = "doc_id long, text string, lang string, source string, n_chars long, class_id string, ids string, kept boolean"


def test_stages_on_odd_rows(spark, sf_dir):
    """Nulls in any column, empty, very long and repeated texts, repeated rows and ids, names that stages use themselves."""
    good = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").where("lang = 'en'").orderBy("doc_id").limit(6).collect()]
    texts = [(1, good[0]), (2, good[0]), (2, good[0]), (3, good[1]), (3, good[2]), (None, good[3]), (None, good[3]), (4, None), (5, ""), (6, " \n\t"), (7, " ".join(good) * 30), (8, good[4] + " write to jane.doe@example.org"), (9, good[5])]
    rows = [(i, t, None if k % 2 else "en", None, None if k % 3 else k, "c", None, False) for k, (i, t) in enumerate(texts)]
    docs = spark.createDataFrame(rows, ODD)
    steps = [docs]
    for _, f in cp.STAGES[:-1]:
        steps.append(f(spark, steps[-1], sf_dir).cache())
        assert steps[-1].columns == docs.columns
        assert {r.class_id for r in steps[-1].collect()} <= {"c"}
    first, second, third = (s.collect() for s in steps[1:])
    assert not {4, 5, 6} & {r.doc_id for r in first}
    kept = [r.text for r in second if r.doc_id is not None]
    assert len(kept) == len(set(kept)) and set(kept) == {r.text for r in first if r.doc_id is not None}
    assert [r.text for r in second if r.doc_id is None] == [r.text for r in first if r.doc_id is None]  # rows without an id stay apart
    assert len(third) == len(second) and not any("jane.doe" in r.text for r in third)
    packed = cp.STAGES[-1][1](spark, steps[-1], sf_dir)
    assert packed.agg({"length": "sum"}).first()[0] > 0


def test_stages_on_an_empty_table(spark, sf_dir):
    docs = spark.createDataFrame([], ODD)
    for _, f in cp.STAGES[:-1]:
        out = f(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.count() == 0
    assert cp.STAGES[-1][1](spark, docs, sf_dir).count() == 0


def test_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries()) == list(range(1, 14))
    assert set(oracle_sql()) <= set(queries())
