"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagemill.llm import align, ann, extract, interpolate, neardup, packing, pieces, pii, quality, tokens, warczip, weak, windows
from pagemill.llm.base import table


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary file lies; every operator takes the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolate.score_documents(table(spark, sf_dir, "documents"))


def op2_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warczip.round_trip(table(spark, sf_dir, "pages"))


def op3_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op5_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.similar(table(spark, sf_dir, "documents"))


def op6_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op7_onebit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.where("vec_id % 50 = 0"))


def op8_pii_tagger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"), pii.default_tagger())


def op9_suffix_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op10_host_suffix_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_text(table(spark, sf_dir, "pages"))


def op11_suffix_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


def op12_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_window_bisection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.document_windows(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_deleted_interpolation, op2_warc_zip, op3_quality_forest, op4_token_counts, op5_forest_join, op6_cost_packing, op7_onebit_search, op8_pii_tagger, op9_suffix_pieces, op10_host_suffix_text, op11_suffix_transducer, op12_weak_toxicity, op13_window_bisection)}


BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Twenty bits of the hexadecimal digest are four digits of base 32.
DIGEST = "list_reduce(list_transform(range(0, 8), lambda i: " + " || ".join(f"substring('{BASE32}', ((('0x' || substring(h, (5 * i + 1)::BIGINT, 5))::INTEGER >> {k}) & 31) + 1, 1)" for k in (15, 10, 5, 0)) + "), lambda a, b: a || b)"
#: The checksum of a number's digits, bit by bit; it ends with all bits turned.
CRC32 = "xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(d.doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)"
SQL = {
    "op2_warc_zip": f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages), d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS h FROM p),
 m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS first FROM d)
 SELECT page_id, payload_bytes, {DIGEST} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id < first THEN first END AS refers_to FROM m""",
    "op7_onebit_search": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), n AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS n FROM v),
 s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) / (q.n * c.n) AS score FROM n q JOIN n c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 AND q.n > 0 AND c.n > 0),
 r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s) SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op13_window_bisection": f"""WITH e AS (SELECT doc_id, source, lang, length(text)::BIGINT AS n, 60 * floor((doc_id + {CRC32} % 10000) / 6)::BIGINT AS event_s FROM documents d),
 w AS (SELECT *, 600::BIGINT AS window_s, list(n) OVER s AS ns, count(*) OVER s AS n_events, coalesce(sum(n) OVER s, 0)::BIGINT AS sum_chars, count(DISTINCT lang) OVER s AS n_langs FROM e WINDOW s AS (PARTITION BY source ORDER BY event_s RANGE BETWEEN 600 PRECEDING AND 1 PRECEDING)
  UNION ALL SELECT *, 43200::BIGINT, list(n) OVER s, count(*) OVER s, coalesce(sum(n) OVER s, 0)::BIGINT, count(DISTINCT lang) OVER s FROM e WINDOW s AS (PARTITION BY source ORDER BY event_s RANGE BETWEEN 43200 PRECEDING AND 1 PRECEDING)),
 v AS (SELECT *, list_sort(list_filter(coalesce(ns, []), lambda x: x IS NOT NULL)) AS a FROM w)
 SELECT doc_id, window_s, event_s, n_events, sum_chars, n_langs, a[(len(a) + 1) // 2] AS median_chars, a[(90 * len(a) + 99) // 100] AS high_chars FROM v""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
