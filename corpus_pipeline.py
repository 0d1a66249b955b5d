"""From documents to packed training sequences.

Documents that the quality rules reject go; of each group of near duplicates one
document stays; personal data becomes its kind in angle brackets; what is left is
packed. Each stage works on all rows of the stage before, whose result is written
to the shared folder and read again.

Defined results: null texts count as empty, and the rules reject them; of rows that
repeat id and text one stays, rows without an id are no copies of others; nulls in
other columns stay as they are, and columns of any name are kept until packing,
which returns pieces; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagemill.llm import neardup, packing, pii, quality
from pagemill.llm.base import table, written
from pagemill.llm.queries import tokenizer_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs, pii.default_tagger())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("personal data", personal_data), ("packing", pack)]

#: No SQL: the forest, the tagger and the tokenizer are not expressible; tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
