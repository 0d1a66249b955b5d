"""The query catalogue: one entry for each operator of the engine, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill import ship
from pagemill.functions import html
from pagemill.plans import index as plan

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship.ensure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_time():
    """The present of all queries: results must not depend on the clock."""
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every page: id, title, first headline, inbound links, words."""
    record = plan.index_record(html.with_html(table(spark, sf_dir, "pages")), load_time())
    return record.select("id", "url_s", F.try_element_at("title", F.lit(1)).alias("title"), F.try_element_at("h1_txt", F.lit(1)).alias("headline"), F.size("inboundlinks_sxt").alias("inboundlinks"), "wordcount_i")


def queries() -> dict[str, Query]:
    from pagemill import catalog  # noqa: F401  registers

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from pagemill import catalog  # noqa: F401

    return dict(SQL)
