"""A folder that the driver and all executors see, for what is written between steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new one under spark.checkpoint.dir. Where that is unset a local session gets a temporary one, any other an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="pagemill-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, computed once, written and read again."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Of short rows that grow to pages and the like in a task, so many go to one.
ROWS_IN_TASK = 5000


def spread(df: DataFrame, rows: int = ROWS_IN_TASK) -> DataFrame:
    """The rows dealt out evenly, about so many to a task: a table of short rows lies in few pieces, whatever is made of them later. Call it before they grow, as it shuffles them."""
    return df.repartition(max(1, -(-df.count() // rows)))
