"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
import gc
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill import ship

#: A word is a run of characters other than the six ASCII white-space ones.
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship.ensure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.cache
def _libc():
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.malloc_trim  # noqa: B018  only glibc has it
        return libc
    except (OSError, AttributeError):
        return None


def give_back() -> None:
    """Returns freed memory to the system, so that a worker's size follows what it holds now."""
    pa.default_memory_pool().release_unused()
    if _libc():
        _libc().malloc_trim(0)


_memories: list[tuple[Callable[[], None], tuple[str, ...]]] = []


def memory(clear: Callable[[], None], *users: str) -> None:
    """Says that the modules ``users`` keep something between tasks of a worker, and how to drop it."""
    _memories.append((clear, users))


def begin(module: str) -> None:
    """At the start of a task: what other operators left in this worker goes, so that stages do not add up."""
    for clear, users in _memories:
        if module not in users:
            clear()
    gc.set_threshold(500_000, 20, 50)  # large dicts of strings hold no cycles; walking them often costs more than the work
    give_back()


def map_arrow(df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str, large: bool = False) -> DataFrame:
    """mapInArrow over whole partitions; ``rows`` yields dicts of column lists or Arrow arrays. Freed memory is given
    back at the end of a task, and after each batch if batches are ``large`` (with many small objects that takes long)."""
    ship.ensure(df.sparkSession)
    names = [f.name for f in _schema(schema)]
    types = [_arrow(f.dataType) for f in _schema(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(rows.__module__)
        for out in rows(batches):
            yield pa.RecordBatch.from_arrays([x if isinstance(x := out[n], pa.Array) else pa.array(x, t) for n, t in zip(names, types)], names=names)
            del out
            if large:
                give_back()
        give_back()

    return df.mapInArrow(run, schema)


def _schema(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def texts(column: pa.Array) -> list[str]:
    """Strings of a column, null as the empty one."""
    return [x or "" for x in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """Smaller batches: the memory a step takes follows its slice, not the reader's batch."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors see: under spark.checkpoint.dir. Where that is unset, a local session gets a temporary one, any other an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        root = "file://" + tempfile.mkdtemp(prefix="pagemill-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The rows, written to the shared folder and read again: cuts the lineage and is computed once."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(doc_id: str = "doc_id", n: int = 10):
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n
