"""Python functions over the rows of a partition: whole partitions in Arrow batches, or row by row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StructType

from pagemill import ship


def map_rows(df: DataFrame, rows: Callable[[Iterator[dict]], Iterator[dict]], schema: StructType | str, size: int = 200) -> DataFrame:
    """``rows`` gets the rows of a partition as dicts and yields dicts; they go out in batches of ``size``,
    so that large values do not pile up. Nested values are dicts and lists."""
    ship.ensure(df.sparkSession)
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = [f.name for f in kind]
    types = [to_arrow_type(f.dataType) for f in kind]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            for at in range(0, b.num_rows, size):
                yield from b.slice(at, size).to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in held], t) for n, t in zip(names, types)], names=names)

        for r in rows(read(batches)):
            held.append(r)
            if len(held) >= size:
                yield out()
                held.clear()
        if held:
            yield out()

    return df.mapInArrow(run, kind)


def by_row(f: Callable, kind: DataType | str) -> Callable[..., Column]:
    """A function of columns that calls ``f`` with each row's values. Rows come a hundred at a time, whereas an Arrow batch has up to 10,000 or 64 MB, and a worker
    holds two of them; so this is for large values of which each gives one, as pages do. Nested values are dicts and lists, maps are dicts."""
    return F.udf(f, kind, useArrow=False)
