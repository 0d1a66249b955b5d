"""Nearest neighbours by randomly rotated one-bit codes.

A unit vector x is rotated and kept as the signs of its components, packed into
bits, with one scalar: a, its inner product with its own sign vector s (of unit
length). For a unit query q, <q, s> / a estimates <q, x>, with a standard
deviation of about sqrt(1 / a^2 - 1) / sqrt(d - 1). A vector is reranked by its
exact cosine unless even its estimate plus ``bound`` such deviations stays below
what the query's k-th best is sure to reach. Of many that are left, single precision
first tells those that are not among the k best by more than its error.

The index is every row, in blocks; the query set is a stated one, in blocks too.
Each group of data blocks meets each query block once, in whichever task has them:
no row pairs are made, and a task gives at most k rows for a query and block.
Query blocks are repeated for each group, so they are shuffled, never broadcast.

Defined results: vectors that are null, empty, all zero or hold null or
non-finite components take no part, neither do rows without an id; vectors of another length
than the query's are no candidates; of rows with a query's id none is its
candidate; equal scores go to the smaller id; repeated rows are candidates each;
of rows that repeat an id among the queries the one of least vector (component by component) asks; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagemill.llm.base import map_arrow

BLOCK = 4096
BLOCKS = "part int, dim int, n int, ids binary, vectors binary"


def rotation(d: int, seed: int = 5) -> np.ndarray:
    """A random orthogonal matrix; the same for a dimension everywhere."""
    q, r = np.linalg.qr(np.random.default_rng([seed, d]).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(F.expr("size(v) > 0")).where(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    )


def blocks(df: DataFrame, parts: int, size: int = BLOCK) -> DataFrame:
    """Rows of up to ``size`` vectors of one length, as packed arrays; ``part`` deals them out."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        context = TaskContext.get()
        serial = context.partitionId() if context else 0
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def emit(dim: int) -> dict:
            nonlocal serial
            serial += 1
            ids = np.concatenate([a for a, _ in held[dim]])
            v = np.concatenate([b for _, b in held[dim]])
            held[dim] = []
            return {"part": [serial % parts], "dim": [dim], "n": [len(ids)], "ids": [ids.tobytes()], "vectors": [packed(v)]}

        for b in batches:
            lists = b.column("v")
            ids = b.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
            offsets = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            length = np.diff(offsets)
            for dim in np.unique(length).tolist():
                rows_ = np.flatnonzero(length == dim)
                for at in range(0, len(rows_), size):
                    some = rows_[at : at + size]
                    v = values[offsets[some][:, None] + np.arange(dim)]
                    held.setdefault(dim, []).append((ids[some], v))
                    if sum(len(a) for a, _ in held[dim]) >= size:
                        yield emit(dim)
        for dim in list(held):
            if held[dim]:
                yield emit(dim)

    return map_arrow(df, rows, BLOCKS)


def packed(v: np.ndarray) -> bytes:
    """Vectors as bytes: in single precision if that loses nothing."""
    with np.errstate(over="ignore"):
        single = v.astype(np.float32)
    return (single if np.array_equal(single, v) else v).tobytes()


def unpacked(raw: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(raw, np.float32 if len(raw) == 4 * n * dim else np.float64).reshape(n, dim).astype(np.float64)


class Codes:
    """Packed signs and correction scalars of a block."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.norms = np.sqrt((vectors * vectors).sum(1))
        self.dim = vectors.shape[1]
        largest = np.abs(vectors).max(1)  # so that very large or small vectors keep a usable direction
        unit = vectors / largest[:, None]
        unit /= np.sqrt((unit * unit).sum(1))[:, None]
        self.single = unit.astype(np.float32)
        self.error = (self.dim + 8) * 2.4e-7  # of a cosine in single precision, at most
        self.even = bool((np.abs(np.log10(self.norms, where=self.norms > 0, out=np.full(len(vectors), np.inf))) < 100).all())
        turned = unit @ rotation(self.dim).T
        self.bits = np.packbits(turned > 0, axis=1)
        self.own = np.abs(turned).sum(1) / np.sqrt(self.dim)

    def signs(self) -> np.ndarray:
        return np.unpackbits(self.bits, axis=1, count=self.dim).astype(np.float32) * 2 - 1

    def estimate(self, turned_queries: np.ndarray) -> np.ndarray:
        """Estimated cosines (vectors, queries)."""
        return (self.signs() @ turned_queries.T.astype(np.float32)) / (np.sqrt(self.dim) * self.own)[:, None].astype(np.float32)

    def deviation(self) -> np.ndarray:
        return np.sqrt(np.maximum(1 / self.own**2 - 1, 0)) / np.sqrt(max(self.dim - 1, 1)) + 1e-6


def exact_cosine(v: np.ndarray, v_norm: np.ndarray, q: np.ndarray, q_norm: float) -> np.ndarray:
    return (v * q).sum(1) / (v_norm * q_norm)


def best_in_block(codes: Codes, ids: np.ndarray, q_ids: np.ndarray, q: np.ndarray, k: int, bound: float, floor: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the k best of a block, without those below ``floor``, which has what the query's k-th best reaches at least, and is raised."""
    q_norm = np.sqrt((q * q).sum(1))
    unit = q / np.abs(q).max(1)[:, None]
    unit /= np.sqrt((unit * unit).sum(1))[:, None]
    single = unit.astype(np.float32)
    slack = (bound * codes.deviation()).astype(np.float32)
    high = np.ascontiguousarray(codes.estimate(unit @ rotation(codes.dim).T).T)
    high += slack
    n = len(ids)
    for j in range(len(q_ids)):
        least = floor[j] - 1e-6
        if least == -np.inf and n > k:
            least = np.partition(high[j] - 2 * slack, n - k - 1)[n - k - 1]  # one more than k: the query's own row may be among them
        rows = np.flatnonzero(high[j] >= least)
        rows = rows[ids[rows] != q_ids[j]]
        if len(rows) > k and codes.even and 1e-100 < q_norm[j] < 1e100:
            near = codes.single[rows] @ single[j]
            rows = rows[near >= max(np.partition(near, len(rows) - k)[len(rows) - k] - 2 * codes.error, floor[j] - codes.error)]
        score = exact_cosine(codes.vectors[rows], codes.norms[rows], q[j], q_norm[j])
        order = np.lexsort((ids[rows], -score))[:k]
        kept = order[~(score[order] < floor[j])]
        if len(order) == k:
            floor[j] = max(floor[j], score[order[-1]])
        if len(kept):
            yield j, ids[rows][kept], score[kept]


def search(index: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", bound: float = 4.0) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of the index for each query."""
    n = index.count()
    parts = max(1, -(-n // (2 * BLOCK)))
    data = blocks(usable(index, id_col, vec_col), parts)
    asked = usable(queries, id_col, vec_col)
    rest = [c for c in asked.columns if c != "id"]
    asked = asked.groupBy("id").agg(F.min(F.struct(*rest)).alias("one")).select("id", *[f"one.{c}" for c in rest])  # of rows with one id the least vector asks
    asked = blocks(asked, 1, 1024).select(F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    asked = asked.withColumn("q_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).hint("merge")  # Spark takes it for as small as the queries and would broadcast it, however often it repeats them
    met = data.join(asked, (F.col("part") == F.col("q_part")) & (F.col("dim") == F.col("q_dim"))).select("dim", "ids", "vectors", "q_ids", "q_vectors")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        floors: dict[bytes, np.ndarray] = {}
        last: tuple[bytes, Codes] | None = None
        for b in batches:
            for i in range(b.num_rows):
                dim = b.column("dim")[i].as_py()
                raw = b.column("vectors")[i].as_py()
                ids = np.frombuffer(b.column("ids")[i].as_py(), np.int64)
                if last is None or last[0] != raw:
                    last = raw, Codes(unpacked(raw, len(ids), dim))
                q_raw = b.column("q_ids")[i].as_py()
                q_ids = np.frombuffer(q_raw, np.int64)
                q = unpacked(b.column("q_vectors")[i].as_py(), len(q_ids), dim)
                if len(floors) > 1000:
                    floors.clear()
                floor = floors.setdefault(q_raw, np.full(len(q_ids), -np.inf))
                got = list(best_in_block(last[1], ids, q_ids, q, k, bound, floor))
                if got:
                    yield {"query_id": np.repeat(q_ids[[j for j, _, _ in got]], [len(x) for _, x, _ in got]), "vec_id": np.concatenate([x for _, x, _ in got]), "score": np.concatenate([s for _, _, s in got])}

    found = map_arrow(met, rows, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(ids: np.ndarray, v: np.ndarray, q_ids: np.ndarray, q: np.ndarray, k: int = 5) -> list[tuple[int, int, int, float]]:
    """The same by comparing everything; for tests and for measuring recall."""
    norms, out = np.sqrt((v * v).sum(1)), []
    for i, x in zip(q_ids, q):
        rows = np.flatnonzero(ids != i)
        score = exact_cosine(v[rows], norms[rows], x, np.sqrt((x * x).sum()))
        for rank, at in enumerate(np.lexsort((ids[rows], -score))[:k], 1):
            out.append((int(i), rank, int(ids[rows][at]), float(score[at])))
    return out
