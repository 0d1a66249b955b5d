"""Cost-balanced packing of documents into token sequences.

A piece of n tokens costs ``linear * n + quadratic * n * n``, as attention within
a document does. A task gathers documents up to a bounded window of tokens, cuts
what exceeds a sequence into full ones, and gives the remaining pieces, longest
first, to the sequence of least cost that still has room; a piece that fits
nowhere is cut over the roomiest sequences. What is left over moves to the next window. The
last tokens of a task go into sequences whose lengths are powers of two,
which need no padding.

No shuffle is needed and a lost task gives the same rows again: they follow from
the task's own input. Sequence ids hold the task's number in their upper bits.

Defined results: a null text counts as empty, so it is the end id alone; a null
doc_id stays null; copies are packed like any row; other columns are ignored; an
empty table gives no rows; a text longer than a window is cut like any other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.base import WORD, map_arrow, slices, texts
from pagemill.llm.tokens import remembered

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Piece:
    __slots__ = ("doc", "ids", "start", "total")

    def __init__(self, doc, ids: memoryview, start: int, total: int):
        self.doc, self.ids, self.start, self.total = doc, ids, start, total

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> tuple["Piece", "Piece"]:
        return Piece(self.doc, self.ids[: 4 * n], self.start, self.total), Piece(self.doc, self.ids[4 * n :], self.start + n, self.total)


def assign(pieces: list[Piece], capacities: list[int], linear: float, quadratic: float) -> tuple[list[list[Piece]], list[Piece]]:
    """Fill sequences of these capacities; what exceeds all of them together is returned as the rest."""
    room = np.array(capacities, np.int64)
    cost = np.zeros(len(room))
    held: list[list[Piece]] = [[] for _ in capacities]
    rest: list[Piece] = []
    for p in sorted(pieces, key=lambda p: (-len(p), p.start)):
        n = len(p)
        fits = np.flatnonzero(room >= n)
        if len(fits):
            at = int(fits[np.argmin(cost[fits])])
            held[at].append(p)
            room[at] -= n
            cost[at] += linear * n + quadratic * n * n
        else:
            rest.append(p)
    left: list[Piece] = []
    for p in rest:
        while len(p):
            at = int(np.argmax(room)) if len(room) else -1
            if at < 0 or room[at] == 0:
                left.append(p)
                break
            head, p = p.cut(min(int(room[at]), len(p)))
            held[at].append(head)
            room[at] -= len(head)
    return held, left


def powers(n: int) -> list[int]:
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def pack(docs: DataFrame, path: str, size: int = 2048, end_id: int = 1, window: int = 4_000_000, linear: float = 1.0, quadratic: float = 1 / 2048) -> DataFrame:
    """Pieces with their sequence and place; each sequence is full or a power of two long."""
    end = np.array([end_id], "<u4").tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        context = TaskContext.get()
        serial = (context.partitionId() if context else 0) << 36
        known = remembered(path, True)
        waiting: list[Piece] = []
        tokens = 0

        def emit(sequences: list[list[Piece]]) -> dict:
            nonlocal serial
            out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
            for held in sequences:
                at = 0
                for p in held:
                    for k, v in zip(out, (p.doc, p.start, len(p), zlib.crc32(p.ids), p.total, serial, at)):
                        out[k].append(v)
                    at += len(p)
                serial += bool(held)
            return out

        def close(last: bool) -> Iterator[dict]:
            nonlocal waiting, tokens
            whole: list[list[Piece]] = []
            parts: list[Piece] = []
            for p in waiting:
                while len(p) >= size:
                    head, p = p.cut(size)
                    whole.append([head])
                if len(p):
                    parts.append(p)
            held, left = assign(parts, [size] * (sum(map(len, parts)) // size), linear, quadratic)
            yield emit(whole + held)
            if last and left:
                held, left = assign(left, powers(sum(map(len, left))), linear, quadratic)
                yield emit(held)
            waiting, tokens = left, sum(map(len, left))

        for b in slices(batches, 500):
            split = [WORD.findall(t) for t in texts(b.column("text"))]
            pieces = known.learn(set().union(*split))
            for doc, words in zip(b.column("doc_id").to_pylist(), split):
                ids = memoryview(b"".join(map(pieces.__getitem__, words)) + end)
                waiting.append(Piece(doc, ids, 0, len(ids) // 4))
                tokens += len(ids) // 4
            if tokens >= window:
                yield from close(False)
        yield from close(True)

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), rows, SCHEMA)
