"""Scoring by deleted interpolation of word bigrams.

p(w | u) = l2 * c(u w) / c(u) + l1 * c(w) / N + l0 / (V + 1), where the weights
depend on the bucket of c(u), the frequency of the context (by powers of two).
The weights are learned by expectation-maximisation on held-out counts: one tenth
of the training documents is set aside in sections; a section's own counts are
deleted from the counts that its tokens are looked up in.

Counts are exact and over all documents. Texts are read once into chunks of
bounded size, which are written to the shared folder: numbers for the tokens and a 64-bit hash
for each distinct word. From a chunk come its distinct words and bigrams with
their counts, as packed arrays, one for each range of hashes. A group of chunks
is summed range by range; where there is more than one group, their sums are
summed in the same way, in finer ranges, and so on. The totals go back down the
same levels, each answered in the order in which it was asked. A chunk, and the
sum of a group's range, has a fixed number of ranges, so rows grow in proportion
to the input and a task holds what one range of one group has. At a level a
(chunk, n-gram) pair moves once each way, whatever the frequency of the n-gram,
so no key is hot.

What comes to the driver are N, V and a histogram of the held-out tokens by
context bucket, bigram estimate and unigram estimate in fine steps, of bounded
size, from which the weights follow.

Defined results: A-Z are lower-cased; a null text is empty and has the end token
alone; rows without doc_id count as held out (the checksum of no text is 0) and are
scored; copies and repeated rows count each; without training documents every
estimate but the uniform one is 0; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.base import crc_mod, map_arrow, slices, texts, written
from pagemill.llm.neardup import U, mixed

CHUNK_BYTES = 4 << 20
END, START = b" end", b" start"  # no word holds a blank
STEPS, LOWEST = 4, 40  # an octave has so many steps; estimates below 2 ** -LOWEST count as that
BUCKETS = 40
SCHEMA = "chunk long, section boolean, n int, doc_ids array<long>, train binary, lengths binary, words binary, tokens binary"
#: How many chunks, or groups of the level below, are summed at once, and by how many bits of the hash a level splits: a range of a full group has some 20 MB.
FAN, BITS = 1024, 8
PARTS = "group long, kind int, range long, unit long, keys binary, counts binary"


def squeeze(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def unsqueeze(x: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind)


def chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The texts as token numbers. Sections hold the held-out tenth of the training documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        context = TaskContext.get()
        serial = (context.partitionId() if context else 0) << 28

        class Open:
            def __init__(self, section: bool):
                self.section = section
                self.clear()

            def clear(self) -> None:
                self.number = defaultdict(count().__next__)
                self.number[END], self.number[START]
                self.docs, self.train, self.lengths, self.parts, self.size = [], [], [], [], 0

            def add(self, doc, train: bool, text: str) -> None:
                words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: only A-Z change, only the six characters split
                ids = np.empty(len(words) + 1, np.uint32)
                ids[:-1] = np.fromiter(map(self.number.__getitem__, words), np.uint32, len(words))
                ids[-1] = 0
                self.docs.append(doc), self.train.append(train), self.lengths.append(len(ids)), self.parts.append(ids)
                self.size += len(text)

            def close(self) -> dict:
                nonlocal serial
                words = np.fromiter(map(xxhash.xxh3_64_intdigest, self.number), np.uint64, len(self.number))
                out = {
                    "chunk": [serial], "section": [self.section], "n": [len(self.docs)], "doc_ids": [self.docs], "train": [np.array(self.train, np.uint8).tobytes()],
                    "lengths": [np.array(self.lengths, np.uint32).tobytes()], "words": [words.tobytes()], "tokens": [squeeze(np.concatenate(self.parts))],
                }
                serial += 1
                self.clear()
                return out

        main, section = Open(False), Open(True)
        for b in slices(batches, 500):
            for doc, rest, text in zip(b.column("doc_id").to_pylist(), b.column("rest").to_pylist(), texts(b.column("text"))):
                to = section if rest == 1 else main
                to.add(doc, rest != 0, text)
                if to.size >= chunk_bytes:
                    yield to.close()
        for to in (main, section):
            if to.docs:
                yield to.close()

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), crc_mod().cast("int").alias("rest"))
    return map_arrow(docs, rows, SCHEMA, large=True)


class Chunk:
    """A chunk's tokens with their contexts, and its distinct n-grams in the order of their hashes."""

    def __init__(self, train: bytes, lengths: bytes, words: bytes, tokens: bytes):
        self.train = np.frombuffer(train, np.uint8).astype(bool)
        self.lengths = np.frombuffer(lengths, np.uint32).astype(np.int64)
        self.tokens = unsqueeze(tokens, np.uint32)
        words = np.frombuffer(words, np.uint64)
        self.ends = np.cumsum(self.lengths)
        self.before = np.empty_like(self.tokens)
        self.before[1:] = self.tokens[:-1]
        self.before[self.ends - self.lengths] = 1
        order = np.argsort(words, kind="stable")
        self.rank = np.empty(len(words), np.int32)
        self.rank[order] = np.arange(len(words), dtype=np.int32)
        self.words = words[order]
        code = words[self.before]
        code *= U(0x9E3779B97F4A7C15)
        code += words[self.tokens]
        code = mixed(code)
        order = np.argsort(code, kind="stable")
        code = code[order]
        first = np.ones(len(code), bool)
        np.not_equal(code[1:], code[:-1], out=first[1:])
        self.pairs = code[first]
        self.which = np.empty(len(code), np.int32)
        self.which[order] = np.cumsum(first, dtype=np.int32) - 1

    def own(self) -> tuple[np.ndarray, np.ndarray]:
        """Counts in the chunk's training documents: of words, where the start counts as a word, and of bigrams."""
        kept = np.repeat(self.train, self.lengths)
        words = np.bincount(self.rank[self.tokens[kept]], minlength=len(self.words))
        words[self.rank[1]] = int(self.train.sum())
        return words, np.bincount(self.which[kept], minlength=len(self.pairs))


def by_range(keys: np.ndarray, level: int) -> Iterator[tuple[int, slice]]:
    """The ranges of sorted hashes at a level, by their leading bits."""
    top = keys >> U(64 - BITS * (level + 1))
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(top)), bool), top[1:] != top[:-1]]))
    return zip(top[starts].tolist(), map(slice, starts.tolist(), [*starts[1:].tolist(), len(keys)]))


def counts_of(packed: bytes, n: int) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    return np.frombuffer(raw, np.uint32 if len(raw) == 4 * n else np.uint64).astype(np.int64)


def runs(batches: Iterator[pa.RecordBatch], by: tuple[str, ...], columns: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """The rows of each key, which lie together."""
    key, held = None, []
    for b in batches:
        for i in range(b.num_rows):
            now = tuple(b.column(c)[i].as_py() for c in by)
            if now != key:
                if held:
                    yield key, held
                key, held = now, []
            held.append(tuple(b.column(c)[i].as_py() for c in columns))
    if held:
        yield key, held


def partial_counts(made: DataFrame, groups: int) -> DataFrame:
    """A row for each chunk, kind (0 words, 1 bigrams) and range of hashes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            for i in range(b.num_rows):
                c = Chunk(*(b.column(k)[i].as_py() for k in ("train", "lengths", "words", "tokens")))
                unit = b.column("chunk")[i].as_py()
                group = xxhash.xxh3_64_intdigest(str(unit)) % groups
                out: dict[str, list] = {k: [] for k in ("group", "kind", "range", "unit", "keys", "counts")}
                own = c.own()
                for kind, keys, n in ((0, c.words, own[0]), (1, c.pairs, own[1])):
                    for r, part in by_range(keys, 0):
                        for k, v in zip(out, (group, kind, r, unit, keys[part].tobytes(), squeeze(n[part].astype(np.uint32)))):
                            out[k].append(v)
                yield out

    return map_arrow(made.select("chunk", "train", "lengths", "words", "tokens"), rows, PARTS, large=True)


def summed(held: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Rows of hashes and counts as one: order, sorted hashes, place of each first, total of each, and the hashes of each row."""
    keys = [np.frombuffer(k, np.uint64) for _, k, _ in held]
    n = np.concatenate([counts_of(c, len(k)) for k, (_, _, c) in zip(keys, held)])
    joined = np.concatenate(keys)
    order = np.argsort(joined, kind="stable")
    s = joined[order]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    return order, s, first, np.add.reduceat(n[order], first), keys


def together(parts: DataFrame) -> DataFrame:
    return parts.repartition("group", "kind", "range").sortWithinPartitions("group", "kind", "range")


def totals(parts: DataFrame) -> DataFrame:
    """For each row of counts the totals of its keys, where one group is all. Rows with unit -1 hold N and V of a range of words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        start = np.uint64(xxhash.xxh3_64_intdigest(START))
        for (kind, r), held in runs(batches, ("kind", "range"), ("unit", "keys", "counts")):
            order, s, first, total, keys = summed(held)
            back = np.empty(len(s), np.int64)
            back[order] = np.repeat(total, np.diff(np.append(first, len(s))))
            at = np.cumsum([0] + [len(k) for k in keys])
            yield {"unit": [u for u, _, _ in held], "kind": [kind] * len(held), "range": [r] * len(held), "totals": [squeeze(back[a:b].astype(np.uint64)) for a, b in zip(at, at[1:])], "tokens": [0] * len(held), "types": [0] * len(held)}
            if kind == 0:
                real = s[first] != start
                yield {"unit": [-1], "kind": [0], "range": [r], "totals": [b""], "tokens": [int(total[real].sum())], "types": [int((total[real] > 0).sum())]}

    return map_arrow(together(parts), rows, "unit long, kind int, range long, totals binary, tokens long, types long", large=True)


def sums(parts: DataFrame, level: int, fan: int) -> DataFrame:
    """The sums of each group and range as rows of counts of the next level, in its finer ranges; the group is the unit there.
    Beside them a row for each row of counts, with the places of its keys among the sums, by which it is answered later."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for (group, kind, r), held in runs(batches, ("group", "kind", "range"), ("unit", "keys", "counts")):
            order, s, first, total, own = summed(held)
            keys, total = s[first], total.astype(np.uint64)
            finer = list(by_range(keys, level + 1))
            k = len(finer)
            yield {"group": [group // fan] * k, "kind": [kind] * k, "range": [r for r, _ in finer], "unit": [group] * k, "keys": [keys[p].tobytes() for _, p in finer], "counts": [squeeze(total[p]) for _, p in finer], "places": [None] * k}
            place = np.empty(len(s), np.int64)
            place[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(s))))
            at = np.cumsum([0] + [len(x) for x in own])
            k = len(own)
            steps = [squeeze(np.diff(place[i:j], prepend=0).astype(np.uint32)) for i, j in zip(at, at[1:])]
            yield {"group": [group] * k, "kind": [kind] * k, "range": [r] * k, "unit": [u for u, _, _ in held], "keys": [None] * k, "counts": [None] * k, "places": steps}

    return map_arrow(together(parts), rows, PARTS + ", places binary", large=True)


def handed_down(places: DataFrame, answers: DataFrame) -> DataFrame:
    """For each row of counts the totals of its keys, from the answers to the sums of its group."""
    told = answers.select(F.col("unit").alias("group"), "kind", F.shiftright("range", BITS).alias("range"), F.lit(0).alias("tag"), F.col("range").alias("at"), F.col("totals").alias("data"))
    asked = places.select("group", "kind", "range", F.lit(1).alias("tag"), F.col("unit").alias("at"), F.col("places").alias("data"))
    met = told.union(asked).repartition("group", "kind", "range").sortWithinPartitions("group", "kind", "range", "tag", "at")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for (_, kind, r), held in runs(batches, ("group", "kind", "range"), ("tag", "at", "data")):
            total = np.concatenate([unsqueeze(x, np.uint64) for tag, _, x in held if tag == 0])
            own = [(u, np.cumsum(unsqueeze(x, np.uint32), dtype=np.int64)) for tag, u, x in held if tag == 1]
            yield {"unit": [u for u, _ in own], "kind": [kind] * len(own), "range": [r] * len(own), "totals": [squeeze(total[at]) for _, at in own]}

    return map_arrow(met, rows, "unit long, kind int, range long, totals binary", large=True)


def answered(parts: DataFrame, groups: int, level: int, fan: int) -> tuple[DataFrame, int, int]:
    """The totals for all rows of counts, and N and V. There are as many levels as the logarithm of the input, to the base of ``fan``."""
    if groups == 1:
        answers = written(totals(parts), "totals")
        n, v = (int(x or 0) for x in answers.where("unit < 0").agg(F.sum("tokens"), F.sum("types")).first())
        return answers.where("unit >= 0").select("unit", "kind", "range", "totals"), n, v
    above = written(sums(parts, level, fan), "sums")
    answers, n, v = answered(above.where("keys is not null").drop("places"), -(-groups // fan), level + 1, fan)
    return written(handed_down(above.where("places is not null"), answers), "totals"), n, v


def meet(made: DataFrame, answers: DataFrame) -> DataFrame:
    """Each chunk with the totals of its words and bigrams."""
    got = answers.withColumnRenamed("unit", "chunk").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("kind", "range", "totals"))).alias("got"))
    return made.join(got, "chunk").select("doc_ids", "train", "lengths", "words", "tokens", F.expr("transform(filter(got, x -> x.kind = 0), x -> x.totals)").alias("word_totals"), F.expr("transform(filter(got, x -> x.kind = 1), x -> x.totals)").alias("pair_totals"))


def unpacked(b: pa.RecordBatch) -> Iterator[tuple[list, Chunk, np.ndarray, np.ndarray]]:
    for i in range(b.num_rows):
        c = Chunk(*(b.column(k)[i].as_py() for k in ("train", "lengths", "words", "tokens")))
        w, p = (np.concatenate([unsqueeze(x, np.uint64) for x in b.column(k)[i].as_py()]).astype(np.int64) for k in ("word_totals", "pair_totals"))
        yield b.column("doc_ids")[i].as_py(), c, w, p


def bucket(n: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + the power of two below its frequency."""
    return np.where(n > 0, np.minimum(np.frexp(np.maximum(n, 1).astype(float))[1], BUCKETS - 1), 0)


def step_of(x: np.ndarray) -> np.ndarray:
    """0 for none, else the place of an estimate on a logarithmic scale."""
    with np.errstate(divide="ignore"):
        return np.where(x > 0, 1 + np.clip(np.rint((np.log2(np.where(x > 0, x, 1)) + LOWEST) * STEPS), 0, LOWEST * STEPS), 0).astype(np.int64)


def value_of(step: np.ndarray) -> np.ndarray:
    return np.where(step > 0, np.exp2((step - 1) / STEPS - LOWEST), 0.0)


def ratio(a: np.ndarray, b) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=np.broadcast_to(np.asarray(b) > 0, a.shape))


def histogram(met: DataFrame, n: int) -> DataFrame:
    """Held-out tokens by bucket of the context and steps of both estimates, the section's own counts deleted."""
    wide = LOWEST * STEPS + 2

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            for _, c, words, pairs in unpacked(b):
                own_words, own_pairs = c.own()
                context = (words - own_words)[c.rank[c.before]]
                left = n - int(len(c.tokens))
                two = ratio((pairs - own_pairs)[c.which], context)
                one = ratio((words - own_words)[c.rank[c.tokens]], left)
                cell, times = np.unique((bucket(context) * wide + step_of(two)) * wide + step_of(one), return_counts=True)
                yield {"cell": cell, "times": times}

    return map_arrow(met, rows, "cell long, times long", large=True).groupBy("cell").agg(F.sum("times").alias("times"))


def weights(cells: np.ndarray, times: np.ndarray, uniform: float, rounds: int = 100) -> np.ndarray:
    """(bucket, order) weights that make the held-out tokens most likely; a bucket without any takes those of the nearest below that has."""
    wide = LOWEST * STEPS + 2
    b, two, one = cells // wide // wide, value_of(cells // wide % wide), value_of(cells % wide)
    parts = np.stack([np.full(len(cells), uniform), one, two], 1)
    out = np.zeros((BUCKETS, 3))
    out[:] = [0.05, 0.95, 0.0]
    for k in range(BUCKETS):
        some = b == k
        if not some.any():
            out[k] = out[k - 1] if k > 1 else [0.05, 0.95, 0.0]
            continue
        p, t, w = parts[some], times[some].astype(float), np.array([0.1, 0.4, 0.5])
        if k == 0:
            w = np.array([0.1, 0.9, 0.0])  # no context, no bigram estimate
        for _ in range(rounds):
            share = p * w
            share /= np.maximum(share.sum(1, keepdims=True), 1e-300)
            w = (share * t[:, None]).sum(0) / t.sum()
        w = np.maximum(w, [1e-6, 0, 0])
        out[k] = w / w.sum()
    return out


def scored(met: DataFrame, n: int, v: int, weight: np.ndarray) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            for docs, c, words, pairs in unpacked(b):
                context, own = words[c.rank[c.before]], words[c.rank[c.tokens]]
                at = bucket(context)
                p = ratio(pairs[c.which], context)
                p *= weight[at, 2]
                p += weight[at, 1] * ratio(own, n)
                p += weight[at, 0] / (v + 1)
                starts = c.ends - c.lengths
                score = np.add.reduceat(np.log10(p, out=p), starts)
                np.add(own, 0.1, out=p)
                p /= n + 0.1 * (v + 1)
                base = np.add.reduceat(np.log10(p, out=p), starts)
                yield {"doc_id": docs, "held_out": ~c.train, "n_tokens": c.lengths, "n_known": np.add.reduceat((own > 0).astype(np.int64), starts), "train_tokens": np.full(len(docs), n), "base_score": base, "score": score}
                del c, words, pairs, context, own, at, p

    return map_arrow(met, rows, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double", large=True)


def score_documents(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, fan: int = FAN) -> DataFrame:
    made = written(chunks(docs, chunk_bytes), "chunks")
    groups = max(1, -(-made.count() // fan))
    answers, n, v = answered(partial_counts(made, groups), groups, 0, fan)
    held = histogram(meet(made.where("section"), answers), n).toPandas()
    weight = weights(held["cell"].to_numpy(np.int64), held["times"].to_numpy(np.int64), 1 / (v + 1))
    return scored(meet(made, answers), n, v, weight)
