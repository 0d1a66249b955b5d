"""Alignment of two tokenizers by a dangling-suffix transducer.

A text is encoded by a byte-level BPE (A, with a space before the text) and by a SentencePiece
model (B, which adds the space itself). A transducer reads both token sequences: its state is
which side leads and the bytes by which it does (the dangling suffix). The next token is always
taken from the side behind; where the suffix is used up both sides end together and a group
closes. Steps are memoised by state and token, so bytes are compared once for each kind of step.

Both encoders begin anew where white space follows other characters, but for the few (a carriage
return) that a piece of B has after others. So a text is cut there, a distinct run is encoded and aligned once, and
what its groups and links are is looked up for every later occurrence.

A link is a pair of tokens that end together: the last of both sides of a group. Links are counted over
all texts: a task writes, for each slice of texts, the links of its runs and the runs of its
texts as packed numbers; the counts of id pairs are summed by Spark; then the slices are read again,
without the texts, with the counts of all pairs. Of two ids that end together the bytes of one are an end of the
other's, so the pairs are bounded by the two vocabularies, whatever the corpus; that bound is
computed (``possible_pairs``), and holds for what is broadcast.

Defined results: texts that are null or empty, or whose B bytes are not those of the
text with a space before it (a text that holds U+2581), have no tokens: zeros and ''; special strings inside texts are plain text; a null doc_id stays null;
repeated rows count each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.base import map_arrow, memory, slices, texts, written

SPACE = "▁"
# White space that both encoders and the cut below agree on.
BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
ACROSS = re.compile(f"[^{BLANK}{SPACE}]([{BLANK}{SPACE}])")
#: Runs that a worker remembers; beyond that it starts anew.
REMEMBERED = 400_000


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies: bytes that are printable in Latin-1 stand for themselves, the others follow from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    out = {chr(b): b for b in own}
    return out | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}


class ByteLevel:
    """Encoder A: ids and the bytes of each id, from a tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = {t["id"] for t in spec["added_tokens"]}
        alphabet = byte_alphabet()
        self.bytes = {i: bytes(alphabet[c] for c in t) for t, i in spec["model"]["vocab"].items() if i not in added}
        self.encode = self._ranked(spec) or self._library(path)

    def _ranked(self, spec: dict):
        """The same merges by tiktoken, which is several times faster, where ids are the order of merges and the splitter is the usual one."""
        vocab, split = spec["model"]["vocab"], spec["pre_tokenizer"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not spec.get("normalizer")
        if not plain or any(vocab.get(a + b) != 256 + k for k, (a, b) in enumerate(merges)) or len(self.bytes) != 256 + len(merges):
            return None
        import public_tokenizers
        import tiktoken

        return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks={b: i for i, b in self.bytes.items()}, special_tokens={}).encode_ordinary

    def _library(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        t.encode_special_tokens = True
        return lambda text: t.encode(text, add_special_tokens=False).ids


class SpacePieces:
    """Encoder B: ids and the bytes of each id, from a SentencePiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        sp, n = self.model, self.model.get_piece_size()
        self.bytes = {i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace(SPACE, " ").encode() for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        self.space = sp.piece_to_id(SPACE)
        # white space that some piece has after other characters does not end a run
        inner = {m[1] for i in self.bytes if not sp.is_byte(i) for m in ACROSS.finditer(sp.id_to_piece(i))}
        self.parts = SPACE not in inner
        goes_on = f"(?:[{re.escape(''.join(sorted(inner)))}][{BLANK}]*[^{BLANK}]*)*" if inner else ""
        self.runs = re.compile(f"[{BLANK}]*[^{BLANK}]+{goes_on}|[{BLANK}]+").findall

    def encode_many(self, runs: list[str]) -> list[list[int] | None]:
        """Ids of runs of a text that begins with a space; None where the run alone does not tell."""
        ids = self.model.encode([r[1:] if r[0] == " " else r for r in runs], num_threads=1)
        # the model puts a space before a run that has none; it must stand alone to be taken off again
        return [i if r[0] == " " else i[1:] if i and i[0] == self.space else None for r, i in zip(runs, ids)]


class Transducer:
    """States are numbers: 0 is the empty suffix, others stand for (side, suffix). Steps are remembered by state and token."""

    def __init__(self, a: dict[int, bytes], b: dict[int, bytes]):
        self.sides = (a, b)
        self.states: list[tuple[int, bytes]] = [(1, b"")]  # with nothing left over side A is read, as if B led
        self.number = {self.states[0]: 0}
        self.steps: dict[int, int] = {}

    def step(self, state: int, token: int) -> int:
        """The state after the side that is behind has read a token; -1 if the bytes differ."""
        leads, rest = self.states[state]
        new = self.sides[1 - leads].get(token)
        if not new:
            to = -1
        elif len(new) <= len(rest):
            to = self._state(leads, rest[len(new) :]) if rest.startswith(new) else -1
        else:
            to = self._state(1 - leads, new[len(rest) :]) if new.startswith(rest) else -1
        self.steps[state << 20 | token] = to
        return to

    def _state(self, leads: int, rest: bytes) -> int:
        key = (leads, rest) if rest else (1, b"")
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
        return self.number[key]

    def groups(self, a: list[int], b: list[int]) -> list[tuple[int, int]] | None:
        """Where groups end, as numbers of tokens of A and B; None if the bytes differ."""
        steps, states, step = self.steps, self.states, self.step
        i = j = state = 0
        na, nb, out = len(a), len(b), []
        while True:
            if states[state][0]:
                if i == na:
                    break
                token = a[i]
                i += 1
            else:
                if j == nb:
                    break
                token = b[j]
                j += 1
            to = steps.get(state << 20 | token)
            state = step(state, token) if to is None else to
            if state < 0:
                return None
            if state == 0:
                out.append((i, j))
        return out if state == 0 and i == na and j == nb else None


class Aligner:
    """What a worker remembers of runs: number of tokens and groups, the groups in writing, and the links as id pairs."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), SpacePieces(path_b)
        self.transducer = Transducer(self.a.bytes, self.b.bytes)
        self.say_a, self.say_b = ({i: str(i) for i in x.bytes} for x in (self.a, self.b))
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.written: list[bytes] = []
        self.counts, self.links, self.first = array("q"), array("q"), array("q")  # three numbers a run; all links, and where a run's begin
        self.transducer.steps.clear()

    def _add(self, run: str, a: list[int], b: list[int] | None) -> None:
        ends = self.transducer.groups(a, b) if b is not None else None
        if ends is None:
            self.known[run] = -1
            return
        say_a, say_b, links = self.say_a, self.say_b, self.links
        self.first.append(len(links))
        i = j = 0
        parts = []
        for k, m in ends:
            if k - i == 1 and m - j == 1:
                parts.append(say_a[a[i]] + "|" + say_b[b[j]])
            else:
                parts.append(",".join([say_a[x] for x in a[i:k]]) + "|" + ",".join([say_b[x] for x in b[j:m]]))
            links.append(a[k - 1] << 20 | b[m - 1])
            i, j = k, m
        self.known[run] = len(self.written)
        self.written.append(";".join(parts).encode())
        self.counts.extend((len(a), len(b), len(ends)))

    def learn(self, runs) -> None:
        if len(self.known) > REMEMBERED:
            self.clear()
        new = [r for r in runs if r not in self.known]
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            for r, b in zip(some, self.b.encode_many(some)):
                self._add(r, self.a.encode(r), b)

    def whole(self, text: str) -> int:
        """A text as one run: where its parts did not tell."""
        key = "\0" + text
        if key not in self.known:
            self._add(key, self.a.encode(" " + text), self.b.model.encode(text))
        return self.known[key]

    def split(self, whole: list[str]) -> list[np.ndarray]:
        """The numbers of each text's runs; none where it has no tokens."""
        if not self.b.parts:
            return [np.array([n] if t and (n := self.whole(t)) >= 0 else [], np.int64) for t in whole]
        runs = [self.b.runs(" " + t) if t else [] for t in whole]
        self.learn(set().union(*runs))
        known, out = self.known.__getitem__, []
        for t, r in zip(whole, runs):
            ids = np.fromiter(map(known, r), np.int64, len(r))
            if len(ids) and ids.min() < 0:
                ids = np.array([n] if (n := self.whole(t)) >= 0 else [], np.int64)
            out.append(ids)
        return out


@functools.lru_cache(maxsize=1)
def remembered(path_a: str, path_b: str) -> Aligner:
    """The memory of this worker process, which later tasks of the same operator find filled."""
    return Aligner(path_a, path_b)


memory(remembered.cache_clear, "pagemill.llm.align")


def possible_pairs(a: dict[int, bytes], b: dict[int, bytes]) -> int:
    """How many pairs of ids can end together: one's bytes are an end of the other's."""
    from collections import Counter

    def ends(one: dict[int, bytes], other: dict[int, bytes], strict: bool) -> int:
        n = Counter(other.values())
        return sum(n[x[k:]] for x in one.values() for k in range(1 if strict else 0, len(x)))

    return ends(a, b, False) + ends(b, a, True)


SLICE = "doc_ids array<long>, n_a binary, n_b binary, n_groups binary, digests array<string>, pairs binary, times binary, run_links binary, link_places binary, lengths binary, runs binary"


def squeeze(x, kind) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(x, kind).tobytes())


def unsqueeze(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind)


def sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of these lengths."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def aligned(docs: DataFrame, path_a: str, path_b: str, rows_of_slice: int = 2000) -> DataFrame:
    """A row for each slice of texts: digests and token numbers of the texts, their runs, the links of the runs, and how often each id pair is linked."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        aligner = remembered(path_a, path_b)
        for b in slices(batches, rows_of_slice):
            split = aligner.split(texts(b.column("text")))
            lengths = np.array([len(x) for x in split])
            numbers, runs = np.unique(np.concatenate([np.zeros(0, np.int64), *split]), return_inverse=True)
            counts = np.array(aligner.counts, np.int64).reshape(-1, 3)[numbers]
            n_links = counts[:, 2]
            at = np.repeat(np.array(aligner.first, np.int64)[numbers] - np.cumsum(n_links) + n_links, n_links) + np.arange(n_links.sum())
            pairs, places = np.unique(np.array(aligner.links, np.int64)[at], return_inverse=True)
            often = np.repeat(np.bincount(runs, minlength=len(numbers)), n_links)
            times = np.bincount(places, often, len(pairs)).astype(np.int64)
            say = aligner.written
            digests = [hashlib.sha256(b";".join([say[i] for i in x.tolist()])).hexdigest() if len(x) else "" for x in split]
            n = [sums(counts[runs, k], lengths) for k in range(3)]
            out = {"doc_ids": [b.column("doc_id").to_pylist()], "digests": [digests], "pairs": [squeeze(np.diff(pairs, prepend=0), "<i8")], "times": [squeeze(times, "<u4")], "run_links": [squeeze(n_links, "<u4")], "link_places": [squeeze(places, "<u4")], "lengths": [squeeze(lengths, "<u4")], "runs": [squeeze(runs, "<u4")]}
            yield out | {k: [squeeze(x, "<u4")] for k, x in zip(("n_a", "n_b", "n_groups"), n)}

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), rows, SLICE, large=True)


def pair_counts(made: DataFrame) -> DataFrame:
    """pair (A id << 20 | B id), n: in how many links of all texts two ids are linked. A task sums its slices before they are shuffled."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            pairs, at = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
            total = np.zeros(len(pairs), np.int64)
            np.add.at(total, at, np.concatenate([n for _, n in held]))
            return pairs, total

        for b in batches:
            for p, n in zip(b.column("pairs").to_pylist(), b.column("times").to_pylist()):
                held.append((np.cumsum(unsqueeze(p, "<i8")), unsqueeze(n, "<u4").astype(np.int64)))
                if len(held) >= 16:
                    held = [merged()]
        if held:
            pairs, n = merged()
            yield {"pair": pairs, "n": n}

    return map_arrow(made.select("pairs", "times"), rows, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The contract's row for each text."""
    spark = docs.sparkSession
    made = written(aligned(docs, path_a, path_b), "aligned", "zstd")
    bound = possible_pairs(ByteLevel(path_a).bytes, SpacePieces(path_b).bytes)
    got = pair_counts(made).limit(bound + 1).toPandas().sort_values("pair")  # a statistic of the two vocabularies, not of the texts
    if len(got) > bound:
        raise ValueError(f"more than the {bound} id pairs that can end together")
    pairs, total = got["pair"].to_numpy(np.int64), got["n"].to_numpy(np.int64)
    most: dict[int, int] = {}
    for b, n in zip((pairs & 0xFFFFF).tolist(), total.tolist()):
        most[b] = max(n, most.get(b, 0))
    best = total == np.array([most[b] for b in (pairs & 0xFFFFF).tolist()], np.int64) if len(got) else np.zeros(0, bool)
    shared = spark.sparkContext.broadcast((pairs, total, best))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known, total, best = shared.value
        for b in batches:
            for r in b.to_pylist():
                at = np.searchsorted(known, np.cumsum(unsqueeze(r["pairs"], "<i8")))
                links, places = unsqueeze(r["run_links"], "<u4").astype(np.int64), at[unsqueeze(r["link_places"], "<u4")]
                lengths, runs = unsqueeze(r["lengths"], "<u4").astype(np.int64), unsqueeze(r["runs"], "<u4")
                by_run = {"n_best": sums(best[places].astype(np.int64), links), "count_sum": sums(total[places], links)}
                out = {k: unsqueeze(r[k], "<u4").astype(np.int64) for k in ("n_a", "n_b", "n_groups")} | {k: sums(x[runs], lengths) for k, x in by_run.items()}
                yield {"doc_id": r["doc_ids"], "n_links": out["n_groups"], "groups_sha256": r["digests"]} | out

    return map_arrow(made, rows, RESULT, large=True)
