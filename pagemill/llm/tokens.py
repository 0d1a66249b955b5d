"""Token counts of whole texts, and the memory of pre-tokens they rest on.

The tokenizer's normalizer and splitter treat every run between ASCII white space
on its own, so such a run is the pre-token here: the library encodes each
distinct one once, and a text's tokens are those of its runs in order.

Counting joins a text's pre-token frequencies to the piece counts and sums the
products; no ids are made for the sum. The join stays inside a task: a shuffle
of (document, pre-token) pairs would move more bytes than the texts have.

Defined results: a null text counts as empty and has 0 tokens; special strings
inside texts are what the library makes of them; a null doc_id stays null; rows
are independent, so copies and ties give equal rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import os
import re
from collections import Counter
from collections.abc import Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.base import WORD, map_arrow, memory, slices, texts

#: Runs of a generation; a worker remembers two at most, and what it meets again moves to the younger one.
REMEMBERED = 600_000
#: Runs of printable ASCII and of Latin-1 letters, none of which the normalizer composes, and how the splitter takes them apart in lower case.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
MARK = "\x01"


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


class Memory:
    """A map of bounded size that forgets what has not been met for long."""

    def __init__(self):
        self.now, self.old = {}, {}

    def unknown(self, keys) -> list:
        """Keys that are in neither generation; all others are in the younger one after this."""
        if len(self.now) > REMEMBERED:
            self.old, self.now = self.now, {}
        now, get, out = self.now, self.old.get, []
        for k in keys:
            if k not in now:
                v = get(k)
                if v is None:
                    out.append(k)
                else:
                    now[k] = v
        return out


class Pieces:
    """What the tokenizer gives for each run: how many ids, or the ids as bytes.

    A plain run is split here as the tokenizer does, so that forms
    that differ in case or punctuation share their parts; distinct parts are
    encoded many at a time with a mark between them. Any other run, and any that
    may hold a special string, goes to the library as it is.
    """

    def __init__(self, path: str, ids: bool = False):
        self.ids, self.tokenizer = ids, load(path)
        self.runs, self.parts = Memory(), Memory()
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 and self._splits_alike() else None

    def _splits_alike(self) -> bool:
        """Whether this tokenizer's splitter is the one that SPLIT stands for."""
        probe = "It's we've I'd THE'LL a1b22 x--y!? 'tis ''s #'re Äh ßÉÿ1"
        mine = [x for w in WORD.findall(probe) for x in SPLIT.findall(w.lower())]
        one = self.tokenizer.encode(probe, add_special_tokens=False).ids
        return one == [i for e in self.tokenizer.encode_batch(mine, add_special_tokens=False) for i in e.ids]

    def __getitem__(self, run: str):
        return self.runs.now[run]

    def _value(self, ids):
        return np.asarray(ids, "<u4").tobytes() if self.ids else len(ids)

    def _encode_parts(self, new: list[str]) -> None:
        for at in range(0, len(new), 8192):
            some = new[at : at + 8192]
            lines = [f" {MARK} ".join([*some[k : k + 256], ""]) for k in range(0, len(some), 256)]
            ids = np.concatenate([np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)])
            ends = np.flatnonzero(ids == self.mark)
            starts = np.concatenate([[0], ends[:-1] + 1])
            if self.ids:
                raw = ids.tobytes()
                self.parts.now.update((w, raw[4 * a : 4 * b]) for w, a, b in zip(some, starts.tolist(), ends.tolist()))
            else:
                self.parts.now.update(zip(some, (ends - starts).tolist()))

    def learn(self, words) -> dict:
        """The younger generation of runs, in which all these words are now."""
        new = self.runs.unknown(words)
        now = self.runs.now
        easy = PLAIN.fullmatch if self.mark is not None else lambda w: None
        plain = [w for w in new if easy(w) and "<|" not in w]
        other = list(set(new).difference(plain)) if len(plain) < len(new) else []
        split = [SPLIT.findall(w.lower()) for w in plain]
        self._encode_parts(self.parts.unknown({x for s in split for x in s}))
        parts = self.parts.now
        if self.ids:
            now.update((w, parts[s[0]] if len(s) == 1 else b"".join([parts[x] for x in s])) for w, s in zip(plain, split))
        else:
            now.update((w, sum([parts[x] for x in s])) for w, s in zip(plain, split))
        for at in range(0, len(other), 4096):
            some = other[at : at + 4096]
            for w, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                now[w] = self._value(e.ids)
        return now


@functools.lru_cache(maxsize=2)
def remembered(path: str, ids: bool) -> Pieces:
    """The memory of this worker process, which later tasks of the same operator find filled."""
    return Pieces(path, ids)


memory(remembered.cache_clear, "pagemill.llm.tokens", "pagemill.llm.packing")


def count_tokens(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and n_pretokens of each text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        pieces = remembered(path, False)
        for b in slices(batches, 500):
            whole = texts(b.column("text"))
            often = [Counter(WORD.findall(t)) for t in whole]
            known = pieces.learn(set().union(*often))
            n = [sum(map(mul, c.values(), map(known.__getitem__, c))) for c in often]
            yield {"doc_id": b.column("doc_id"), "n_bytes": [len(t.encode()) for t in whole], "n_tokens": n, "over_limit": [x > limit for x in n], "n_pretokens": [len(c) for c in often]}

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), rows, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_pretokens long")
