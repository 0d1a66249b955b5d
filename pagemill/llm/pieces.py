"""SentencePiece encoding and decoding by suffix-array matching.

A text is cut wherever two neighbouring characters stand together in no piece, as
no merge crosses there. The distinct segments of a batch of texts are laid end to end and a suffix
array of that text is built to the depth of the longest piece. All pieces are
searched in it at once by bisection; each gives the range of its occurrences.
The occurrences are the edges of one lattice; sorted by position they are relaxed
from left to right.

The model at hand merges pairs by rank (it is of kind BPE), so the best path is not the
one of largest summed score. A path is the library's result exactly if each
piece in it encodes to itself and no two neighbours would have merged otherwise;
there is one such path, and every prefix of it is the result of that prefix. So
relaxing takes an edge if its piece goes with the piece that ends where it starts,
the longest first, and gives up a place for good if no edge leads on from it.

Characters that no piece holds become byte pieces.

Defined results: a null text counts as empty and gives no pieces; decoding gives
back the text (a leading space mark is the encoder's own); rows are independent;
a null doc_id stays null; a text that holds the space mark itself decodes to a blank
there, so its round_trip is false; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.base import map_arrow, memory, slices, texts

SPACE = "▁"
#: Segments that a worker remembers at most; beyond that it starts anew.
REMEMBERED = 800_000


class Vocabulary:
    """Pieces of a model file, how each splits into the two it was merged from, and which may stand side by side."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.id = {self.pieces[i]: i for i in plain}
        self.rank = {i: -sp.get_score(i) for i in plain}
        self.halves: dict[int, tuple[int, int]] = {}
        self.usable = []
        for i in plain:
            parts = self._merge(self.pieces[i])
            if parts is not None:
                self.usable.append(i)
                if len(parts) == 2:
                    self.halves[i] = (parts[0], parts[1])
        # classes of characters as the first and as the second of two inside a piece, and which classes meet
        pairs = sorted({(x, y) for p in self.id for x, y in zip(p, p[1:])})
        left, right = sorted({x for x, _ in pairs}), sorted({y for _, y in pairs})
        self.as_first, self.as_second = np.zeros(0x110000, np.uint16), np.zeros(0x110000, np.uint16)
        self.as_first[[ord(c) for c in left]] = np.arange(1, len(left) + 1)
        self.as_second[[ord(c) for c in right]] = np.arange(1, len(right) + 1)
        self.inside = np.zeros((len(left) + 1, len(right) + 1), bool)
        for x, y in pairs:
            self.inside[self.as_first[ord(x)], self.as_second[ord(y)]] = True
        self.depth = max((len(self.pieces[i]) for i in self.usable), default=1)
        self.goes: dict[int, bool] = {}

    def _merge(self, s: str) -> tuple | None:
        """The last two symbols before ``s`` is whole when pairs merge by rank; () for one character, None if it never gets whole."""
        parts = list(s)
        if len(parts) == 1:
            return ()
        while len(parts) > 1:
            ranked = [(self.rank[self.id[x + y]], k) for k, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in self.id]
            if not ranked:
                return None
            k = min(ranked)[1]
            if len(parts) == 2:
                if parts[0] not in self.id or parts[1] not in self.id:
                    return None
                return self.id[parts[0]], self.id[parts[1]]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return None

    def side_by_side(self, left: int, right: int) -> bool:
        """Whether merging by rank leaves these two pieces as they are: no pair of symbols across the border merges before the symbols themselves are part of something larger."""
        key = left << 20 | right
        known = self.goes.get(key)
        if known is not None:
            return known
        rank, pieces, ids = self.rank, self.pieces, self.id
        a, b, ok = left, right, True
        until_a = until_b = float("inf")  # the rank at which a, or b, is used up by a merge on its own side
        while True:
            both = ids.get(pieces[a] + pieces[b])
            if both is not None:
                r = rank[both]
                # it would merge before a goes into its parent; on a tie the left merge comes first
                if r < until_a and r <= until_b:
                    ok = False
                    break
            made_a, made_b = (rank[x] if x in self.halves else -1 for x in (a, b))
            if made_a < 0 and made_b < 0:
                break
            # step back over the merge that came last; of two of one rank the right one
            if made_a > made_b:
                until_a, a = made_a, self.halves[a][1]
            else:
                until_b, b = made_b, self.halves[b][0]
        self.goes[key] = ok
        return ok


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by what follows them, to this depth, by doubling the length the ranks stand for."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1
    order = np.argsort(rank, kind="stable")
    length = 1
    while length < depth and n:
        second = np.zeros(n, np.int64)
        second[: max(n - length, 0)] = rank[length:]
        key = rank * (int(rank.max()) + 1) + second
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[1], (sorted_key[1:] != sorted_key[:-1]).astype(np.int64)]))
        length *= 2
    return order


def occurrence_ranges(text: np.ndarray, order: np.ndarray, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each pattern (a row of code points, padded) the first and the last but one place of its suffixes; all bisections run side by side."""
    n, depth = len(order), patterns.shape[1]
    padded = np.concatenate([text, np.full(depth, -1, text.dtype)])

    def bisect(after: bool) -> np.ndarray:
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), n, np.int64)
        for _ in range(max(1, int(n).bit_length()) + 1):
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) >> 1
            start = order[mid]
            sign, todo = np.zeros(len(open_), np.int8), np.arange(len(open_))
            for k in range(depth):  # compare a character at a time, only where all before were equal
                todo = todo[lengths[open_[todo]] > k]
                if not len(todo):
                    break
                have, want = padded[start[todo] + k], patterns[open_[todo], k]
                sign[todo] = np.sign(have.astype(np.int64) - want)
                todo = todo[have == want]
            go = sign < 0 if not after else sign <= 0
            low[open_[go]] = mid[go] + 1
            high[open_[~go]] = mid[~go]
        return low

    return bisect(False), bisect(True)


def encode_segments(segments: list[str], vocabulary: Vocabulary) -> list[list[int]]:
    """Ids of each segment, by one lattice over all of them."""
    if not segments:
        return []
    joined = "\U0010ffff".join(segments)
    text = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    order = suffix_array(text, vocabulary.depth)
    usable = np.array(vocabulary.usable)
    lengths = np.array([len(vocabulary.pieces[i]) for i in vocabulary.usable])
    patterns = np.zeros((len(usable), vocabulary.depth), np.int64)
    for row, i in enumerate(vocabulary.usable):
        patterns[row, : lengths[row]] = [ord(c) for c in vocabulary.pieces[i]]
    first, end = occurrence_ranges(text, order, patterns, lengths)
    times = end - first
    which = np.repeat(np.arange(len(usable)), times)
    at = order[np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first, times)]
    by_position = np.argsort(at * (vocabulary.depth + 1) + vocabulary.depth - lengths[which], kind="stable")  # the longest first
    edge_at = at[by_position]
    edge_piece = usable[which][by_position].tolist()
    edge_end = (edge_at + lengths[which][by_position]).tolist()
    first_edge = np.searchsorted(edge_at, np.arange(len(text) + 1)).tolist()

    out: list[list[int]] = []
    start = 0
    for s in segments:
        stop = start + len(s)
        out.append(relax(joined, start, stop, first_edge, edge_end, edge_piece, vocabulary))
        start = stop + 1
    return out


def relax(joined: str, start: int, stop: int, first_edge: list[int], edge_end: list[int], edge_piece: list[int], vocabulary: Vocabulary) -> list[int]:
    """The one path from start to stop. The pieces taken so far are always the result of their own text,
    so a place from which no edge goes on is no border of the whole result and is not entered again."""
    goes, check, single = vocabulary.goes, vocabulary.side_by_side, vocabulary.id
    taken: list[tuple[int, int, int]] = []  # where a piece starts, the piece, its edge
    dead: set[int] = set()
    p, before, e = start, -1, first_edge[start]
    while p < stop:
        last = first_edge[p + 1]
        while e < last:
            to = edge_end[e]
            if to <= stop and to not in dead:
                piece = edge_piece[e]
                if before < 0:
                    break
                ok = goes.get(before << 20 | piece)
                if ok or ok is None and check(before, piece):
                    break
            e += 1
        else:
            if joined[p] not in single and p + 1 not in dead:  # no piece holds this character: bytes, with which nothing merges
                taken.append((p, -2, last))
                p, before = p + 1, -2
                e = first_edge[p]
                continue
            dead.add(p)
            p, _, e = taken.pop()
            before = taken[-1][1] if taken else -1
            e += 1
            continue
        taken.append((p, piece, e))
        p, before = to, piece
        e = first_edge[p]
    ids: list[int] = []
    for at, piece, _ in taken:
        if piece >= 0:
            ids.append(piece)
        else:
            ids.extend(vocabulary.bytes[x] for x in joined[at].encode("utf-8", "replace"))
    return ids


def segments_of(whole: list[str], vocabulary: Vocabulary) -> list[list[str]]:
    """The segments of each text, which begins with a space mark of its own."""
    marked = [SPACE + t.replace(" ", SPACE) if t else "" for t in whole]
    joined = "\n".join(marked)
    if not joined:
        return [[] for _ in whole]
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    begin = np.cumsum([0] + [len(t) + 1 for t in marked])
    border = np.ones(len(code) + 2, bool)
    border[1 : len(code)] = ~vocabulary.inside[vocabulary.as_first[code[:-1]], vocabulary.as_second[code[1:]]]
    border[begin[:-1]] = border[begin[1:] - 1] = True  # texts and the line ends between them stand alone
    border[len(code) + 1] = False
    cut = np.flatnonzero(border)
    edges = cut.tolist()
    parts = [joined[a:b] for a, b in zip(edges, edges[1:])]
    first, last = np.searchsorted(cut, begin[:-1]).tolist(), np.searchsorted(cut, begin[1:] - 1).tolist()
    return [parts[a:b] for a, b in zip(first, last)]


class Encoder:
    """Remembers the segments it has met, up to a bound, with their ids as bytes."""

    def __init__(self, path: str):
        self.vocabulary, self.known = Vocabulary(path), {}
        v = self.vocabulary
        back = {i: bytes([x]) for x, i in v.bytes.items()}
        self.plain = [back[i] if i in back else p.encode() for i, p in enumerate(v.pieces)]

    def learn(self, segments) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
            self.vocabulary.goes.clear()
        new = [s for s in segments if s not in self.known]
        for at in range(0, len(new), 100_000):
            some = new[at : at + 100_000]
            for s, ids in zip(some, encode_segments(some, self.vocabulary)):
                self.known[s] = np.array(ids, "<u4").tobytes()

    def encode(self, whole: list[str]) -> list[np.ndarray]:
        split = segments_of(whole, self.vocabulary)
        self.learn(set().union(*split))
        return [np.frombuffer(b"".join(map(self.known.__getitem__, x)), "<u4") for x in split]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.plain.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(SPACE, " ")[1:]


@functools.lru_cache(maxsize=2)
def remembered(path: str) -> Encoder:
    """The memory of this worker process, which later tasks of the same operator find filled."""
    return Encoder(path)


memory(remembered.cache_clear, "pagemill.llm.pieces")


def encode_documents(docs: DataFrame, path: str, keep_ids: bool = True) -> DataFrame:
    """doc_id, n_chars, n_pieces, the checksum of the ids (32-bit, little-endian), whether decoding all its ids gives the text back, and the ids, unless not asked for."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encoder = remembered(path)
        for b in slices(batches, 1000):
            whole = texts(b.column("text"))
            split = segments_of(whole, encoder.vocabulary)
            encoder.learn(set().union(*split))
            known = encoder.known
            ids = [b"".join(map(known.__getitem__, x)) for x in split]
            flat = np.frombuffer(b"".join(ids), "<i4")
            ends = np.cumsum([0] + [len(x) // 4 for x in ids])
            same = [encoder.decode(flat[i:j]) == t for i, j, t in zip(ends, ends[1:], whole)]
            out = {"doc_id": b.column("doc_id"), "n_chars": [len(t) for t in whole], "n_pieces": np.diff(ends), "ids_crc32": [zlib.crc32(x) for x in ids], "round_trip": same}
            yield out | ({"ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))} if keep_ids else {})

    schema = "doc_id long, n_chars long, n_pieces long, ids_crc32 long, round_trip boolean" + (", ids array<int>" if keep_ids else "")
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), rows, schema)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with ids; null ids give empty text, unknown ids are left out."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encoder = remembered(path)
        for b in slices(batches, 1000):
            lists = [[i for i in x or [] if i is not None and 0 <= i < len(encoder.plain)] for x in b.column("ids").to_pylist()]
            yield {"doc_id": b.column("doc_id"), "text": [encoder.decode(np.array(x, np.int64)) for x in lists]}

    return map_arrow(encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids"), rows, "doc_id long, text string")
