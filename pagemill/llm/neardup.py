"""Similarity join of word five-grams with a MinHash LSH forest and exact verification.

Texts with the same set of word shingles form one class, whose least doc_id
stands for it. Each class has a label in every tree of the forest: its first
``DEEPEST`` MinHash values, a byte of each, one after another. All labels of a tree,
sorted, are a prefix tree: classes whose labels share a prefix stand together.

Candidates are first the classes that share a whole label. The prefix they must share is then
shortened as the data ask for it: the components of the candidates are verified in full; each link found,
of similarity s, would be met at depth d with the probability p_d(s), so with it 1 / p_d(s) - 1 others
are to be expected that were not met. The depth goes down, to the deepest at which
the links known so far promise the wanted recall, until the present depth promises it; only pairs that come new are compared then.
So corpora whose copies are close stop at whole labels, others go on.

The components of the candidate graph are dealt out in blocks, and each two blocks of a component are
compared in full: exact intersections by products of incidence matrices. So each
link is counted exactly once, and no pair leaves the task that verified it. Tasks give counts of links
for each class and a spanning forest of the links, whose components are the classes of near duplicates.

Defined results: words are runs of other than the six ASCII white-space
characters; a text of one to four words has one shingle, all its words; texts
without a word, and null texts, have no links; rows without doc_id stay apart, with no class; copies
and repeated rows link to each other; other columns are ignored; an empty table gives no rows. A column
n_links counts the other documents whose similarity is at least the wanted one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.base import map_arrow, slices, texts, written
from pagemill.llm.graph import components

TREES, DEEPEST = 48, 7
#: Labels that begin alike to this depth meet in one task; only if the prefix must be shorter are they dealt out anew.
FLOOR = 5
BLOCK = 200
REMEMBERED = 500_000
U = np.uint64


def met(similarity: np.ndarray, depth: int, trees: int = TREES) -> np.ndarray:
    """The probability that two classes of this similarity share a prefix of this depth in some tree. A byte may be equal by chance."""
    return 1 - (1 - (similarity + (1 - similarity) / 256) ** depth) ** trees


def depth_for(links: float, expected: list[float], recall: float) -> int:
    """The deepest prefix that promises the recall: of links found, and those that a depth of 1, 2, ... lets expect beside them."""
    for depth in range(len(expected), 1, -1):
        if links >= recall * (links + expected[depth - 1]):
            return depth
    return 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Shingles:
    """64-bit hashes of a text's distinct word n-grams, sorted."""

    def __init__(self, n: int = 5):
        self.n, self.known = n, {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").split()  # bytes split at the six ASCII characters
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(self.n, len(h))
        m = len(h) - n + 1
        code = np.full(m, n, np.uint64)
        for k in range(n):
            code = mixed(code + h[k : k + m])
        return np.unique(code)


class Forest:
    """Labels of sets: for each tree its number, and a byte of each of its MinHash values, as one integer, so that sorting sorts prefixes."""

    def __init__(self, trees: int = TREES, deepest: int = DEEPEST, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.trees, self.deepest = trees, deepest
        n = trees * deepest
        self.times = rng.integers(0, 2**63, n, dtype=np.uint64) * U(2) + U(1)
        self.plus = rng.integers(0, 2**63, n, dtype=np.uint64)

    def __call__(self, s: np.ndarray) -> np.ndarray:
        least = np.full(len(self.times), 2**64 - 1, np.uint64)
        for at in range(0, len(s), 1024):  # a bounded matrix, also for very long texts
            np.minimum(least, (s[None, at : at + 1024] * self.times[:, None] + self.plus[:, None]).min(1), out=least)
        values = (mixed(least) >> U(56)).reshape(self.trees, self.deepest)
        label = np.arange(self.trees, dtype=np.uint64)
        for k in range(self.deepest):
            label = (label << U(8)) | values[:, k]
        return label.view(np.int64)  # no tree number reaches the sign


def signatures(docs: DataFrame, n: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, columns of longs that go along, two halves of the set's fingerprint, labels; texts without words are left out."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        shingles, forest = Shingles(n), Forest()
        for b in slices(batches, 1000):
            ids, first, second, labels, where = [], [], [], [], []
            for at, (doc, text) in enumerate(zip(b.column("doc_id").to_pylist(), texts(b.column("text")))):
                s = shingles(text)
                if len(s):
                    where.append(at)
                    h1, h2 = fingerprint(s)
                    ids.append(doc), first.append(h1), second.append(h2), labels.append(forest(s))
            flat = pa.array(np.concatenate(labels) if labels else np.zeros(0, np.int64))
            yield {"doc_id": ids, "h1": first, "h2": second, "labels": pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * TREES), flat)} | {c: b.column(c).take(pa.array(where, pa.int64())) for c in extra}

    return map_arrow(docs, rows, "doc_id long, " + "".join(f"{c} long, " for c in extra) + "h1 long, h2 long, labels array<long>", large=True)


def run_roots(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows sorted by key and node: which begin a run of one key, and the first node of each row's run."""
    starts = np.concatenate([[True], key[1:] != key[:-1]])
    return starts, node[np.maximum.accumulate(np.where(starts, np.arange(len(key)), 0))]


def trie(classes: DataFrame, floor: int) -> DataFrame:
    """a, b, depth: the prefix trees from ``floor`` down, as edges. At each depth the classes that share a prefix hang on the
    first of their run of sorted labels; an edge stands at the deepest depth that makes it.

    A batch is sorted and its equal labels are joined before the shuffle, so that of a label only one row for each batch moves,
    however many classes share it; the edges made so far ride along, dealt out by their node."""

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            if not b.num_rows:
                continue
            key = b.column("labels").flatten().to_numpy()
            node = np.repeat(b.column("h1").to_numpy(), TREES)
            order = np.lexsort((node, key))
            key, node = key[order], node[order]
            starts, root = run_roots(key, node)
            other = root != node
            edge = np.unique(np.stack([node[other], root[other]], 1), axis=0)
            roots = np.concatenate([np.zeros(int(starts.sum()), np.int64), edge[:, 1]])
            yield {"label": np.concatenate([key[starts], edge[:, 0]]), "node": np.concatenate([node[starts], edge[:, 0]]), "root": pa.array(roots, mask=np.arange(len(roots)) < int(starts.sum()))}

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        last: dict[int, tuple[int, int]] = {}  # of each depth the prefix and the first node of the run that may go on in the next batch
        for b in batches:
            made = b.filter(b.column("root").is_valid())
            yield {"a": made.column("node"), "b": made.column("root"), "depth": np.full(made.num_rows, DEEPEST, np.int32)}
            b = b.filter(b.column("root").is_null())
            if not b.num_rows:
                continue
            label, node = b.column("label").to_numpy(), b.column("node").to_numpy()
            below = node
            for depth in range(DEEPEST, floor - 1, -1):
                key = label >> (8 * (DEEPEST - depth))
                _, root = run_roots(key, node)
                if depth in last and key[0] == last[depth][0]:
                    root = np.where(key == key[0], last[depth][1], root)
                other = root != below  # a run within a run hangs on it by its own root
                pairs = np.unique(np.stack([below[other], root[other]], 1), axis=0)
                yield {"a": pairs[:, 0], "b": pairs[:, 1], "depth": np.full(len(pairs), depth, np.int32)}
                last[depth] = key[-1], root[-1]
                below = root

    spread = map_arrow(classes.select("h1", "labels"), collapse, "label long, node long, root long")
    dealt = spread.repartition(F.when(F.col("root").isNull(), F.shiftright("label", 8 * (DEEPEST - floor))).otherwise(F.col("node")))
    return map_arrow(dealt.sortWithinPartitions("label", "node"), runs, "a long, b long, depth int").groupBy("a", "b").agg(F.max("depth").alias("depth"))


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, from products of the incidence matrix, some shingles at a time."""
    d = len(sets)
    out = np.zeros((d, d), np.float64)
    owner = np.repeat(np.arange(d), [len(s) for s in sets])
    value, which = np.unique(np.concatenate(sets), return_inverse=True)
    often = np.bincount(which, minlength=len(value)) > 1
    number = np.cumsum(often) - 1
    keep = often[which]
    which, owner = number[which[keep]], owner[keep]
    order = np.argsort(which, kind="stable")
    which, owner = which[order], owner[order]
    n, step = int(often.sum()), 4096
    for a in range(0, n, step):
        lo, hi = np.searchsorted(which, [a, a + step])
        m = np.zeros((min(step, n - a), d), np.float32)
        m[which[lo:hi] - a, owner[lo:hi]] = 1
        out += m.T @ m
    return out


def linked(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs reach the similarity, and the similarities."""
    size = np.array([len(s) for s in sets], np.float64)
    both = intersections(sets)
    union = size[:, None] + size[None, :] - both
    out = both >= similarity * union - 1e-9
    np.fill_diagonal(out, False)
    return out, both / union


def spanning(node: np.ndarray, link: np.ndarray) -> np.ndarray:
    """For each class the least class that its links lead to."""
    root = node.copy()
    while True:
        near = np.where(link, root[None, :], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max)
        new = np.minimum(root, near)
        if (new == root).all():
            return root
        root = new


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8").tolist())


def verified(candidates: DataFrame, n: int, similarity: float) -> DataFrame:
    """node, links (documents), root: of each two blocks of a component, for pairs whose parts differ. Rows stand sorted by component, blocks and node;
    a row whose text is not that of its node (its id stands for several texts) is passed over. A row without node has what the links
    let expect: their number, and for each depth how many more there should be."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        shingles = Shingles(n)
        key, held = None, []

        def close() -> Iterator[dict]:
            if len(held) < 2:
                return
            node, block, part = (np.array([h[k] for h in held]) for k in (0, 1, 4))
            copies = np.array([h[2] for h in held])
            link, how = linked([h[3] for h in held], similarity)
            link &= part[:, None] != part[None, :]
            if key[1] != key[2]:
                link &= block[:, None] != block[None, :]
            some = link.any(1)
            if some.any():
                k = int(some.sum())
                yield {"node": node[some], "links": (link @ copies)[some], "root": spanning(node, link)[some], "expected": [None] * k}
                s = how[np.triu(link)]
                yield {"node": [None], "links": [len(s)], "root": [None], "expected": [[float((1 / met(s, d) - 1).sum()) for d in range(1, DEEPEST + 1)]]}

        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("comp", "lo", "hi", "node", "h2", "block", "copies", "part", "text")]
            for comp, lo, hi, node, h2, block, copies, part, text in zip(*cols):
                if (comp, lo, hi) != key:
                    if key is not None:
                        yield from close()
                    key, held = (comp, lo, hi), []
                if held and held[-1][0] == node:
                    continue
                s = shingles(text)
                if fingerprint(s) == (node, h2):
                    held.append((node, block, copies, s, part))
        if key is not None:
            yield from close()

    return map_arrow(candidates, rows, "node long, links long, root long, expected array<double>", large=True)


def compared(known: DataFrame, members: DataFrame, n: int, similarity: float) -> DataFrame:
    """What ``verified`` finds in components: members have node, h2, rep, copies, comp and part."""
    sizes = members.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    members = written(members.join(sizes, "comp").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "members")
    few = members.limit(200_001).count() <= 200_000  # 14 MB at most; beyond it the texts are shuffled to their rows
    first = known.join(F.broadcast(members) if few else members, F.col("doc_id") == F.col("rep"))
    pairs = first.select("node", "h2", "comp", "copies", "part", "block", "blocks", "text", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    lo, hi = F.least("block", "other"), F.greatest("block", "other")
    # the pairs of blocks of a component go round the partitions, so that no two meet by chance while others idle
    parts = int(known.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    turn = F.pmod(F.xxhash64("comp") % 1_000_000_007 + lo * F.col("blocks") - F.floor(lo * (lo + 1) / 2) + hi, F.lit(parts)).cast("int")
    pairs = pairs.select("comp", lo.alias("lo"), hi.alias("hi"), "node", "h2", "block", "copies", "part", "text", turn.alias("turn"))
    pairs = pairs.repartitionById(parts, F.col("turn")).drop("turn").sortWithinPartitions("comp", "lo", "hi", "node")
    return written(verified(pairs, n, similarity), "links")


def all_links(known: DataFrame, classes: DataFrame, similarity: float, n: int, recall: float, depths: list[int] | None = None) -> DataFrame:
    """What ``verified`` finds at all depths that the recall asks for; ``depths`` takes them down."""
    own = classes.select(F.col("h1").alias("node"), "h2", "rep", "copies")
    floor, depth, above = FLOOR, DEEPEST, DEEPEST + 1
    edges = written(trie(classes, floor), "trie")
    found: DataFrame | None = None
    state: DataFrame | None = None  # node, root: the components compared so far
    while True:
        if depths is not None:
            depths.append(depth)
        if depth < floor:
            floor = 1
            edges = written(trie(classes, floor), "trie")
        new = edges.where((F.col("depth") >= depth) & (F.col("depth") < above)).select("a", "b")
        if state is not None:
            for c in "ab":
                new = new.join(state.select(F.col("node").alias(c), F.col("root").alias("_root")), c, "left").withColumn(c, F.coalesce("_root", c)).drop("_root")
        grown = components(new, "candidates")  # of nodes, and of roots of former components
        grown = grown.select(F.col("node").alias("part"), F.col("root").alias("comp"))
        if state is None:
            members = own.join(grown, F.col("node") == F.col("part"))
            state = written(members.select("node", F.col("comp").alias("root")), "state")
        else:
            members = own.join(state, "node", "left").withColumn("part", F.coalesce("root", "node")).drop("root").join(grown, "part")
            next_ = state.join(grown, F.col("root") == F.col("part"), "left").select("node", F.coalesce("comp", "root").alias("root"))
            state = written(next_.unionByName(members.where("node = part").select("node", F.col("comp").alias("root"))).distinct(), "state")
        more = compared(known, members.select("node", "h2", "rep", "copies", "comp", "part"), n, similarity)
        found = more if found is None else found.unionByName(more)
        sums = found.where("node is null").agg(F.sum("links"), *(F.sum(F.col("expected")[d]) for d in range(DEEPEST))).first()
        wanted = depth_for(float(sums[0] or 0), [float(x or 0) for x in sums[1:]], recall)
        if wanted >= depth:
            return found.where("node is not null")
        above, depth = depth, wanted


def similar(docs: DataFrame, similarity: float = 0.8, n: int = 5, recall: float = 0.999999) -> DataFrame:
    """doc_id, class_id (least doc_id of the group that links join), rep_id (least doc_id with the same shingles), n_links."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = grouped(docs, similarity, n, recall).select("doc_id", "class_id", F.col("rep").alias("rep_id"), "n_links")
    rest = docs.where("doc_id is null or not text rlike '[^\\\\x20\\\\x09-\\\\x0D]'").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("rep_id"), F.lit(0).cast("long").alias("n_links"))
    return own.unionByName(rest)


def grouped(docs: DataFrame, similarity: float, n: int, recall: float, extra: tuple[str, ...] = ()) -> DataFrame:
    """Of rows with doc_id and words: doc_id, the columns that go along, rep, class_id, n_links, and the group, by a number of its own."""
    known = docs.where("doc_id is not null")
    signed = written(signatures(known, n, extra), "signatures")
    classes = written(signed.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("labels").alias("labels")), "classes")
    # in the graph a class goes by half of its fingerprint
    found = all_links(known, classes, similarity, n, recall)
    links = found.groupBy(F.col("node").alias("h1")).agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "groups").withColumnRenamed("node", "h1")
    named = roots.join(classes.select("h1", "rep"), "h1").groupBy("root").agg(F.min("rep").alias("class_id"))
    judged = classes.select("h1", "h2", "rep", "copies").join(links, "h1", "left").join(roots.join(named, "root").select("h1", "root", "class_id"), "h1", "left")
    judged = judged.select("h1", "h2", "rep", F.coalesce("root", "h1").alias("group"), F.coalesce("class_id", "rep").alias("class_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return signed.select("doc_id", *extra, "h1", "h2").join(judged, ["h1", "h2"]).select("doc_id", *extra, "rep", "class_id", "n_links", "group")


def one_of_each(docs: DataFrame, similarity: float = 0.8, n: int = 5, recall: float = 0.999999) -> DataFrame:
    """The documents, of each group of near duplicates only one row, of the least id. All columns stay. A row goes by its
    id and the hash of its text, since an id may stand on several texts; of rows that repeat both one stays. Rows without
    an id all stay, and so do those without a word; an empty table gives an empty one."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    named = named.withColumn("print", F.xxhash64("text"))
    own = written(grouped(named, similarity, n, recall, ("print",)).select("doc_id", "print", "class_id", "group"), "groups-of-rows")
    least = own.where("doc_id = class_id").groupBy("group").agg(F.min("print").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    least = written(least, "least")
    several = own.where("doc_id = class_id").join(least, "group")
    gone = own.where("doc_id <> class_id").select("doc_id", "print").unionByName(several.where("print <> first").select("doc_id", "print"))
    again = written(several.where("print = first").groupBy("doc_id", "print").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", "print"), "repeated")
    gone = written(gone.unionByName(again), "dropped")
    row = docs.withColumns({"_id": F.col("doc_id").cast("long"), "_print": F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})

    def sent(rows: DataFrame) -> DataFrame:
        rows = rows.select(F.col("doc_id").alias("_id"), F.col("print").alias("_print"))
        return F.broadcast(rows) if rows.limit(500_001).count() <= 500_000 else rows  # 8 MB at most

    kept = row.join(sent(gone), ["_id", "_print"], "left_anti").select(docs.columns)
    if again.isEmpty():
        return kept
    one = row.join(sent(again), ["_id", "_print"], "left_semi").dropDuplicates(["_id", "_print"])
    return kept.unionByName(one.select(docs.columns))
