"""Toxicity by weak supervision.

Many simple voters look at a text: lexicons (fixed ones, and ones found in labelled rows) and patterns.
None is right on its own, and some say the same thing. A generative label model gives each voter its
accuracy and each voter one other that it depends on: P(y) * prod P(vote | vote of its parent, y), where the
parents form the tree of largest conditional mutual information. It is fitted by expectation-maximisation
to how often each combination of votes occurs in all texts; labels that may be used hold their rows fixed.
A linear classifier over words and beginnings of words is trained on the model's posterior
labels, and scores every text.

Texts are read twice: the labelled rows for their words, and all for votes and features, which are
written to the shared folder; all else works on those. The driver gets the terms of the lexicons (at most ``MAX_TERMS``),
counts of vote combinations (at most 3 * 2 ** number of voters), and a sample of
rows with their posterior labels for the classifier (at most ``MAX_ROWS``). Lexicons
come from at most ``MAX_LABELS`` labelled rows, those of least hash of the id.

Labels count only where the checksum of the id modulo 4 is not 2. Labels, language, source and id are no
inputs of votes or features.

Defined results: a null text counts as empty and is scored as a text without features; repeated rows
are scored alike; an id with labels of both kinds has none; a null doc_id is the checksum of no text (0), so it is not held out;
without usable labels the fixed lexicons and patterns alone decide what the classifier learns; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.base import crc_mod, map_arrow, slices, texts, written

MAX_LABELS, MAX_ROWS, MAX_TERMS = 40_000, 40_000, 20_000
WORD = re.compile(r"[^\W\d_]+")
STARTS = (3, 4, 5, 6, 7)

# Insults and slurs on persons, and rude words that also occur otherwise, in the languages of the corpus.
INSULTS = frozenset("""
idiot idiots moron morons loser losers scum stupid pathetic worthless disgusting bastard asshole bitch retard cretin imbecile scumbag dumbass jerk
depp trottel arschloch vollidiot schwachkopf dummkopf mistkerl abschaum hurensohn wichser
connard connasse salaud abruti imbécile crétin débile ordure minable
imbécil estúpido estúpida gilipollas cabrón pendejo escoria inútil
""".split())
RUDE = frozenset("""
trash clown garbage dumb shut hate ugly filthy damn hell crap shit fuck fucking
müll dreck scheiße scheisse hässlich dumm merde putain pute con nul mierda puta basura tonto payaso asco
""".split())
AIMED = re.compile(r"\b(?:you|your|youre|u|du|dich|dein|tu|toi|vous|eres|te)\b(?:\W+\w+){0,2}\W+(?:are|re|bist|es|un|an|a|ein|une|una)\b", re.I)
THREAT = re.compile(r"\b(?:kill|hurt|beat|destroy|kick)\s+(?:you|yourself|them)\b|\bgo\s+die\b|\bshut\s+up\b|\bget\s+lost\b|\bhalt\s+(?:die|s)\b|\bferme\s+la\b|\bcállate\b", re.I)
MASKED = re.compile(r"(?<!\w)[\w@$]*[@$013457*](?=[^\W\d_])[\w@$*]+|(?<!\w)[^\W\d_]+[@$013457*!](?=[\w*])[\w@$*]+")
UNMASK = [str.maketrans("@$013457!", f"aso{one}easti") for one in "il"]
SHOUT = re.compile(r"\b[^\W\d_a-zà-öø-ÿ]{2,}\b")
MARKS = re.compile(r"[!?]{2,}")

WORD_VOTERS = 6
VOTERS = [*(f"words {k}" for k in range(WORD_VOTERS)), "short beginnings", "long beginnings", "doubtful words", "insults", "rude words", "aimed", "threat", "masked", "shouting", "marks"]
V = {name: 1 << k for k, name in enumerate(VOTERS)}


def starts_of(word: str) -> list[str]:
    return [word[:n] + "-" for n in STARTS if len(word) > n]


def terms_of(text: str) -> set[str]:
    """Words of a text in small letters, and their beginnings, which end with a hyphen, and with 2 or 4 after it if so many different words of the text have them."""
    words = set(WORD.findall(text.lower()))
    starts = Counter([w[:n] + "-" for w in words for n in STARTS if len(w) > n])
    return words.union(starts, [t + "2" for t, n in starts.items() if n > 1], [t + "4" for t, n in starts.items() if n > 3])


def allowed_labels(labels: DataFrame, max_labels: int = MAX_LABELS) -> dict[int, int]:
    """The labels that may be used, by id: a bounded sample, all that there are if not more."""
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where((crc_mod(n=4) != 2) & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)
    )
    return {r["doc_id"]: r["toxic"] for r in usable.select("doc_id", "toxic").collect()}


@dataclass
class Lexicon:
    """Terms with their number, and the votes that each calls for."""

    number: dict[str, int]
    votes: list[int]


def signal(t: int, n: int, share: float) -> float:
    """How unlikely t of n are by chance where ``share`` is usual: twice the log-likelihood ratio, 0 if they are no more than usual."""
    if n == 0 or t <= n * share:
        return 0.0
    rest = n - t
    return 2 * (t * math.log(t / (n * share)) + (rest * math.log(rest / (n * (1 - share))) if rest else 0.0))


def term_counts(docs: DataFrame, known: dict[int, int]) -> DataFrame:
    """term, n, toxic: in how many labelled rows, and in how many toxic ones, a term occurs."""
    spark = docs.sparkSession
    few = spark.createDataFrame(list(known.items()), "doc_id long, toxic int")
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(few), "doc_id")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        n: Counter[str] = Counter()
        bad: Counter[str] = Counter()

        def out() -> dict:
            made = {"term": list(n), "n": list(n.values()), "toxic": [bad[t] for t in n]}
            n.clear(), bad.clear()
            return made

        for b in slices(batches, 500):
            for text, toxic in zip(texts(b.column("text")), b.column("toxic").to_pylist()):
                terms = terms_of(text)
                n.update(terms)
                if toxic:
                    bad.update(terms)
            if len(n) > 400_000:
                yield out()
        if n:
            yield out()

    return map_arrow(some.select("text", "toxic"), rows, "term string, n long, toxic long", large=True).groupBy("term").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))


def lexicon(docs: DataFrame, known: dict[int, int], max_terms: int = MAX_TERMS) -> Lexicon:
    """The fixed terms, and those that occur in toxic rows more often than chance allows among so many terms."""
    number = {t: k for k, t in enumerate(sorted(INSULTS | RUDE))}
    votes = [V["insults"] if t in INSULTS else V["rude words"] for t in number]
    toxic = sum(known.values())
    share = toxic / max(1, len(known))
    if 0 < toxic < len(known):
        counted = written(term_counts(docs, known), "terms")
        tried = counted.where("n >= 4").count()
        rest = F.col("n") - F.col("toxic")
        g = 2 * (F.col("toxic") * F.log(F.col("toxic") / (F.col("n") * share)) + F.when(rest > 0, rest * F.log(rest / (F.col("n") * (1 - share)))).otherwise(0.0))
        found = counted.where(f"toxic >= 3 and toxic > 2 * {share} * n").withColumn("g", g).where(F.col("g") >= max(12.0, 2 * math.log(max(tried, 1)))).orderBy(F.col("g").desc(), "term").limit(max_terms)
        for r in found.collect():
            sure = (r["toxic"] + share) / (r["n"] + 1) >= 0.8
            t = r["term"]
            if not sure:
                vote = V["doubtful words"]
            elif "-" in t:
                vote = V["short beginnings" if t.index("-") <= 4 else "long beginnings"]
            else:
                vote = V[f"words {xxhash.xxh3_64_intdigest(t) % WORD_VOTERS}"]
            if t in number:
                votes[number[t]] |= vote
            else:
                number[t] = len(votes)
                votes.append(vote)
    return Lexicon(number, votes)


def unmasked(word: str) -> bool:
    """Whether a word with signs for letters is an insult; a star is any letter."""
    for w in {word.lower().translate(t) for t in UNMASK}:
        if w in INSULTS or "*" in w and w.count("*") < len(w) - 1 and any(len(t) == len(w) and all(a in ("*", b) for a, b in zip(w, t)) for t in INSULTS):
            return True
    return False


def pattern_votes(text: str, n_words: int) -> int:
    out = V["aimed"] if AIMED.search(text) else 0
    if THREAT.search(text):
        out |= V["threat"]
    if any(map(unmasked, MASKED.findall(text))):
        out |= V["masked"]
    if n_words and 2 * len(SHOUT.findall(text)) > n_words:
        out |= V["shouting"]
    if 5 * len(MARKS.findall(text)) > n_words:
        out |= V["marks"]
    return out


ROWS = "doc_id long, held_out boolean, label int, votes int, terms binary"


def read_votes(docs: DataFrame, lex: Lexicon, known: dict[int, int]) -> DataFrame:
    """Each text's votes and the numbers of the lexicon's terms in it; label is -1 where none may be used."""
    number, votes = lex.number, np.array(lex.votes, np.int64)
    levels = {s: [(most, number[s + more]) for most, more in ((1, ""), (2, "2"), (4, "4")) if s + more in number] for s in {t[: t.index("-") + 1] for t in number if "-" in t}}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen: dict[str, tuple] = {}  # of this task: the number of a word, and those of its beginnings that are terms

        def brings(w: str) -> tuple:
            if len(seen) > 500_000:
                seen.clear()
            starts = [s for s in starts_of(w) if s in levels]
            seen[w] = out = (number.get(w, -1), starts) if starts or w in number else ()
            return out

        for b in slices(batches, 1000):
            out: dict[str, list] = {"votes": [], "terms": []}
            for text in texts(b.column("text")):
                all_words = WORD.findall(text.lower())
                terms: list[int] = []
                starts: list[str] = []
                for w in set(all_words):
                    got = seen.get(w)
                    if got is None:
                        got = brings(w)
                    if got:
                        if got[0] >= 0:
                            terms.append(got[0])
                        starts += got[1]
                for s, n in Counter(starts).items():
                    terms += [k for least, k in levels[s] if n >= least]
                ids = np.array(sorted(terms), "<u4")
                out["votes"].append((int(np.bitwise_or.reduce(votes[ids])) if len(ids) else 0) | pattern_votes(text, len(all_words)))
                out["terms"].append(ids.tobytes())
            yield out | {"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "label": [known.get(d, -1) for d in b.column("doc_id").to_pylist()]}

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (crc_mod(n=4) == 2).alias("held_out")), rows, ROWS)


#: Before any row is seen, how often a voter speaks of texts of either kind, and as how many rows that counts: it says which of the two kinds is which.
FIRST_RATE = (np.full(len(VOTERS), 0.01), np.array([0.5 if v in ("insults", "masked", "threat") else 0.1 for v in VOTERS]))
FIRST_ROWS = 10


class LabelModel:
    """P(y) * prod P(vote | parent's vote, y) over all voters; the parents are a tree."""

    def __init__(self, n: int):
        self.n, self.share, self.parent = n, 0.1, np.full(n, -1)
        self.table = np.full((n, 2, 2), 0.5)  # P(vote = 1 | parent's vote, y)

    def odds(self, votes: np.ndarray) -> np.ndarray:
        """Log odds of y = 1 for rows of 0/1 votes."""
        above = np.where(self.parent >= 0, votes[:, np.maximum(self.parent, 0)], 0)
        at = np.arange(self.n)
        p1, p0 = self.table[at, above, 1], self.table[at, above, 0]
        each = np.where(votes == 1, np.log(p1) - np.log(p0), np.log1p(-p1) - np.log1p(-p0))
        return math.log(self.share / (1 - self.share)) + each.sum(1)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.odds(votes), -40, 40)))

    def _dependence(self, votes: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Mutual information of each two voters given y; rows have weights for y = 0 and 1."""
        total = np.zeros((self.n, self.n))
        for y in (0, 1):
            n = w[:, y].sum() + 4
            both = (votes * w[:, y, None]).T @ votes + 1
            one = np.diag(both) + 1
            for a, b, joint in ((one, one, both), (one, n - one, one[:, None] - both), (n - one, one, one[None, :] - both), (n - one, n - one, n - one[:, None] - one[None, :] + both)):
                joint = np.maximum(joint, 0.5)
                total += joint / w.sum() * np.log(joint * n / (a[:, None] * b[None, :]))
        np.fill_diagonal(total, 0)
        return total

    def _tree(self, strength: np.ndarray) -> np.ndarray:
        """Each voter's parent in the tree of largest sum, grown from the first voter."""
        parent, best, link = np.full(self.n, -1), strength[0].copy(), np.zeros(self.n, int)
        out = np.ones(self.n, bool)
        out[0] = False
        while out.any():
            k = int(np.argmax(np.where(out, best, -np.inf)))
            parent[k], out[k] = link[k], False
            closer = strength[k] > best
            best, link = np.where(closer, strength[k], best), np.where(closer, k, link)
        return parent

    def maximise(self, votes: np.ndarray, w: np.ndarray) -> None:
        self.share = float(np.clip((w[:, 1].sum() + 1) / (w.sum() + 10), 1e-4, 0.5))
        self.parent = self._tree(self._dependence(votes, w))
        for k in range(self.n):
            above = votes[:, self.parent[k]] if self.parent[k] >= 0 else np.zeros(len(votes), int)
            for y in (0, 1):
                usual = (w[:, y] @ votes[:, k] + FIRST_ROWS * FIRST_RATE[y][k]) / (w[:, y].sum() + FIRST_ROWS)
                for a in (0, 1):
                    some = w[:, y] * (above == a)
                    self.table[k, a, y] = np.clip((some @ votes[:, k] + FIRST_ROWS * usual) / (some.sum() + FIRST_ROWS), 1e-6, 1 - 1e-6)

    def fit(self, votes: np.ndarray, label: np.ndarray, times: np.ndarray, first: np.ndarray, rounds: int = 25) -> None:
        """``votes`` are the distinct combinations, ``times`` how often each occurs; rows with a label keep it. ``first`` is the posterior to begin with."""
        q = np.where(label >= 0, label, first)
        for _ in range(rounds):
            self.maximise(votes, times[:, None] * np.stack([1 - q, q], 1))
            q = np.where(label >= 0, label, self.posterior(votes))


def unpack(votes: np.ndarray) -> np.ndarray:
    return votes[:, None] >> np.arange(len(VOTERS)) & 1


def label_model(counted) -> LabelModel:
    """From counts of (votes, label): at first labelled rows say how far each combination is toxic, or the fixed lexicons where there are none."""
    code, label, times = (counted[c].to_numpy(np.int64) for c in ("votes", "label", "n"))
    votes = unpack(code)
    model = LabelModel(len(VOTERS))
    spoken = (code & (V["insults"] | V["threat"] | V["masked"])) > 0
    first = np.where(spoken, 0.9, 0.02)
    if (label == 1).any() and (label == 0).any():
        held = label >= 0
        model.maximise(votes[held], times[held, None] * np.stack([1 - label[held], label[held]], 1))
        first = model.posterior(votes)
    model.fit(votes, label, times, first)
    return model


@dataclass
class Classifier:
    weight: np.ndarray
    bias: float

    def scores(self, terms: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + summed(self.weight, terms), -30, 30)))


def summed(weight: np.ndarray, terms: list[bytes]) -> np.ndarray:
    n = np.array([len(t) // 4 for t in terms], np.int64)
    total = np.concatenate([[0.0], np.cumsum(weight[np.frombuffer(b"".join(terms), "<u4")])])
    ends = np.cumsum(n)
    return total[ends] - total[ends - n]


def train(terms: list[bytes], target: np.ndarray, times: np.ndarray, n_terms: int, rounds: int = 300, rate: float = 0.15, decay: float = 3e-5) -> Classifier:
    """Logistic regression on soft labels by gradient steps of Adam; rows count ``times``."""
    flat = np.frombuffer(b"".join(terms), "<u4").astype(np.int64)
    lengths = np.array([len(t) // 4 for t in terms], np.int64)
    share = times / times.sum()
    mean = float(np.clip(share @ target, 1e-4, 1 - 1e-4))
    w = np.concatenate([np.zeros(n_terms), [math.log(mean / (1 - mean))]])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, rounds + 1):
        c = Classifier(w[:-1], float(w[-1]))
        error = share * (c.scores(terms) - target)
        g = np.concatenate([np.bincount(flat, np.repeat(error, lengths), n_terms) + decay * w[:-1], [error.sum()]])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8) / (1 + k / 100)
    return Classifier(w[:-1], float(w[-1]))


def fit(read: DataFrame, lex: Lexicon, max_rows: int = MAX_ROWS) -> tuple[LabelModel, Classifier]:
    """The label model from all rows' votes, and the classifier from a bounded sample of rows with terms; rows without any are all alike and are counted."""
    counted = read.groupBy("votes", "label").agg(F.count(F.lit(1)).alias("n")).toPandas()
    model = label_model(counted)
    posterior = lambda votes, label: np.where(label >= 0, label, model.posterior(unpack(votes)))
    plain = read.where(F.length("terms") == 0).groupBy("votes", "label").agg(F.count(F.lit(1)).alias("n")).toPandas()
    with_terms = int(counted["n"].sum() - plain["n"].sum())
    some = read.where(F.length("terms") > 0).orderBy(F.xxhash64("doc_id", "terms")).limit(max_rows).select("votes", "label", "terms").toPandas()
    q = posterior(*(np.concatenate([some[c].to_numpy(np.int64), plain[c].to_numpy(np.int64)]) for c in ("votes", "label")))
    times = np.concatenate([np.full(len(some), with_terms / max(1, len(some))), plain["n"].to_numpy(float)])
    return model, train([bytes(t) for t in some["terms"]] + [b""] * len(plain), q, times, len(lex.votes))


def scored(read: DataFrame, classifier: Classifier, limit: float = 0.3) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            s = classifier.scores(b.column("terms").to_pylist())
            yield {"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "score": s, "predicted": (s >= limit).astype(np.int32)}

    return map_arrow(read.select("doc_id", "held_out", "terms"), rows, "doc_id long, held_out boolean, score double, predicted int")


def score_documents(docs: DataFrame, labels: DataFrame, limit: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of each text."""
    known = allowed_labels(labels)
    lex = lexicon(docs, known)
    read = written(read_votes(docs, lex, known), "votes")
    if not read.take(1):
        return scored(read, Classifier(np.zeros(len(lex.votes)), -3.0), limit)
    _, classifier = fit(read, lex)
    return scored(read, classifier, limit)
