"""Alignment of two tokenizers against the libraries and a plain walk over their bytes."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pagemill.llm import align
from pagemill.llm.queries import tokenizer_file

A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
DOCS = "doc_id long, text string, pair long, n_a string, runs int"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def odd_texts():
    r = random.Random(3)
    word = lambda: "".join(r.choices(["th", "er", "on", "é", "ß", "qu", "12", "'s", "!", "日本"], k=r.randint(1, 4)))
    gap = lambda: r.choice([" ", " ", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\r", " \r\n ", "　", "\xa0", "\x1c", "\x85", "​"])
    free = ["".join(word() + gap() for _ in range(r.randint(1, 60))) for _ in range(60)]
    fixed = [None, "", " ", "\n", "  two  blanks ", "a▁b", "▁", "<|endoftext|> <s> </s> <unk> <0x41>", "x\x00y", "}\r\nnext);\r", "\U0001f600\U0001f9d1‍\U0001f4bb ok", "é é ﬁ ①", "same words", "same words", "longwordwithoutanyblank" * 400, "nb\xa0sp", "!\x1c!"]
    return fixed + free + [" ".join(word() for _ in range(8000))]


def brute(texts, a, b):
    """Per text (n_a, n_b, groups as ids), or None."""
    alphabet = {c: bytes([v]) for c, v in align.byte_alphabet().items()}
    out = []
    for t in texts:
        ia = a.encode(" " + t, add_special_tokens=False).ids if t else []
        ib = b.encode(t) if t else []
        ba = [b"".join(alphabet[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if not t or b"".join(ba) != (" " + t).encode() or b"".join(bb) != (" " + t).encode():
            out.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        groups, i, j = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            k, m = ends_a.index(e, i) + 1, ends_b.index(e, j) + 1
            groups.append((ia[i:k], ib[j:m]))
            i, j = k, m
        out.append((len(ia), len(ib), groups))
    return out


def want(rows, a, b):
    found = brute([t for _, t in rows], a, b)
    n = Counter((x[-1], y[-1]) for f in found if f for x, y in f[2])
    top = {}
    for (_, y), k in n.items():
        top[y] = max(k, top.get(y, 0))
    out = []
    for (d, _), f in zip(rows, found):
        if f is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x[-1], y[-1]) for x, y in f[2]]
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in f[2])
        out.append((d, f[0], f[1], len(links), len(links), sum(n[x] == top[x[1]] for x in links), sum(n[x] for x in links), hashlib.sha256(said.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_against_a_walk_over_bytes(spark, libraries):
    rows = [(None if k == 9 else k, t) for k, t in enumerate(odd_texts())] + [(3, "repeated row"), (3, "repeated row")]
    docs = spark.createDataFrame([(d, t, 1, "x", 0) for d, t in rows], DOCS).repartition(3)
    got = align.align_documents(docs, A, B).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == want(rows, *libraries)


def test_on_the_table(spark, sf_dir, libraries):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = align.align_documents(docs, A, B).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == want(rows, *libraries)


def test_empty(spark):
    assert align.align_documents(spark.createDataFrame([], DOCS), A, B).count() == 0


def test_worker_forgets(libraries, monkeypatch):
    """What was forgotten is found again, with the same result."""
    monkeypatch.setattr(align, "REMEMBERED", 5)
    one = align.Aligner(A, B)
    texts = [t or "" for t in odd_texts()[:40]]
    for t, f in zip(texts, brute(texts, *libraries)):
        ids = one.split([t])[0].tolist()
        said = b";".join(one.written[i] for i in ids).decode()
        assert said == (";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in f[2]) if f else "")


def test_a_transducer_by_hand():
    t = align.Transducer({1: b"ab", 2: b"c", 3: b"abc"}, {1: b"a", 2: b"bc", 3: b"abc", 4: b"x"})
    assert t.groups([1, 2], [1, 2]) == [(2, 2)]
    assert t.groups([1, 2, 3], [3, 3]) == [(2, 1), (3, 2)]
    assert t.groups([1, 2], [4]) is None and t.groups([1], [1]) is None and t.groups([], []) == []
    steps = len(t.steps)
    t.groups([1, 2, 3], [3, 3])
    assert len(t.steps) == steps


def test_the_bound_of_pairs():
    a, b = {1: b"ab", 2: b"b"}, {5: b"b", 6: b"cab", 7: b"ab"}
    together = [(i, j) for i, x in a.items() for j, y in b.items() if x.endswith(y) or y.endswith(x)]
    assert align.possible_pairs(a, b) == len(together)


def test_other_ways_to_encode(libraries):
    """Without the ranked form, and where pieces may span blanks, the library takes whole texts."""
    one, two = align.Aligner(A, B), align.Aligner(A, B)
    two.a.encode, two.b.parts = two.a._library(A), False
    texts = [t or "" for t in odd_texts()[:50]]
    for x, y in zip(one.split(texts), two.split(texts)):
        assert b";".join(one.written[i] for i in x.tolist()) == b";".join(two.written[i] for i in y.tolist())
