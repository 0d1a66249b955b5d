"""Each operator against a brute-force version, on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import html
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import ann, extract, interpolate, neardup, packing, pieces, pii, quality, tokens, warczip
from pagemill.llm.queries import tokenizer_file

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORDS_FILE, PIECES_FILE = tokenizer_file("word_bpe_49k.json"), tokenizer_file("piece_bpe_32k.model")


def words(r, n):
    return " ".join("".join(r.choices(["th", "er", "on", "an", "é", "qu", "io"], k=r.randint(1, 4))) for _ in range(n))


def odd_rows():
    """Rows with every oddity; the extra columns have names that operators use themselves."""
    r = random.Random(5)
    base = words(r, 60)
    rows = [(i, words(r, r.randint(1, 120)) + ".") for i in range(1, 30)]
    rows += [(40, base), (41, base), (42, base + " more words"), (43, base[:-5]), (44, None), (45, ""), (46, " \t\n"), (47, "one two"), (48, "one two"), (None, base), (50, words(r, 20_000)), (40, base), (51, "x\x1cy\x85z a b   c"), (52, "<|endoftext|> a<|startoftext|>b")]
    return [(d, t, f"n{k}", k, True, "src", -1) for k, (d, t) in enumerate(rows)]


DOCS = "doc_id long, text string, n_words string, n_tokens long, kept boolean, source string, rep long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def keyed(rows, *cols):
    return sorted((tuple(r[c] for c in cols) for r in rows), key=repr)


# 1


def test_scores_against_counts(spark, docs):
    got = interpolate.score_documents(docs).collect()
    split = [(d, (t or "").encode().lower().split() + [None]) for d, t, *_ in odd_rows()]
    held = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 10 == 0
    n = Counter(w for d, ws in split if not held(d) for w in ws)
    total, kinds = sum(n.values()), len(n)
    want = [(d, held(d), len(ws), sum(n[w] > 0 for w in ws), total, round(sum(math.log10((n[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in ws), 6)) for d, ws in split]
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr) == sorted(want, key=repr)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_no_documents(none):
    assert interpolate.score_documents(none).count() == 0


FIXED = np.tile([0.1, 0.3, 0.6], (interpolate.BUCKETS, 1)) + np.linspace(0, 0.05, interpolate.BUCKETS)[:, None] * [1, 1, -2]


def by_hand(rows):
    """(doc_id, score) with the weights ``FIXED``, from counts of bigrams in plain dictionaries."""
    split = [(d, (t or "").encode().lower().split() + [None]) for d, t, *_ in rows]
    train = [ws for d, ws in split if zlib.crc32(b"" if d is None else str(d).encode()) % 10]
    one = Counter(w for ws in train for w in ws)
    context = Counter(u for ws in train for u in ["start", *ws[:-1]])
    two = Counter(x for ws in train for x in zip(["start", *ws[:-1]], ws))
    n, v = sum(one.values()), len(one)

    def p(u, w):
        c = context[u]
        l0, l1, l2 = FIXED[math.frexp(c)[1] if c else 0]
        return (l2 * two[u, w] / c if c else 0) + (l1 * one[w] / n if n else 0) + l0 / (v + 1)

    return sorted(((d, round(sum(math.log10(p(u, w)) for u, w in zip(["start", *ws[:-1]], ws)), 6)) for d, ws in split), key=repr)


@pytest.mark.parametrize("chunk_bytes, fan", [(interpolate.CHUNK_BYTES, interpolate.FAN), (300, 256), (300, 8), (300, 2)])
def test_score_against_counted_bigrams(docs, monkeypatch, chunk_bytes, fan):
    """Whatever the chunks and the levels in which they are summed, the counts are those of the whole table."""
    monkeypatch.setattr(interpolate, "weights", lambda *_: FIXED)
    got = interpolate.score_documents(docs, chunk_bytes, fan).collect()
    assert sorted(((r.doc_id, round(r.score, 6)) for r in got), key=repr) == by_hand(odd_rows())
    one = interpolate.score_documents(docs).collect()
    assert keyed(got, "doc_id", "n_tokens", "n_known", "train_tokens") == keyed(one, "doc_id", "n_tokens", "n_known", "train_tokens")


def test_rows_of_counts_grow_with_the_chunks(spark):
    """A chunk has at most so many rows at a level, however many chunks there are."""
    r = random.Random(8)
    rows = spark.createDataFrame([(i, words(r, 400)) for i in range(60)], "doc_id long, text string").repartition(2)
    few, many = (interpolate.chunks(rows.where(f"doc_id < {n}"), 2000) for n in (20, 60))
    per = [interpolate.partial_counts(made, 1).count() / made.count() for made in (few, many)]
    assert max(per) <= 2 << interpolate.BITS and abs(per[0] / per[1] - 1) < 0.1


def test_model_beats_the_base_on_held_out_text(spark, sf_dir):
    got = interpolate.score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("held_out").toPandas()
    assert got.score.sum() > got.base_score.sum()


def test_probabilities_add_up():
    """Over all words, and one for the unseen, the estimates of a context add up to one."""
    weight = interpolate.weights(np.array([0]), np.array([1]), 0.1)
    assert np.allclose(weight.sum(1), 1)
    cells = interpolate.bucket(np.array([0, 1, 2, 3, 4, 1000]))
    assert cells.tolist() == [0, 1, 2, 2, 3, 10]


def test_em_finds_the_weights():
    r = np.random.default_rng(1)
    wide = interpolate.LOWEST * interpolate.STEPS + 2
    hit = r.random(20_000) < 0.7  # seven of ten tokens are what the context predicts
    two, one = interpolate.step_of(np.where(hit, 0.5, 0.0)), interpolate.step_of(np.full(20_000, 1e-4))
    cell, n = np.unique((5 * wide + two) * wide + one, return_counts=True)
    w = interpolate.weights(cell, n, 1e-9)
    assert abs(w[5, 2] - 0.7) < 0.02


# 2


def odd_pages():
    return [(1, "http://h/1", "same"), (2, "http://h/2", "same"), (9, "http://h/ü 9", "same"), (3, None, None), (4, "", ""), (5, "http://h/5", "é" * 70_000), (None, "http://h/n", "same"), (6, "u", "alone"), (6, "u", "alone"), (7, "u", "\r\n\r\n")]


def test_records_come_back(spark):
    pages = spark.createDataFrame([(*p, 1, "x") for p in odd_pages()], "page_id long, url string, html string, rid int, digest string").repartition(3)
    got = warczip.round_trip(pages).collect()
    groups = {}
    for i, (p, _, h) in enumerate(odd_pages()):
        groups.setdefault(h or "", []).append((-(10**9) if p is None else p, p))
    want = []
    for h, ids in groups.items():
        b = h.encode()
        digest = warczip.digest_of(b)
        ids.sort()
        want += [(p, len(b), digest, *(("revisit", ids[-1][1]) if p != ids[-1][1] else ("response", None))) for _, p in ids]
    assert keyed(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want, key=repr)


def test_small_payloads_are_never_revisits(spark):
    pages = spark.createDataFrame(odd_pages(), "page_id long, url string, html string")
    assert {r.record_type for r in warczip.round_trip(pages, least=10_000_000).collect()} == {"response"}
    assert warczip.round_trip(pages.limit(0)).count() == 0


class Bytes:
    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        return self.data[at : at + n]


@pytest.mark.parametrize("zip64", [False, True])
def test_directories(zip64):
    import io
    import zipfile

    out = io.BytesIO()
    z = warczip.ZipWriter(out, zip64)
    for k in range(5):
        z.add(f"m{k}", [b"x" * k, b"tail"])
    z.close()
    r = warczip.ZipReader(Bytes(out.getvalue()))
    assert [r.read(f"m{k}") for k in range(5)] == [b"x" * k + b"tail" for k in range(5)]
    assert r.read("m4", 2, 3) == b"xxt"
    with zipfile.ZipFile(io.BytesIO(out.getvalue())) as lib:  # an independent reader agrees
        assert lib.testzip() is None and lib.read("m3") == b"xxxtail"


def test_reads_what_others_write():
    import io
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a", "alpha")
        z.writestr("b", "beta")
        z.comment = b"a note with PK\5\6 inside"
    assert warczip.ZipReader(Bytes(out.getvalue())).read("b") == b"beta"
    with pytest.raises(ValueError):
        warczip.ZipReader(Bytes(b"no archive"))
    old = out.getvalue()
    dos = bytearray(old)
    for at in (i for i in range(len(dos) - 4) if dos[i : i + 4] == b"PK\1\2"):
        if dos[at + 46 : at + 47] == b"a":
            dos[at + 46] = 0x84  # a letter with two dots in code page 437, no UTF-8
    assert sorted(warczip.ZipReader(Bytes(bytes(dos))).members) == ["b", "ä"]
    with pytest.raises(ValueError, match="checksum"):
        warczip.ZipReader(Bytes(old.replace(b"beta", b"bets"))).read("b")


def test_only_packages_of_the_manifest_are_read(spark, tmp_path):
    """What another attempt left in the folder does not count."""
    rows = spark.createDataFrame([(i, "http://h/", f"page {i}") for i in range(20)], "page_id long, url string, html string").repartition(3)
    folder = f"file://{tmp_path}"
    manifest = warczip.written(warczip.write_packages(rows, folder), "manifest")
    (tmp_path / "part-000000-00000-999999.wacz").write_bytes(b"half an arch")
    warczip.write_packages(rows, folder).count()
    got = warczip.read_records(warczip.record_ranges(manifest, folder), folder).select("page_id").collect()
    assert sorted(r.page_id for r in got) == list(range(20))


# 3


def brute_repeats(w, k=5):
    seen = Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    hit = {j for i in range(len(w) - k + 1) if seen[tuple(w[i : i + k])] > 1 for j in range(i, i + k)}
    return len(hit)


def test_repeated_words():
    r = random.Random(2)
    for _ in range(300):
        w = r.choices("abc", k=r.randint(0, 40))
        assert quality.repeated_words(w) == brute_repeats(w)
    w = [str(i) for i in range(9000)] + [str(i) for i in range(100, 120)]  # too many words for one code
    assert quality.repeated_words(w) == brute_repeats(w)


def test_statistics(spark, docs):
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in quality.judge(docs, None).collect()}
    want = set()
    for d, t, *_ in odd_rows():
        t = t or ""
        w = WORD.findall(t)
        seen, dup = set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        rep = brute_repeats(w)
        failed = len(w) < 10 or 100 * rep > 20 * len(w)
        want.add((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, rep, failed, not failed))
    assert got == want


def test_forest_finds_what_lies_outside():
    r = np.random.default_rng(0)
    good, bad = r.normal(0, 1, (2000, 3)), r.normal(9, 1, (100, 3))
    f = quality.grow(good, np.full(3, 2.0))
    s = f.scores(np.concatenate([good, bad]))
    f.threshold = quality.calibrate(s, np.arange(2100) < 2000)
    odd = s > f.threshold
    assert odd[2000:].mean() > 0.95 and odd[:2000].mean() <= 0.005


def test_path_lengths_against_walks():
    r = np.random.default_rng(2)
    x = r.normal(size=(200, 3))
    forest = quality.grow(x, np.ptp(x, axis=0), n_trees=20, sample=64)
    for row in (*x[:20], np.array([9.0, -9.0, 9.0])):
        total = 0.0
        for feature, cut, left, depth in zip(forest.feature, forest.cut, forest.left, forest.depth):
            at = 0
            while feature[at] >= 0:
                at = left[at] + int(row[feature[at]] >= cut[at])
            total += depth[at]
        assert math.isclose(forest.scores(row[None])[0], 2 ** (-total / 20 / forest.norm))


def test_labels_that_clash_are_left_out(spark):
    r = random.Random(1)
    rows = [(i, words(r, 40) + ("###" * (i % 5 == 0) * 20)) for i in range(100)]
    docs_ = spark.createDataFrame(rows + [(3, "other text " * 20)], "doc_id long, text string")
    labels = [(i, int(i % 5 != 0)) for i in range(100)]
    a = quality.fit(docs_, spark.createDataFrame(labels + [(7, 0), (7, 1)], "doc_id long, quality int"))
    b = quality.fit(docs_.repartition(7), spark.createDataFrame([(7, 0)] + labels[::-1], "doc_id long, quality int").repartition(3))
    assert a.threshold == b.threshold and (a.cut == b.cut).all()


def test_verdicts_on_labelled_rows(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = quality.judge(docs, quality.fit(docs, labels, max_rows=2000)).join(labels, "doc_id").toPandas()
    own = got[~got.base_failed]
    assert own[own.quality == 0].kept.mean() < 0.1 and own[own.quality == 1].kept.mean() > 0.99


def test_documents_odd_in_one_statistic(spark):
    """Long tokens, one-letter words, repeated lines without repeated windows, digits: each alone is enough."""
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    forest, r = quality.fit(docs, labels), random.Random(1)
    word = lambda: "".join(r.choices("etaoinsrhl", k=r.randint(2, 8)))
    odd = {
        "long": lambda: " ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(80, 300))) for _ in range(r.randint(12, 100))),
        "short": lambda: " ".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(60, 800))),
        "lines": lambda: "\n".join(x for _ in range(r.randint(15, 100)) for x in (" ".join(word() for _ in range(30)), "read more here")),
        "digits": lambda: " ".join(str(r.randint(1, 10 ** r.randint(1, 6))) for _ in range(r.randint(60, 300))),
    }
    for make in odd.values():
        got = [quality.statistics(make()) for _ in range(40)]
        assert not any(g[5] for g in got)
        assert (forest.scores(np.array([g[6] for g in got])) > forest.threshold).mean() > 0.9


def test_filter_keeps_columns(spark, docs, none):
    out = quality.filter_documents(docs, None)
    assert out.columns == docs.columns and 0 < out.count() < docs.count()
    assert quality.filter_documents(none, None).count() == 0
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    assert quality.fit(docs, labels) is None and quality.fit(docs, labels.limit(0)) is None


# 4


def library():
    t = tokens.load(WORDS_FILE)
    return lambda s: t.encode(s, add_special_tokens=False).ids


def test_token_counts(spark, docs, none):
    encode = library()
    got = keyed(tokens.count_tokens(docs, WORDS_FILE).collect(), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = [(d, len((t or "").encode()), n := len(encode(t or "")), n > 2048) for d, t, *_ in odd_rows()]
    assert got == sorted(want, key=repr)
    assert tokens.count_tokens(none, WORDS_FILE).count() == 0


def test_runs_encode_like_whole_texts():
    encode, known = library(), tokens.Pieces(WORDS_FILE, ids=True)
    assert known.mark is not None
    r = random.Random(1)
    for _ in range(2000):
        s = "".join(r.choices(["a", "sT", "'ll", "'", "S", ".", "!#", "19", " ", "\n", "é", "é", "ß", "İ", "ﬁ", "\x1c", "\x85", "日", "Σ", "<|endoftext|>", "\x01"], k=r.randint(0, 25)))
        w = WORD.findall(s)
        known.learn(set(w))
        assert np.frombuffer(b"".join(known[x] for x in w), "<u4").tolist() == encode(s)


# 5


def brute_links(rows, threshold=0.8):
    sets = {}
    for k, (d, t, *_) in enumerate(rows):
        w = WORD.findall(t or "")
        n = min(5, len(w))
        sets[k] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
    live = [k for k, (d, *_) in enumerate(rows) if d is not None and sets[k]]
    links, root = Counter(), {k: k for k in live}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(live):
        for b in live[:i]:
            both = len(sets[a] & sets[b])
            if both >= threshold * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for k in live:
        least[find(k)] = min(least.get(find(k), rows[k][0]), rows[k][0])
    return [(rows[k][0], least[find(k)] if k in root else rows[k][0], links[k]) for k in range(len(rows))]


def test_similar_texts(spark, docs, none):
    got = keyed(neardup.similar(docs).collect(), "doc_id", "class_id", "n_links")
    assert got == sorted(brute_links(odd_rows()), key=repr)
    assert neardup.similar(none).count() == 0


def test_a_large_group_of_near_copies(spark, monkeypatch):
    """More members than a block holds, not all of which are similar to each other."""
    r = random.Random(3)
    base = words(r, 150).split(" ")
    rows = []
    for i in range(450):
        w = list(base)
        for _ in range(r.randint(0, 5)):
            w[r.randrange(150)] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, words(r, 100)) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert keyed(neardup.similar(df).collect(), "doc_id", "class_id", "n_links") == sorted(brute_links(rows), key=repr)
    kept = {x.doc_id for x in neardup.one_of_each(df).collect()}
    assert kept == {c for _, c, _ in brute_links(rows)}


def test_one_row_of_each_group_with_repeated_ids(spark):
    r = random.Random(4)
    a, b, c = (words(r, 50) for _ in "abc")
    rows = [(1, a), (2, a + " more"), (2, b), (3, c), (3, c), (3, c + " end"), (4, c), (None, a), (None, a), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = keyed(neardup.one_of_each(df).collect(), "doc_id", "text")
    ours = [x for x in got if x[0] == 3]
    assert len(ours) == 1 and ours[0] in rows
    assert [x for x in got if x[0] != 3] == sorted([(1, a), (2, b), (None, a), (None, a), (5, "")], key=repr)


def depths_of(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    signed = neardup.signatures(df, 5)
    classes = signed.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("labels").alias("labels")).cache()
    depths = []
    assert neardup.all_links(df, classes, 0.8, 5, 0.999999, depths).count() > 0
    return depths


def test_prefixes_are_shortened_as_the_data_ask(spark):
    """Where copies are close whole labels do; where they are at the limit the prefix must be shorter."""
    r = random.Random(6)
    close, apart = [], []
    for i in range(30):
        base = words(r, 300)
        close += [(2 * i, base), (2 * i + 1, base + " end")]
        w = base.split(" ")
        for at in (40, 80, 120, 160, 200, 240):
            w[at] = "changed"  # 30 shingles of 296 differ on both sides: 0.816
        apart += [(2 * i, base), (2 * i + 1, " ".join(w))]
    assert depths_of(spark, close) == [7]
    assert len(depths := depths_of(spark, apart)) > 1 and depths[-1] < 7
    df = spark.createDataFrame(apart, "doc_id long, text string")
    assert keyed(neardup.similar(df).collect(), "doc_id", "class_id", "n_links") == sorted(brute_links(apart), key=repr)


def test_prefix_trees(spark):
    """Edges of the trie join just the classes whose labels share a prefix."""
    r = np.random.default_rng(5)
    labels = (np.arange(neardup.TREES) << 56) | r.integers(0, 3, (40, neardup.TREES, 7)) @ (256 ** np.arange(6, -1, -1))
    classes = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(labels)], "h1 long, labels array<long>").repartition(3)
    edges = [tuple(e) for e in neardup.trie(classes, 3).select("a", "b", "depth").collect()]
    for depth in (7, 6, 5, 4, 3):
        root = list(range(40))

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for a, b, d in edges:
            if d >= depth:
                assert any(x >> 8 * (7 - d) == y >> 8 * (7 - d) for x in labels[a] for y in labels[b])
                root[find(a)] = find(b)
        got = [find(i) for i in range(40)]
        want = list(range(40))
        for i in range(40):
            for j in range(i):
                if (labels[i] >> 8 * (7 - depth) == labels[j] >> 8 * (7 - depth)).any():
                    a, b = want[i], want[j]
                    want = [b if x == a else x for x in want]
        assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_recall_of_the_forest(spark):
    """Links at and above the threshold, against brute force over all pairs of a whole table."""
    rows = [(x.doc_id, x.text) for x in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert keyed(neardup.similar(df).collect(), "doc_id", "class_id", "n_links") == sorted(brute_links(rows), key=repr)


# 6


def check_packing(spark, rows, got, size=2048):
    encode = library()
    want = Counter((d, len(i := encode(t or "")) + 1, zlib.crc32(np.array([*i, 1], "<u4").tobytes())) for d, t, *_ in rows)
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for s in by_sequence.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= size and (at == size or at & (at - 1) == 0)
    assert sum(r.length for r in got) == sum(n * k for (_, n, _), k in want.items())
    texts = {}
    for d, t, *_ in rows:
        texts.setdefault(d, []).append(np.array([*encode(t or ""), 1], "<u4"))
    for d, ps in by_doc.items():
        if len(texts[d]) == 1:
            ids, at = texts[d][0], 0
            for r in sorted(ps, key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(ids)
                assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
                at += r.length
            assert at == len(ids)


def test_packing(spark, docs, none):
    check_packing(spark, odd_rows(), packing.pack(docs, WORDS_FILE).collect())
    check_packing(spark, odd_rows(), packing.pack(docs, WORDS_FILE, window=3000).collect())
    assert packing.pack(none, WORDS_FILE).count() == 0


def test_costs_are_balanced():
    r = random.Random(4)
    pieces_ = [packing.Piece(i, memoryview(bytes(4 * r.randint(50, 700))), 0, 0) for i in range(3000)]
    n = sum(map(len, pieces_)) // 2048
    held, left = packing.assign(pieces_, [2048] * n, 1.0, 1 / 2048)
    assert all(sum(map(len, h)) == 2048 for h in held) and sum(map(len, left)) < 2048
    cost = [sum(len(p) + len(p) ** 2 / 2048 for p in h) for h in held]
    assert np.std(cost) / np.mean(cost) < 0.1


# 7


def test_nearest(spark):
    r = np.random.default_rng(6)
    v = r.normal(size=(3000, 24))
    v[100:400] = v[50]  # a very common vector: ties
    v[400] = 3 * v[50]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    odd = [(5000, None), (5050, [0.0] * 24), (5100, [float("nan")] + [1.0] * 23), (5150, [None] + [1.0] * 23), (5200, []), (None, v[1].tolist()), (5250, [1.0, 2.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumnRenamed("x", "x").repartition(3)
    got = keyed(ann.search(df, df.where("vec_id % 50 = 0")).collect(), "query_id", "rank", "vec_id", "score")
    ids = np.arange(3000)
    want = ann.brute_force(ids, v, ids[::50], v[::50])
    same = {(a, c) for a, _, c, _ in got} & {(a, c) for a, _, c, _ in want}
    assert len(same) >= 0.99 * len(want)
    exact = {(a, c): s for a, _, c, s in want}
    assert all(abs(exact[a, c] - s) < 1e-12 for a, _, c, s in got if (a, c) in exact)
    assert [x for x in got if x[0] == 50][:5] == [(50, k + 1, 100 + k, got[[g[:2] for g in got].index((50, k + 1))][3]) for k in range(5)]


def test_query_blocks_are_not_broadcast(spark):
    """They are repeated for each part of the index, so a broadcast grows with the square of the table."""
    df = spark.createDataFrame([(k, [float(np.cos(k)), float(np.sin(k)), 0.1]) for k in range(200)], "vec_id long, embedding array<double>")
    found = ann.search(df, df.where("vec_id % 50 = 0"))
    assert len(found.collect()) == 20
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_ranks_of_a_block_are_those_of_all_scores():
    """Vectors of which many are nearly as close, of sizes where squares overflow or vanish, and in single precision."""
    r = np.random.default_rng(9)
    base = r.normal(size=16)
    for v in (base + 1e-9 * r.normal(size=(500, 16)), r.normal(size=(500, 16)).astype(np.float32).astype(float), r.normal(size=(500, 16)) * 10.0 ** r.integers(-140, 140, 500)[:, None]):
        raw = ann.packed(v)
        assert np.array_equal(ann.unpacked(raw, *v.shape), v)
        ids, floor, best = r.permutation(500), np.full(20, -np.inf), {}
        q_ids, q = ids[:20], v[:20]
        for at in range(0, 500, 100):
            for j, i, s in ann.best_in_block(ann.Codes(v[at : at + 100]), ids[at : at + 100], q_ids, q, 5, 4.0, floor):
                best.setdefault(j, []).extend(zip((-s).tolist(), i.tolist()))
        got = [(int(q_ids[j]), rank, i, -s) for j in range(20) for rank, (s, i) in enumerate(sorted(best[j])[:5], 1)]
        want = ann.brute_force(ids, v, q_ids, q)
        assert len({x[:3] for x in got} & {x[:3] for x in want}) >= 99


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = ann.search(df, df.where("vec_id = 0")).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 2), (2, 1)]
    assert ann.search(df.limit(0), df).count() == 0 and ann.search(df, df.limit(0)).count() == 0


def test_a_repeated_query_id_asks_with_its_least_vector(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.5, -1.0]), (0, [0.5, 2.0]), *((k, [float(np.cos(k)), float(np.sin(k))]) for k in range(1, 9))]
    v = np.array([x for _, x in rows])
    want = ann.brute_force(np.array([k for k, _ in rows]), v, np.array([0]), np.array([[0.5, -1.0]]))
    for parts in (1, 2, 4, 7):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(parts)
        assert [(r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in ann.search(df, df.where("vec_id = 0")).orderBy("rank").collect()] == [(q, k, i, round(x, 9)) for q, k, i, x in want]
    assert len(want) == 5


def test_estimates_are_within_their_bounds():
    r = np.random.default_rng(8)
    v, q = r.normal(size=(2000, 64)), r.normal(size=(20, 64))
    c = ann.Codes(v)
    unit = q / np.linalg.norm(q, axis=1)[:, None]
    true = (v / np.linalg.norm(v, axis=1)[:, None]) @ unit.T
    off = np.abs(c.estimate(unit @ ann.rotation(64).T) - true) / c.deviation()[:, None]
    assert (off < 4).mean() > 0.9999 and off.mean() > 0.3  # a bound that holds, and is no larger than need be


# 8


def naive_spans(t):
    out = [(*m.span(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(*m.span(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    digits = lambda s: "".join(c for c in s if c.isdigit())
    out += [(*m.span(), "card") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    out += [(*m.span(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_spans():
    r = random.Random(9)
    for _ in range(5000):
        t = "".join(r.choices("a1.2@+- (5)9@é", k=r.randint(0, 50)))
        assert pii.base_spans(t) == naive_spans(t)
    assert pii.base_spans("1" * 200_000) == []  # in linear time


def spans_found(model, text):
    return [(text[a:b], k) for a, b, k in pii.find_spans(model, [text])[0][1]]


def test_model_on_held_out_lines():
    model = pii.default_tagger()
    held = pii.labelled_rows(300, seed=99)
    found = [[(a, b, k) for a, b, k, score in x if score >= model.cuts[k]] for x in pii.model_spans(model, [t for t, _ in held])]
    right = sum(len(set(a) & set(b)) for a, (_, b) in zip(found, held))
    assert right / sum(map(len, found)) > 0.9 and right / sum(len(b) for _, b in held) > 0.9


def test_training_learns_the_forms():
    """A short training on few rows already tags most characters of other rows as it should."""
    model = pii.train(pii.labelled_rows(800), epochs=8)
    held = pii.labelled_rows(100, seed=98)
    found = pii.model_spans(model, [t for t, _ in held])
    touched = sum(any(k == s[2] and a < s[1] and s[0] < b for a, b, k, _ in x) for x, (_, gold) in zip(found, held) for s in gold)
    assert touched > 0.7 * sum(len(gold) for _, gold in held)


#: Written by hand, in forms that the base patterns miss.
MISSED = [
    ("jane (at) mail (dot) org", "email"), ("jane(at)mail(dot)org", "email"), ("max.mustermann (at) example.org", "email"), ("anna [at] mail [dot] com", "email"), ("bob(at)example(dot)org", "email"),
    ("42lauraverylongusernameindeedthatgoeson (at) mail (dot) org", "email"), ("(917) 555-0182", "phone"), ("415-555-0134", "phone"), ("192 . 168 . 4 . 17", "ip"),
]


def test_whole_documents_with_forms_that_the_patterns_miss(spark, sf_dir):
    """Each form, put in the middle of a document, is found there, and nothing else is found that was not before."""
    model = pii.default_tagger()
    whole = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect() if len(r.text.split()) > 50 and not pii.base_spans(r.text)][: 3 * len(MISSED)]
    caught = 0
    for i, text in enumerate(whole):
        form, kind = MISSED[i % len(MISSED)]
        at = text.index(" ", len(text) // 2)
        changed = text[:at] + f" you can write to {form} if you like" + text[at:]
        assert pii.base_spans(changed) == []
        before, after = spans_found(model, text), spans_found(model, changed)
        caught += (form, kind) in after
        assert len(after) <= len(before) + 1
    assert caught >= 0.85 * len(whole)


def test_the_model_alone_finds_what_the_patterns_find(spark):
    model = pii.default_tagger()
    whole = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    hit = n = added = 0
    for (base, every), spans in zip(pii.find_spans(model, whole), pii.model_spans(model, whole)):
        added += len(every) - len(base)
        for s in base:
            n += 1
            hit += any(k == s[2] and a <= s[0] + 1 and b >= s[1] - 1 and score >= model.cuts[k] for a, b, k, score in spans)
    assert n > 50 and hit >= 0.85 * n and added <= 5


def test_windows_are_joined():
    """A span is found whole wherever it lies, also across the ends of windows and of pieces."""
    model = pii.default_tagger()
    for pad in range(0, 130, 3):
        t = "and so on " * pad + "anna.bee.42@mail.example.com and so on"
        assert any(k == "email" and t[a:b] == "anna.bee.42@mail.example.com" for a, b, k, _ in pii.model_spans(model, [t])[0])


def test_pieces_of_very_long_texts(monkeypatch):
    model = pii.default_tagger()
    t = "".join(f"some words here jane{i} (at) mail (dot) org and more of them\n" for i in range(400))
    one = [s[:3] for s in pii.model_spans(model, [t])[0]]
    monkeypatch.setattr(pii, "PIECE", 3000)
    assert [s[:3] for s in pii.model_spans(model, [t])[0]] == one and len(one) == 400


def test_no_place_is_ruled_out_wrongly(spark, sf_dir):
    model = pii.default_tagger()
    whole = [t for t, _ in pii.labelled_rows(500, seed=77)] + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(150).collect()]
    got = [[s[:3] for s in x] for x in pii.model_spans(model, whole)]
    assert sum(map(len, got)) > 200 and got == [[s[:3] for s in x] for x in pii.model_spans(model, whole, everywhere=True)]


def test_whole_texts_have_one_best_path():
    r = np.random.default_rng(4)
    scores, trans = r.normal(size=(100, 9)), r.normal(size=(9, 9))
    starts, lengths = np.array([0, 10, 11, 50]), np.array([10, 1, 39, 50])
    for got, a, n in zip(pii.viterbi(scores, trans, starts, lengths), starts, lengths):
        best, back = scores[a], []
        for x in scores[a + 1 : a + n]:
            back.append((best[:, None] + trans).argmax(0))
            best = (best[:, None] + trans).max(0) + x
        path = [int(best.argmax())]
        for b in back[::-1]:
            path.append(int(b[path[-1]]))
        assert got.tolist() == path[::-1]
    x = r.integers(0, pii.N_CODES, (48, 70))
    model = pii.new_tagger(16, 1)
    assert np.allclose(pii.read_windows(model, x).transpose(0, 2, 1), pii.emissions(model, x)[0], atol=1e-4)


def test_detect(spark, docs, none):
    model = pii.default_tagger()
    extra = spark.createDataFrame([(90, "write to a.b@c.de or +1 (988) 555-2485 or 1.2.3.4 or 4111 1111 1111 1111.")], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.detect(docs.select("doc_id", "text").unionByName(extra), model).collect()}
    assert (got[90].n_email, got[90].n_phone, got[90].n_ip, got[90].n_card) == (1, 1, 1, 1)
    assert got[44].base_sha256 == hashlib.sha256(b"").hexdigest() and got[44].spans == ""
    assert pii.detect(none, model).count() == 0
    out = pii.redact(extra, model).first().text
    assert out == "write to <EMAIL> or <PHONE> or <IP> or <CARD>."
    kept = pii.redact(docs, model)
    assert kept.columns == docs.columns and keyed(kept.collect(), *docs.columns) == keyed(docs.collect(), *docs.columns)


# 9


def test_pieces_are_the_library_s(spark, docs, none):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES_FILE)
    out = pieces.encode_documents(docs, PIECES_FILE)
    got = keyed(out.collect(), "doc_id", "n_pieces", "ids")
    assert got == sorted(((d, len(i := sp.encode(t or "")), i) for d, t, *_ in odd_rows()), key=repr)
    assert all(r.round_trip for r in out.collect())
    back = keyed(pieces.decode_documents(out, PIECES_FILE).collect(), "doc_id", "text")
    assert back == sorted(((d, t or "") for d, t, *_ in odd_rows()), key=repr)
    assert pieces.encode_documents(none, PIECES_FILE).count() == 0


def test_round_trip_is_told_by_decoding(spark):
    rows = spark.createDataFrame([(1, "plain é text"), (2, "a▁b"), (3, None)], "doc_id long, text string")
    out = pieces.encode_documents(rows, PIECES_FILE)
    assert keyed(out.collect(), "doc_id", "round_trip") == [(1, True), (2, False), (3, True)]
    assert out.where("n_pieces <> size(ids)").count() == 0


def test_pieces_on_random_text():
    import sentencepiece

    sp, mine, r = sentencepiece.SentencePieceProcessor(model_file=PIECES_FILE), pieces.Encoder(PIECES_FILE), random.Random(3)
    tests = ["".join(r.choices("aaabbe  \n▁the in0 1éñ日本x😀\t\U0010ffff", k=r.randint(0, 30))) for _ in range(5000)] + ["a" * k for k in range(40)] + [" " * k for k in range(40)]
    assert [x.tolist() for x in mine.encode(tests)] == sp.encode(tests)


def test_suffix_array():
    r = random.Random(7)
    s = "".join(r.choices("ab", k=200))
    order = pieces.suffix_array(np.array([ord(c) for c in s]), 16)
    assert [s[i : i + 16] for i in order] == sorted(s[i : i + 16] for i in range(200))


# 10


def page(body, title="t"):
    return f"<html><head><title>{title}</title></head><body>{body}</body></html>"


MENU = "Home page and news and all about us and where to find the shop in town"


@pytest.mark.parametrize(
    "html,want",
    [
        ("<nav>x</nav><article><h1>A &amp; B</h1><p>one\n two</p></article><footer>f</footer>", "A & B\none two"),
        ("<header>h</header><main><p>a<p>b<ul><li>c<li>d</ul></main><aside>s</aside>", "a\nb\nc\nd"),
        ('<article><p>a</p><div id="comments"><p>hey</p></div><p>b</p><div class="side-by-side skip">c</div><div class="ad">buy</div></article>', "a\nb\nc\nbuy"),
        ("<article>a <math><mi>x</mi></math> b <svg><text>s</text></svg><p hidden>h</p><noscript><p>n</p></noscript></article>", "a x b s\nh\nn"),
        ("<article><p><b>open<br><p>next</p></article>", "open\nnext"),
        ("<article><p>x</p><script>if (a<b) {'</p>'}</script><style>p{}</style><form>f</form><p>y&nbsp;z</p></article>", "x\ny z"),
        ("", ""), (None, ""), ("<article></article>", ""), ("<p>bare", "bare"), ('<article><p title="a>b">k</p></article>', "k"),
    ],
)
def test_structure(spark, html, want):
    df = spark.createDataFrame([(1, "http://h/1", page(html) if html is not None else None, "x", 3)], "page_id long, url string, html string, text string, n_chars int")
    r = extract.main_text(df).collect()
    assert len(r) == 1 and r[0].text == want and r[0].n_chars == len(want)


PAGES = "page_id long, url string, html string"


def texts_of(df, **how):
    return {r.page_id: r.text for r in extract.main_text(df, **how).collect()}


def test_boilerplate_of_a_host(spark):
    """Runs that pages of a host share go, unique runs stay, other hosts and copied articles are left alone."""
    rows = [(k, f"http://a/{k}", page(f"<div>{MENU}</div><div>own words of page number {k} here</div>")) for k in range(6)]
    rows += [(10, "http://b/1", page(f"<div>{MENU}</div>")), (11, "http://c/1", page(f"<article><p>{MENU}</p></article>")), (12, "http://c/2", page(f"<article><p>{MENU}</p></article>")), (None, None, page(f"<div>{MENU}</div>"))]
    df = spark.createDataFrame(rows, PAGES)
    assert texts_of(df) == {k: f"own words of page number {k} here" for k in range(6)} | {10: MENU, 11: MENU, 12: MENU, None: MENU}
    assert texts_of(df, repetition=False)[0] == f"{MENU}\nown words of page number 0 here"


def test_copies_on_a_host_stay(spark):
    """Copies of a page, a print version, and a passage of two pages are content; what pages of different content repeat is not."""
    r = random.Random(2)
    story, passage = words(r, 80), words(r, 20)
    bodies = [f"<div>{MENU}</div><div>{story}</div>"] * 4 + [f"<div>{story}</div><div>printed</div>"]
    bodies += [f"<div>{MENU}</div><div>{words(r, 30)} {passage}</div>" for _ in range(2)] + [f"<div>{MENU}</div><div>{words(r, 30)}</div>" for _ in range(3)]
    alone = [f"<div>{story}</div>"] * 3
    df = spark.createDataFrame([(k, f"http://a/{k}", page(b)) for k, b in enumerate(bodies)] + [(50 + k, f"http://m/{k}", page(b)) for k, b in enumerate(alone)], PAGES)
    want = {k: re.sub("</?div>", "", b.replace(f"<div>{MENU}</div>", "").replace("</div><div>", "\n")) for k, b in [*enumerate(bodies), *enumerate(alone, 50)]}
    assert texts_of(df) == want


def test_places_and_bars(spark):
    """A place whose blocks are mostly repeated goes with its unique blocks, in an article too; a bar on most pages of a host
    goes from articles; a passage of a few articles stays. Many shards give the same."""
    r = random.Random(3)
    ads, bar, passage = [words(r, 6) for _ in range(4)], words(r, 12), words(r, 30)
    rows, want = [], {}
    for k in range(120):
        own = [words(r, 40), passage if k % 12 == 0 else words(r, 15)]
        ad = words(r, 6) if k == 7 else ads[k % 4]
        rows.append((k, f"http://a/{k}", page(f'<div class="box">{ad}</div><article><h1>title {k}</h1><p>{own[0]}</p><div class="promo">{ad}</div><p>{bar}</p><p>{own[1]}</p></article>')))
        want[k] = "\n".join([f"title {k}", *own])
    df = spark.createDataFrame(rows, PAGES)
    assert texts_of(df) == want
    assert texts_of(df, shard_pages=40) == want
    off = texts_of(df, repetition=False)
    assert all(off[k] != want[k] for k in want)


def test_names_of_classes_say_nothing(spark):
    want = "first\nThe banner was unfurled.\nHe is related to me."
    df = spark.createDataFrame([(1, "http://h/1", page('<article><p>first</p><p class="banner">The banner was unfurled.</p><p class="related">He is related to me.</p></article>'))], PAGES)
    assert texts_of(df) == {1: want}


@pytest.mark.parametrize("article", [True, False])
def test_posts_with_quotes_stay(spark, article):
    """Posts of one class with own words and quotes that two posts share, beside ordinary hosts whose adverts go."""
    r = random.Random(5)
    wrap = (lambda b: f"<article>{b}</article>") if article else (lambda b: b)
    quotes, ads = [words(r, 40) for _ in range(10)], [words(r, 8) for _ in range(20)]
    rows, want = [], {}
    for k in range(20):
        own = words(r, 30)
        rows.append((k, f"http://forum/{k}", page(wrap(f'<div class="post"><p>{own}</p><blockquote>{quotes[k // 2]}</blockquote></div>'))))
        want[k] = f"{own}\n{quotes[k // 2]}"
    for k in range(300):
        own = words(r, 30)
        rows.append((1000 + k, f"http://ordinary{k % 60}/{k}", page(f'<div class="ad">{ads[k % 20]}</div><article><p>{own}</p></article>')))
        want[1000 + k] = own
    assert texts_of(spark.createDataFrame(rows, PAGES)) == want


def test_a_paragraph_of_four_pages(spark):
    """Eight hosts of six pages, a paragraph on four of each six: the paragraph may go, what is unique stays."""
    r = random.Random(6)
    rows, own = [], {}
    for h in range(8):
        shared = words(r, 20)
        for k in range(6):
            own[h * 6 + k] = words(r, 25)
            rows.append((h * 6 + k, f"http://h{h}/{k}", page(f'<div class="text"><p>{own[h * 6 + k]}</p>' + (f"<p>{shared}</p>" if k < 4 else "") + "</div>")))
    assert texts_of(spark.createDataFrame(rows, PAGES)) == own


def brute_text(rows):
    """The whole result by comparing every run, block and class with all others; hosts are small, so each is one shard."""
    least = extract.MIN_RUN
    found = [[x for x in extract.blocks_of(h) if x[0] != extract.CHROME] for _, _, h in rows]
    content = ["\n".join([t for k, _, t in b if k == extract.ARTICLE] or [t for _, _, t in b]) for b in found]
    streams = [extract.stream_of([t for _, _, t in b]) for b in found]
    host = [u.split("/")[2] for _, u, _ in rows]
    where = {}
    for i, s in enumerate(streams):
        for k in range(len(s) - least + 1):
            where.setdefault((host[i], tuple(s[k : k + least])), set()).add(content[i])
    with_block = {}
    for i, b in enumerate(found):
        for _, place, t in b:
            if place:
                with_block.setdefault(t, set()).add(content[i])
    often = {t: len(c) >= 3 for t, c in with_block.items()}
    seen, here = {}, {}
    for i, b in enumerate(found):
        for _, place, t in b:
            if place:
                seen.setdefault(place, []).append(often[t])
                here.setdefault((host[i], place), []).append(often[t])
    bad = lambda h, p: sum(x) >= 0.9 * len(x) if len(x := here[h, p]) >= 10 else len(seen[p]) >= 10 and sum(seen[p]) >= 0.9 * len(seen[p])
    out = {}
    for i, (b, s) in enumerate(zip(found, streams)):
        pages_ = len({content[j] for j in range(len(rows)) if host[j] == host[i]})
        times = [len(where[host[i], tuple(s[k : k + least])]) for k in range(len(s) - least + 1)] + [0] * least
        kept, at = [], 1
        for kind, place, t in b:
            ws = t.split(" ")
            need = max(5, -(-pages_ // 2)) if kind == extract.ARTICLE else max(3, -(-pages_ * 2 // 100))
            mark = [any(times[k] >= need for k in range(max(0, j - least + 1), j + 1)) for j in range(at, at + len(ws))]
            runs, j = [False] * len(ws), 0
            while j < len(ws):
                e = j
                while e < len(ws) and mark[e] == mark[j]:
                    e += 1
                if mark[j] and (e - j >= least or all(mark)):
                    runs[j:e] = [True] * (e - j)
                j = e
            left = " ".join(w for w, m in zip(ws, runs) if not m)
            gone = place and (often[t] and not place.startswith("@") or bad(host[i], place))
            if left and not gone:
                kept.append(left)
            at += len(ws) + 1
        out[rows[i][0]] = "\n".join(kept)
    return out


@pytest.mark.parametrize("seed, in_tasks", [(0, extract.FEW), (1, 0), (2, extract.FEW), (3, 0)])
def test_whole_texts_against_brute_force(spark, seed, in_tasks):
    r = random.Random(seed)
    bars, ads, quotes = ([words(r, n) for _ in range(m)] for n, m in ((12, 3), (5, 6), (15, 8)))
    rows = []
    for k in range(90):
        parts = [f"<div>{bars[k % 3]}</div>"] * (r.random() < 0.6) + [f'<div class="ad{k % 2}">{r.choice(ads) if r.random() < 0.95 else words(r, 5)}</div>'] * (r.random() < 0.8)
        inner = [f"<p>{words(r, r.randint(3, 30))}</p>" for _ in range(r.randint(1, 4))] + [f'<div class="quote">{r.choice(quotes)}</div>'] * (r.random() < 0.3) + [f'<p class="more">{r.choice(ads)}</p>'] * (r.random() < 0.4)
        r.shuffle(inner)
        body = "".join(parts) + (f"<article>{''.join(inner)}</article>" if r.random() < 0.7 else "".join(inner)) + f"<p>{r.choice(bars)} {words(r, 4)}</p>" * (r.random() < 0.3)
        rows.append((k, f"http://h{r.choice([0, 0, 0, 1, 2, 3, 4])}/{k}", page(body)))
    assert texts_of(spark.createDataFrame(rows, PAGES).repartition(4), in_tasks=in_tasks) == brute_text(rows)


def test_blocks_go_from_their_own_row(spark):
    """Two rows of one page id and address, whose blocks in classes are the same in other places: whether blocks go in the tasks or by a join, each row loses its own."""
    r = random.Random(5)
    bar, apart = '<div class="bar">buy our things now</div>', [f"<p>{words(r, 12)}</p>" for _ in range(8)]
    rows = [(1, "http://a/1", page(bar + apart[0])), (1, "http://a/1", page(apart[1] + bar))] + [(k, f"http://a/{k}", page(bar + apart[k])) for k in range(2, 8)]
    pages = spark.createDataFrame(rows, PAGES)
    got = [sorted(tuple(x) for x in extract.main_text(pages, in_tasks=n).select("page_id", "text").collect()) for n in (extract.FEW, 0)]
    assert got[0] == got[1] == sorted((x[0], t[3:-4]) for x, t in zip(rows, apart))


def test_the_array_decides_on_the_pages(spark):
    """On the given pages the articles remain, and without the array every page would keep an advert."""
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got, off = texts_of(df), texts_of(df, repetition=False)
    want = {r.page_id: " ".join(html.unescape(re.sub("<[^>]+>", " ", re.search("<article>(.*?)</article>", r.html, re.S)[1])).split()) for r in df.collect()}
    assert sum(" ".join(got[k].split()) == want[k] for k in want) >= 0.95 * len(want)
    assert sum(off[k] != got[k] for k in want) >= 0.9 * len(want)


def test_odd_pages(spark):
    odd = [(None, None, None), (None, None, None), (1, "", ""), (1, "http://h/1", page("<p>a</p>")), (1, "http://h/1", page("<p>a</p>")), (2, "no url", page("<p>" + "long text " * 50_000 + "</p>"))]
    df = spark.createDataFrame([(*x, "y", 5) for x in odd], PAGES + ", text string, host string")
    got = keyed(extract.main_text(df).collect(), "page_id", "text", "n_chars")
    assert got == sorted([(None, "", 0)] * 2 + [(1, "", 0)] + [(1, "a", 1)] * 2 + [(2, ("long text " * 50_000).strip(), 499_999)], key=repr)
    assert extract.main_text(spark.createDataFrame([], PAGES)).count() == 0


def test_repeated_against_all_windows():
    r = random.Random(8)
    for _ in range(30):
        pages_ = [["".join(r.choices("ab", k=1)) if r.random() < 0.2 else " ".join(r.choices("abc", k=r.randint(1, 12))) for _ in range(r.randint(0, 4))] for _ in range(r.randint(1, 12))]
        owners, contents = [r.randint(0, 8) for _ in pages_], [r.randint(0, 6) for _ in pages_]
        streams = [extract.stream_of(b) for b in pages_]
        times, whole = extract.repeated(streams, owners, contents, 4)

        def different(found):
            least = {}
            for i in found:
                least[owners[i]] = min(least.get(owners[i], 99), contents[i])
            return len(set(least.values()))

        windows = [[tuple(s[i : i + 4]) for i in range(len(s) - 3)] for s in streams]
        for i, s in enumerate(streams):
            want = [different([j for j, w in enumerate(windows) if s_ in w]) for s_ in windows[i]]
            assert times[i][: len(want)].tolist() == [max(w, 1) for w in want] and (times[i][len(want) :] == 1).all()
            cover = extract.covered(times[i], 2, 4)
            at = 1
            for k, b in enumerate(pages_[i]):
                n = b.count(" ") + 1
                equal = n < 4 and different([j for j, p in enumerate(pages_) if b in p]) > 1
                if n != 3:
                    assert whole[i][k] == (equal or bool(cover[at : at + n].all()))
                at += n + 1
