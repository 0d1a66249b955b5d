"""Main text of web pages, with boilerplate found by a suffix array for each host.

A page's markup is read into blocks. Elements that by their meaning are no part of the text
(menus, headers and footers of the page, sidebars, forms, reader comments) are left out; of all else
the repetition on the host decides, wherever it stands. The token streams of a host's pages are
concatenated, and a suffix array over them finds what distinct pages share:

* Runs of ``MIN_RUN`` tokens or more (block ends count as tokens) that are on ``MIN_PAGES`` pages of different content,
  or on ``MIN_SHARE`` of them if that is more, are cut out of blocks outside articles.
* In blocks of an article (inside article or main elements) only runs on ``ROOT_SHARE`` of the host's pages of different content
  are cut: a copied article or a shared passage is content, a bar on most pages is not.
* Adverts and the like change from page to page of a host and are the same on many hosts. So blocks that stand in a class (``place_of``) are also compared over all hosts,
  as wholes: outside articles a block that ``MIN_PAGES`` pages of different content have goes, and only that block.
* What is unique goes only with a place of which nearly nothing is: if ``PLACE_SHARE`` of the blocks of a class on the host (over all hosts, where this one has fewer than ``PLACE_BLOCKS`` of them) are each
  on ``MIN_PAGES`` pages of different content, the class holds boilerplate, and all its blocks go, in articles too. Names of classes say nothing by themselves.

Pages of equal text, markup aside (mirrors, copies), count as one. A host of many pages is dealt out in shards
of about ``SHARD_PAGES`` pages and ``SHARD_BYTES`` of markup by a hash of the page, each with an array of its
own; shares are what they are of the whole, within sampling. Blocks in classes are counted over all shards.

Defined results: a null or empty page gives empty text; a null url stands for the
empty host; a null page_id stays null, and rows without one that are equal count as one page; copies of a page (one page_id) do not
count as distinct pages; markup may be unclosed; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html as references
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.base import map_arrow, slices, texts, written
from pagemill.llm.pieces import suffix_array

MIN_RUN = 8
MIN_PAGES, MIN_SHARE = 3, 0.02
ROOT_PAGES, ROOT_SHARE = 5, 0.5
PLACE_SHARE, PLACE_BLOCKS = 0.9, 10
SHARD_PAGES, SHARD_BYTES = 500, 4 << 20

RAW = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(script|style|template|textarea|iframe|select|title)\b(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+'|[\"'])*>.*?(?:</\1\s*+[^>]*+>|\Z)", re.S | re.I)
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^\"'>]++|\"[^\"]*+\"|'[^']*+'|[\"'])*?)>|<[!?][^>]*+>", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder semantics svg text tspan g path object canvas noscript".split())
CHROME_TAGS = frozenset("nav footer aside form button head menu dialog fieldset datalist".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
#: Reader comments have no element of their own; these are whole class names or ids.
COMMENTS = frozenset("comment comments comment-list commentlist comments-area reader-comments respond replies disqus_thread".split())
ROOTS = frozenset(("article", "main"))
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table tbody thead tfoot".split())


def attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw)}


def is_chrome(tag: str, raw: str, in_root: bool) -> bool:
    """Whether an element is by its meaning no part of the text."""
    if tag in CHROME_TAGS or tag == "header" and not in_root:
        return True
    if not raw or raw.isspace():
        return False
    a = attributes(raw)
    return a.get("role", "").lower() in CHROME_ROLES or not COMMENTS.isdisjoint(f"{a.get('class', '')} {a.get('id', '')}".lower().split())


def place_of(stack: list[tuple]) -> str:
    """Where a block stands: the innermost element with a class, digits made equal, within the article or not; empty without any class."""
    root = stack[-1][2]
    for tag, _, inside, names in reversed(stack):
        if inside != root or tag in ROOTS:
            break
        if names:
            return f"{'@' if root else ''}{tag}.{names}"
    return ""


CHROME, ARTICLE, UNDECIDED = 0, 1, 2


def class_names(raw: str) -> str:
    if "class" not in raw.lower():
        return ""
    return ".".join(sorted(re.sub("[0-9]+", "0", attributes(raw).get("class", "")).lower().split()))


def blocks_of(page: str) -> list[tuple[int, str, str]]:
    """(kind, place, text) of the page's blocks in order; white space within a block is one space."""
    page = RAW.sub(" ", page)
    out: list[tuple[int, str, str]] = []
    held: list[str] = []
    stack: list[tuple[str, bool, bool, str]] = [("", False, False, "")]  # tag, in chrome, in article, classes

    def close() -> None:
        if held:
            text = " ".join(references.unescape("".join(held)).split())
            held.clear()
            if text:
                _, chrome, root, _ = stack[-1]
                out.append((CHROME, "", text) if chrome else (ARTICLE if root else UNDECIDED, place_of(stack), text))

    def pop_to(tags: tuple[str, ...], stop: frozenset) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                close()
                del stack[i:]
                return
            if stack[i][0] in stop:
                return

    at = 0
    for m in TAG.finditer(page):
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag == "br":
            held.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                close()
            continue
        if tag in INLINE and tag != "a" and tag != "label" and not m[3].strip():
            continue  # bare inline markup has no bearing on blocks
        if m[1]:
            if tag in INLINE:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        if stack[i][1] != stack[i - 1][1]:
                            close()
                        del stack[i]
                        break
                    if stack[i][0] not in INLINE:
                        break
            elif any(s[0] == tag for s in stack):
                close()
                while stack[-1][0] != tag:
                    stack.pop()
                stack.pop()
            else:
                close()
            continue
        if tag in INLINE:
            _, chrome, root, _ = stack[-1]
            odd = is_chrome(tag, m[3], root)
            if odd and not chrome:
                close()
            stack.append((tag, chrome or odd, root, ""))
            continue
        close()
        if tag in CLOSES_P:
            pop_to(("p",), frozenset(t for t in CLOSES_P if t != "p"))
        if tag in SAME:
            pop_to(SAME[tag], SCOPE)
        while len(stack) > 1 and stack[-1][0] in INLINE and not stack[-1][1]:
            stack.pop()  # inline markup left open ends with its block
        _, chrome, root, _ = stack[-1]
        root = root or tag in ROOTS or bool(m[3]) and attributes(m[3]).get("role") == "main"
        stack.append((tag, chrome or is_chrome(tag, m[3], root), root, class_names(m[3]) if m[3] else ""))
    if at < len(page):
        held.append(page[at:])
    close()
    return out


def needed(contents: int, least: int = MIN_PAGES, share: float = MIN_SHARE) -> int:
    """On how many pages of different content a run is boilerplate, of so many."""
    return max(least, -(-contents * round(100 * share) // 100))


END = "\0"


def stream_of(texts_: list[str]) -> list[str]:
    """The tokens of a page's blocks, with one before each and one at the end."""
    return [t for text in texts_ for t in (END, *text.split(" "))] + [END]


def distinct(group: np.ndarray, owner: np.ndarray, content: np.ndarray, groups: int) -> np.ndarray:
    """For each group the number of its different contents, an owner counting once, with the least of its contents."""
    big = int(content.max(initial=0)) + 1
    key = np.unique((group * (int(owner.max(initial=0)) + 1) + owner) * big + content)
    first = np.concatenate([[True], key[1:] // big != key[:-1] // big]) if len(key) else np.zeros(0, bool)
    key = key[first]
    pair = np.unique(key // big // (int(owner.max(initial=0)) + 1) * big + key % big)
    return np.bincount(pair // big, minlength=groups)


def repeated(streams: list[list[str]], owners: list[object], contents: list[int], min_run: int = MIN_RUN) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """By one suffix array over all streams: for each token of a stream the number of pages of different content that have
    the run of ``min_run`` tokens from there, and for each of its blocks whether pages of other content repeat all of it."""
    number: dict[str, int] = {END: 0}
    text = np.array([number.setdefault(t, len(number)) for s in streams for t in (*s, END)], np.int64)
    lengths = np.array([len(s) + 1 for s in streams])
    at = np.concatenate([[0], np.cumsum(lengths)])
    n = len(text)
    text[at[1:] - 1] = len(number) + np.arange(len(streams))  # each stream ends with a token of its own, so nothing runs over it
    which = np.repeat(np.arange(len(streams)), lengths)
    owner = np.unique(np.array([str(o) for o in owners]), return_inverse=True)[1][which]
    content = np.unique(np.array(contents, np.int64), return_inverse=True)[1][which]
    order = suffix_array(text, min_run)
    common = np.zeros(n, np.int8)  # tokens that a suffix shares with the one before it, as far as min_run
    same = np.ones(n - 1, bool)
    padded = np.concatenate([text, np.full(min_run, -1)])
    for k in range(min_run):
        same &= padded[order[1:] + k] == padded[order[:-1] + k]
        common[1:] += same
    group = np.cumsum(common < min_run) - 1
    shared = np.bincount(group)[group] > 1
    times = np.ones(n, np.int64)
    some = order[shared]
    times[some] = distinct(group[shared], owner[some], content[some], int(group[-1]) + 1)[group[shared]]

    # blocks stand between two ends; short ones are told by the suffix that begins with their end, to their own length
    stops = np.flatnonzero(text == 0)
    inner = which[stops[1:]] == which[stops[:-1]]
    first, size = stops[:-1][inner], (stops[1:] - stops[:-1] - 1)[inner]
    whole = np.zeros(len(first), bool)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    for k in range(1, min_run):
        pick = np.flatnonzero(size == k)
        start, reach = (first[pick], k + 2) if k + 2 <= min_run else (first[pick] + 1, k + 1)
        if len(pick):
            g = np.unique((np.cumsum(common < reach) - 1)[place[start]], return_inverse=True)[1]
            whole[pick] = distinct(g, owner[start], content[start], int(g.max()) + 1)[g] > 1
    cover = np.concatenate([[0], np.cumsum(covered(times, 2, min_run))])
    whole |= (size > 0) & (cover[first + 1 + size] - cover[first + 1] == size)
    return [times[a : b - 1] for a, b in zip(at, at[1:])], np.split(whole, np.cumsum(np.bincount(which[first], minlength=len(streams)))[:-1])


def covered(times: np.ndarray, need: int, min_run: int = MIN_RUN) -> np.ndarray:
    """Which tokens lie in a run that so many pages have."""
    edge = np.zeros(len(times) + min_run + 1, np.int64)
    start = np.flatnonzero(times >= need)
    edge[start] += 1
    edge[start + min_run] -= 1
    return np.cumsum(edge)[: len(times)] > 0


def within_block(mark: np.ndarray) -> np.ndarray:
    """Of a block's covered tokens those that are all of it, or a run of MIN_RUN: a run that only reaches
    into a block from its neighbour leaves its first or last words alone."""
    if mark.all():
        return mark
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mark.astype(np.int8), [0]])))
    out = np.zeros(len(mark), bool)
    for a, b in zip(edge[::2], edge[1::2]):
        out[a:b] = b - a >= MIN_RUN
    return out


Block = tuple[int, str, str]


def unique_runs(pages: list[list[Block]], owners: list[object], contents: list[int], repetition: bool = True) -> list[list[tuple[str, str]]]:
    """For the pages of a shard, without chrome: place, and what is left of the text, of each block."""
    texts_ = [[t for _, _, t in b] for b in pages]
    if not repetition:
        return [[(place, t) for _, place, t in b] for b in pages]
    times, _ = repeated([stream_of(t) for t in texts_], owners, contents)
    different = len(set(contents))
    low, high = needed(different), needed(different, ROOT_PAGES, ROOT_SHARE)
    out = []
    for blocks, n in zip(pages, times):
        often, mostly = covered(n, low), covered(n, high)
        kept, at = [], 0
        for kind, place, text in blocks:
            words = text.split(" ")
            mark = (mostly if kind == ARTICLE else often)[at + 1 : at + 1 + len(words)]
            if mark.any():
                mark = within_block(mark)
                text = " ".join(w for w, m in zip(words, mark.tolist()) if not m)
            kept.append((place, text))
            at += len(words) + 1
        out.append(kept)
    return out


#: Of repeated blocks, and of classes, that go to all tasks; more of them are joined to the pages.
FEW = 100_000
RESULT = "page_id long, url string, text string, n_chars long"
JUDGED = "page_id long, url string, host string, places array<string>, blocks array<string>, raw array<string>, page long, content long"


def main_text(pages: DataFrame, shard_pages: int = SHARD_PAGES, shard_bytes: int = SHARD_BYTES, repetition: bool = True, in_tasks: int = FEW) -> DataFrame:
    """page_id, url, text and n_chars of each page. Without ``repetition`` markup alone decides, for comparison."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    pages = pages.withColumn("host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#]*@)?([^/?#]*)", 1)))
    pages = pages.withColumn("page", F.when(F.col("page_id").isNull(), F.xxhash64("url", "html")).otherwise(F.xxhash64("page_id")))
    sizes = pages.groupBy(F.col("host").alias("h")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("html")).alias("size"))
    sizes = sizes.select("h", F.greatest(F.ceil(F.col("n") / shard_pages), F.ceil(F.coalesce("size", F.lit(0)) / shard_bytes)).cast("int").alias("shards")).where("shards > 1")
    few = sizes.limit(10_001).count() <= 10_000  # of hosts with shards; else they are joined
    pages = pages.join(F.broadcast(sizes) if few else sizes, F.col("host") == F.col("h"), "left")
    pages = pages.select("page_id", "url", "html", "host", "page", F.pmod("page", F.coalesce("shards", F.lit(1))).cast("int").alias("shard"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        """The pages of a batch that belong to one shard go together, packed."""
        for b in slices(batches, 2000):
            shards: dict[tuple[str, int], list[tuple]] = {}
            for page_id, url, host, shard, page, markup in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "host", "shard", "page")), texts(b.column("html"))):
                found = [x for x in blocks_of(markup) if x[0] != CHROME]
                own = [t for kind, _, t in found if kind == ARTICLE] or [t for _, _, t in found]
                content = xxhash.xxh3_64_intdigest("\n".join(own).encode("utf-8", "surrogatepass")) - 2**63
                shards.setdefault((host, shard), []).append((page, url or "", page_id, url, content, found))
            yield {"host": [h for h, _ in shards], "shard": [k for _, k in shards], "pages": [zstandard.compress(pickle.dumps(x), 3) for x in shards.values()]}

    streams = map_arrow(pages, read, "host string, shard int, pages binary")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        """Rows stand by shards, whose size is bounded."""
        key, held = None, []

        def close() -> dict:
            rows = sorted((r for x in held for r in pickle.loads(zstandard.decompress(x))), key=lambda r: r[:2])
            held.clear()
            found = [r[5] for r in rows]
            left = unique_runs(found, [r[0] for r in rows], [r[4] for r in rows], repetition)
            out = {"page_id": [r[2] for r in rows], "url": [r[3] for r in rows], "host": [key[0]] * len(rows), "page": [r[0] for r in rows], "content": [r[4] for r in rows]}
            return out | {"raw": [[t if place else None for _, place, t in b] for b in found]} | {c: [[x[k] for x in b] for b in left] for k, c in enumerate(("places", "blocks"))}

        for b in batches:
            for host, shard, packed in zip(*(b.column(c).to_pylist() for c in ("host", "shard", "pages"))):
                if (host, shard) != key:
                    if held:
                        yield close()
                    key, held = (host, shard), []
                held.append(packed)
        if held:
            yield close()

    judged = map_arrow(streams.repartition("host", "shard").sortWithinPartitions("host", "shard"), judge, JUDGED, large=True)
    judged = written(judged.withColumn("row", F.monotonically_increasing_id()), "judged", "zstd")  # written, so that a row keeps its number
    if not repetition:
        return finished(judged, None, None)
    return finished(judged, *boilerplate(judged), in_tasks)


def hashed(judged: DataFrame, *more: str) -> DataFrame:
    """A row for each block that stands in a class: its place in the page, and two hashes of its text."""
    each = judged.select("host", *more, F.posexplode(F.arrays_zip("places", "raw")).alias("at", "x")).where("x.places <> ''")
    return each.select("host", *more, "at", F.col("x.places").alias("place"), F.xxhash64("x.raw").alias("h"), F.xxhash64(F.lit(1), "x.raw").alias("g"))


def boilerplate(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(h, g) of the blocks outside articles that so many pages repeat, and (host, place) of the classes that hold boilerplate."""
    placed = hashed(judged, "content")
    often = placed.select("h", "g", "content").distinct().groupBy("h", "g").agg((F.count(F.lit(1)) >= MIN_PAGES).alias("often"))
    told = written(placed.groupBy("host", "place", "h", "g").agg(F.count(F.lit(1)).alias("n")).join(often, ["h", "g"]), "places")
    common = told.where(F.col("often") & ~F.col("place").startswith("@")).select("h", "g").distinct()
    share = lambda c: (F.sum(F.when(F.col("often"), F.col("n")).otherwise(0)) >= PLACE_SHARE * F.sum("n")).alias(c)
    here = told.groupBy("host", "place").agg(F.sum("n").alias("all"), share("bad"))
    usual = told.groupBy("place").agg((F.sum("n") >= PLACE_BLOCKS).alias("enough"), share("usually"))
    bad = here.join(usual, "place").where(F.when(F.col("all") >= PLACE_BLOCKS, F.col("bad")).otherwise(F.col("enough") & F.col("usually"))).select("host", "place")
    return written(common, "common"), written(bad, "bad")


def finished(judged: DataFrame, common: DataFrame | None, bad: DataFrame | None, few: int = FEW) -> DataFrame:
    """The pages' texts from what is left of their blocks. Where the blocks that go are few, the texts are not shuffled for that; either way the same blocks of the same row go."""
    if common is None:
        return joined_blocks(judged, F.col("blocks"))
    if common.limit(few + 1).count() > few or bad.limit(few + 1).count() > few:
        each = hashed(judged, "row")
        gone = each.join(common.withColumn("common", F.lit(True)), ["h", "g"], "left").join(bad.withColumn("bad", F.lit(True)), ["host", "place"], "left")
        cut = gone.where((F.col("common") & ~F.col("place").startswith("@")) | F.col("bad")).groupBy("row").agg(F.collect_set("at").alias("cut"))  # as many as the page has blocks
        judged = judged.join(cut, "row", "left")
        return joined_blocks(judged, F.when(F.col("cut").isNull(), F.col("blocks")).otherwise(F.transform("blocks", lambda x, i: F.when(F.array_contains("cut", i), "").otherwise(x))))
    repeated_ = {(r.h, r.g) for r in common.collect()}
    places = {(r.host, r.place) for r in bad.collect()}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in slices(batches, 500):
            out = []
            for host, where, h, g, blocks in zip(*(b.column(c).to_pylist() for c in ("host", "places", "h", "g", "blocks"))):
                out.append("\n".join([t for p, x, y, t in zip(where, h, g, blocks) if t and not (p and ((host, p) in places or p[0] != "@" and (x, y) in repeated_))]))
            yield {"page_id": b.column("page_id"), "url": b.column("url"), "text": out, "n_chars": [len(t) for t in out]}

    hashes = [F.transform("raw", f).alias(c) for c, f in (("h", lambda x: F.xxhash64(x)), ("g", lambda x: F.xxhash64(F.lit(1), x)))]
    return map_arrow(judged.select("page_id", "url", "host", "places", "blocks", *hashes), rows, RESULT)


def joined_blocks(judged: DataFrame, blocks) -> DataFrame:
    out = judged.select("page_id", "url", F.array_join(F.filter(blocks, lambda x: x != ""), "\n").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
