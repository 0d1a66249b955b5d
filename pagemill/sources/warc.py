"""WARC files as rows: a Python data source, and the same reader over binary columns."""

from __future__ import annotations

import io
import re
import zlib
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from pagemill import ship
from pagemill.arrow import by_row, map_rows
from pagemill.formats import parsers
from pagemill.functions import charsets
from pagemill.sources import archive

SCHEMA = "path string, target_uri string, warc_type string, http_status int, content_type string, headers map<string,string>, payload binary"
COLUMNS = ("target_uri", "warc_type", "http_status", "content_type", "headers", "payload")
FALLBACK = "http://127.0.0.1"


def unchunked(body: bytes) -> bytes:
    """The body of a chunked transfer; what does not follow that form stays as it is."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return body if not out else b"".join(out)
        try:
            n = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return body if not out else b"".join(out)
        if n == 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + n])
        at = end + 2 + n + 2


def header_lines(readline) -> tuple[dict[str, str], bool]:
    """Lines up to the empty one, and whether there was one; a repeated name keeps its last value."""
    out: dict[str, str] = {}
    last, ended = None, False
    while line := readline():
        line = line.rstrip(b"\r\n")
        if not line:
            ended = True
            break
        if line[:1] in b" \t" and last:
            out[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        k, _, v = line.partition(b":")
        last = k.decode("latin-1").strip().lower()
        out[last] = v.decode("utf-8", "replace").strip()
    return out, ended


def damaged(warc: dict[str, str], payload: bytes) -> dict:
    """What stands for a record that cannot be read: of type "damaged", so no page or document comes of it but a dead letter."""
    return {"target_uri": warc.get("warc-target-uri", "").strip("<>") or FALLBACK, "warc_type": "damaged", "http_status": None, "content_type": None, "headers": warc, "payload": payload}


#: No cell of a frame holds more.
LARGEST = (1 << 31) - 1
INSIDE = re.compile(rb"\n(?=WARC/[0-9]\.[0-9]+\r?\n[A-Za-z][A-Za-z0-9-]*:)")


def blocks(s: archive.Stream, stop: int | None, exit_at: list[int], bodies: bool = True) -> Iterator[tuple[dict, bytes, bool]]:
    """(header, block, good) of the records that begin before ``stop``, from where the stream is; ``exit_at`` gets the place of the first that does not, or the file's size.

    A length is believed if a record or the end follows its block. If not, and a record begins inside the block, the length is too large: the
    record is damaged and reading goes on there. If none does, something else follows the record, which is passed over up to the next line that begins one.
    All that is passed over in one stretch gives one damaged record."""
    lost: tuple[dict, bytes] | None = None
    while True:
        s.drop()
        place = s.place()
        line = s.line()
        if not line:
            if s.broken:
                lost = lost or ({}, b"")
                if s.recover():
                    continue
            if lost:
                yield *lost, False
            exit_at.append(s.size)
            return
        if not line.startswith(b"WARC/"):
            if line.strip():
                lost = (lost[0], (lost[1] + line)[:1000]) if lost else ({}, line[:1000])
            continue
        if lost:
            yield *lost, False
            lost = None
        if stop is not None and place is not None and place >= stop:
            exit_at.append(place)
            return
        header, ended = header_lines(s.line)
        length = header.get("content-length", "0")
        if not ended or not length.isascii() or not length.isdigit() or int(length) > LARGEST:
            lost = (header, b"")
            continue
        n = int(length)
        if not s.fits(n):
            here = s.at
            if not s.packed and s.place() + n > s.size:
                lost = (header, b"")  # longer than the file: the next line that begins a record is looked for
                continue
            inside = s.take(n)
            m = INSIDE.search(b"\n" + inside + s.take(200))  # the first lines of what begins in the block may reach out of it
            begins = m.end() - 1 if m and m.end() <= n else None
            if begins is not None or len(inside) < n:
                lost = (header, inside[: 1000 if begins is None else min(begins, 1000)])
                s.at = here + (len(inside) if begins is None else begins)
                continue
            s.at = here
        if bodies:
            yield header, s.take(n), True
        else:
            s.skip(n)


def rows_of(s: archive.Stream, stop: int | None = None, exit_at: list[int] | None = None) -> Iterator[dict]:
    for warc, block, good in blocks(s, stop, [] if exit_at is None else exit_at):
        if not good:
            yield damaged(warc, block)
            continue
        kind, status, mime, headers, payload = warc.get("warc-type", ""), None, None, {}, block
        if block.startswith(b"HTTP/"):
            inner = io.BytesIO(block)
            first = inner.readline().split()
            status = int(first[1]) if len(first) > 1 and first[1].isdigit() else None
            headers, _ = header_lines(inner.readline)
            payload = inner.read()
            mime = headers.get("content-type")
            if "chunked" in headers.get("transfer-encoding", "").lower():
                payload = unchunked(payload)
            if headers.get("content-encoding", "").lower() in ("gzip", "x-gzip", "deflate"):
                try:
                    payload = zlib.decompress(payload, 47) if "gzip" in headers["content-encoding"].lower() else zlib.decompress(payload)
                except zlib.error:
                    pass
        uri = warc.get("warc-target-uri", "").strip("<>")
        yield {"target_uri": uri if "://" in uri else FALLBACK if kind == "response" else uri, "warc_type": kind, "http_status": status, "content_type": mime, "headers": headers, "payload": payload}


def records(file) -> Iterator[dict]:
    """All records of a seekable file in order; a row of type "damaged" stands for what could not be read."""
    yield from rows_of(archive.opened(file))


class FilePartition(InputPartition):
    def __init__(self, uri: str):
        self.uri = uri


class WarcReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[FilePartition]:
        """A partition for each file; ``read_warc`` divides large ones."""
        return [FilePartition(uri) for uri, _ in listed(self.path)]

    def read(self, partition: FilePartition):
        store, path = fs.FileSystem.from_uri(partition.uri)
        with store.open_input_file(path) as f:
            for r in records(f):
                yield (partition.uri, *(r[c] for c in COLUMNS))


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(path)``: a file or a folder of .warc and .warc.gz files."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"])


def listed(path: str, name: str = ".warc") -> list[tuple[str, int]]:
    """(address, size) of a file, or of the files in a folder and below whose names hold ``name``."""
    store, root = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    info = store.get_file_info(root)
    files = [info] if info.is_file else [f for f in store.get_file_info(fs.FileSelector(root, recursive=True)) if f.is_file and name in f.base_name]
    prefix = path.split("://")[0] if "://" in path else "file"
    return [(f"{prefix}://{f.path}", f.size) for f in sorted(files, key=lambda f: f.path)]


RANGES = "uri string, size long, part long, start long, end long, entry long"
#: Ranges are as many at most, so that the list of them is of bounded size; beyond that they get longer.
MOST_RANGES = 200_000
#: How often ranges are probed anew before the rest of a file that still does not fit is read by one task, and over how many ranges one probe goes on.
ROUNDS, REACH = 8, 256


def probe(ranges: DataFrame) -> DataFrame:
    """part, entry, first_after: where a range begins to read and where the next record after it begins. A null entry is looked for (-1: the range begins no record).

    With a given entry the probe goes on over the next ranges, until one of them is found to begin where its guess says."""

    def rows(it):
        for r in it:
            store, path = fs.FileSystem.from_uri(r["uri"])
            with store.open_input_file(path) as f:
                s = archive.opened(f, r["size"])
                part, entry, length = r["part"], r["entry"], r["split"]
                if entry is None:
                    entry = s.entry(r["start"], r["end"])
                    if entry is None:
                        yield {"uri": r["uri"], "part": part, "entry": -1, "first_after": None}
                        continue
                while True:
                    after: list[int] = []
                    s.jump(entry)
                    for _ in blocks(s, min((part + 1) * length, r["size"]), after, bodies=False):
                        pass
                    yield {"uri": r["uri"], "part": part, "entry": entry, "first_after": after[0]}
                    ahead = after[0] // length - r["part"] - 1
                    if after[0] >= r["size"] or ahead >= len(r["guesses"]) or r["guesses"][ahead] == after[0]:
                        break
                    for skipped in range(part + 1, after[0] // length):
                        yield {"uri": r["uri"], "part": skipped, "entry": -1, "first_after": None}
                    part, entry = after[0] // length, after[0]

    return map_rows(ranges, rows, "uri string, part long, entry long, first_after long")


#: Small ranges are read by one task up to so many bytes, as long as every core has one.
TASK_BYTES = 16 << 20


def tasks_for(spark: SparkSession, ranges: list[tuple]) -> int:
    total = sum(r[4] - r[3] for r in ranges)
    return max(1, min(len(ranges), 10_000, max(-(-total // TASK_BYTES), 2 * spark.sparkContext.defaultParallelism)))


def ranges_of(spark: SparkSession, files: list[tuple[str, int]], split_bytes: int) -> list[tuple]:
    """Where each range of each file begins to read, so that every record is read once: (uri, size, part, start, end, entry).

    Each range looks for a record on its own and follows the lengths to the first record beyond it. That must be where the next range begins; if not, what the
    range has found only looks like a record (inside a payload), and it is probed anew from where it must begin. The list of ranges is on the
    driver, as Spark's own list of file splits is."""
    split = max(split_bytes, -(-sum(size for _, size in files) // MOST_RANGES), 1)
    cut = {uri: [(uri, size, k, k * split, min(size, (k + 1) * split), None if k else 0) for k in range(max(1, -(-size // split)))] for uri, size in files}
    many = [uri for uri, parts in cut.items() if len(parts) > 1]
    known: dict[tuple[str, int], tuple[int, int | None]] = {}
    ask = [(*r, split, []) for uri in many for r in cut[uri]]
    rest: dict[str, tuple[int, int]] = {}
    for k in range(ROUNDS + 1):
        if ask:
            found = probe(spark.createDataFrame(ask, RANGES + ", split long, guesses array<long>").repartition(tasks_for(spark, ask), "uri", "part"))
            known |= {(r["uri"], r["part"]): (r["entry"], r["first_after"]) for r in found.collect()}
        ask = []
        for uri in many:
            due = 0
            for r in cut[uri]:
                begins = due if due < r[4] else -1
                entry, after = known[uri, r[2]]
                if entry != begins and begins >= 0:
                    ask.append((*r[:5], begins, split, [known[uri, p][0] for p in range(r[2] + 1, min(r[2] + 1 + REACH, len(cut[uri])))]))
                    rest[uri] = (r[2], begins)
                    break  # what the later ranges say is looked at when this one is right
                if begins < 0:
                    known[uri, r[2]] = entry, after = -1, None
                due = after if after is not None else due
            else:
                rest.pop(uri, None)
    out = [(*r[:5], known[uri, r[2]][0] if len(parts) > 1 else 0) for uri, parts in cut.items() for r in parts if uri not in rest or r[2] < rest[uri][0]]
    return out + [(uri, size, rest[uri][0], rest[uri][1], size, rest[uri][1]) for uri, size in files if uri in rest]


def read_ranges(ranges: DataFrame) -> DataFrame:
    """The records of ranges whose places to begin are known."""

    def rows(it):
        for r in it:
            store, path = fs.FileSystem.from_uri(r["uri"])
            with store.open_input_file(path) as f:
                s = archive.opened(f, r["size"])
                s.jump(r["entry"])
                for x in rows_of(s, r["end"]):
                    yield x | {"path": r["uri"]}

    return map_rows(ranges, rows, SCHEMA, size=50)


def read_files(spark: SparkSession, files: list[tuple[str, int]], split_bytes: int = 64 << 20) -> DataFrame:
    """The records of files given by address and size; a large file is read by several tasks."""
    ship.ensure(spark)
    if not files:
        return spark.createDataFrame([], SCHEMA)
    ranges = [r for r in ranges_of(spark, files, split_bytes) if r[5] >= 0]
    return read_ranges(spark.createDataFrame(ranges, RANGES).repartition(tasks_for(spark, ranges), "uri", "part"))


def read_warc(spark: SparkSession, path: str, split_bytes: int = 64 << 20) -> DataFrame:
    """The records of a file, or of the WARC files in a folder. Plain files and those with a gzip member for each record can be read from many places at once."""
    return read_files(spark, listed(path), split_bytes)


def warc_rows(files: DataFrame) -> DataFrame:
    """The same for a frame of (path, content), as the binaryFile source gives it; works on any store that Spark reads."""

    def rows(it):
        for f in it:
            for r in records(io.BytesIO(f["content"])):
                yield r | {"path": f["path"]}

    return map_rows(files.select("path", "content"), rows, SCHEMA, size=50)


def responses(warc: DataFrame) -> DataFrame:
    """Responses of status 200 with a mime type that a parser takes, or none."""
    mime = F.lower(F.trim(F.substring_index("content_type", ";", 1)))
    known = F.array(*[F.lit(m) for m in sorted(set(parsers.BY_MIME) - parsers.DENIED)])
    return warc.where((F.col("warc_type") == "response") & (F.col("http_status") == 200) & (F.col("content_type").isNull() | F.array_contains(known, mime)))


def to_documents(warc: DataFrame) -> DataFrame:
    """Documents of all supported responses; rows with an error are the dead letters."""
    charset = F.regexp_extract("content_type", r"(?i)charset=[\"']?([^\s;\"']+)", 1)
    return parsers.parse_documents(responses(warc).select(F.col("target_uri").alias("url"), F.lower(F.trim(F.substring_index("content_type", ";", 1))).alias("mime"), F.nullif(charset, F.lit("")).alias("charset"), F.col("payload").alias("content")))


def decoded(payload: Column, content_type: Column) -> Column:
    """Text of a page's bytes: by the byte order mark, else the charset of the header, else of the markup's first kilobyte, else UTF-8 if the bytes
    are that, else windows-1252. Bytes that the charset does not know become the replacement character; an unknown charset counts as none."""
    return by_row(lambda p, c: None if p is None else charsets.text_of(bytes(p), c), "string")(payload, content_type)


def dead_letters(warc: DataFrame) -> DataFrame:
    """(path, source, error) of the records that could not be read."""
    return warc.where("warc_type = 'damaged'").select("path", F.col("target_uri").alias("source"), F.lit("damaged record").alias("error"))


def to_pages(warc: DataFrame) -> DataFrame:
    """HTML responses as rows for the index record."""
    r = responses(warc).where(F.col("content_type").isNull() | F.col("content_type").contains("html"))
    return r.select(F.col("target_uri").alias("url"), decoded(F.col("payload"), F.col("content_type")).alias("html"), F.lower(F.trim(F.substring_index("content_type", ";", 1))).alias("mime"), "http_status", "headers")


def write_record(url: str, payload: bytes, status: int = 200, mime: str = "text/html", kind: str = "response", extra: str = "") -> bytes:
    """One record, for tests and examples."""
    body = f"HTTP/1.1 {status} OK\r\nContent-Type: {mime}\r\n{extra}\r\n".encode() + payload if kind == "response" else payload
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: <{url}>\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"
