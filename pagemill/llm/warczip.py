"""WARC records in ZIP packages: written by tasks, read back by byte ranges.

A package holds a stored (uncompressed) member ``archive/data.warc.gz`` of gzip
members, one per record, and a stored index of their places. The
reader takes the end of the file, finds the end record (and the ZIP64 one, if
needed), reads the central directory, follows the local headers to where members
lie, reads the index and then ranges of records; nothing is extracted.

Packages lie in the shared folder of spark.checkpoint.dir. Each attempt of a task
writes packages of its own names, and the manifest, which Spark commits once for
each task, holds those of the attempt that counts; others are never read.

Names in archives are UTF-8 where the flag says so, else code page 437. A member
that is read whole must have the checksum of the directory.

Equal payloads: the row of largest page_id is written as response, all others as
revisit records that refer to it and keep the HTTP headers, so the length stays
known. Rows that repeat the largest id are all responses.

Defined results: null html is an empty payload; a null page_id ranks below all
others and is returned as null; a null url becomes an empty target; payloads below
``least`` bytes are all responses; other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.base import map_arrow, shared_folder, slices, written

MEMBER, INDEX = "archive/data.warc.gz", "indexes/index.idx"
DATE = b"2020-01-01T00:00:00Z"
NO_ID = -(2**63)

# ZIP


class ZipWriter:
    """A ZIP file of stored members, written in one pass; ``zip64`` forces the large forms, else they come when needed."""

    def __init__(self, out, zip64: bool = False):
        self.out, self.at, self.zip64, self.entries = out, 0, zip64, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, name: str, chunks) -> int:
        """Returns where the data begins. Sizes follow the data in a descriptor, as the length is not known before."""
        raw, start = name.encode(), self.at
        self._put(struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 8 | 0x800, 0, 0, 0x21, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(raw), 20) + raw + struct.pack("<HHQQ", 1, 16, 0, 0))
        data, crc = self.at, 0
        for c in chunks:
            crc = zlib.crc32(c, crc)
            self._put(c)
        size = self.at - data
        self._put(struct.pack("<IIQQ", 0x08074B50, crc, size, size))
        self.entries.append((raw, crc, size, start))
        return data

    def close(self) -> None:
        begin = self.at
        for raw, crc, size, start in self.entries:
            big = self.zip64 or max(size, start) >= 0xFFFFFFFF
            extra = struct.pack("<HHQQQ", 1, 24, size, size, start) if big else b""
            s, o = (0xFFFFFFFF, 0xFFFFFFFF) if big else (size, start)
            self._put(struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 8 | 0x800, 0, 0, 0x21, crc, s, s, len(raw), len(extra), 0, 0, 0, 0, o) + raw + extra)
        size, n = self.at - begin, len(self.entries)
        if self.zip64 or n >= 0xFFFF or max(size, begin) >= 0xFFFFFFFF:
            end64 = self.at
            self._put(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, size, begin))
            self._put(struct.pack("<IIQI", 0x07064B50, 0, end64, 1))
            n, size, begin = 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF
        self._put(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, n, n, size, begin, 0))


class ZipReader:
    """Members of a ZIP file by name, from an object with ``size()`` and ``read_at(length, offset)``."""

    def __init__(self, file):
        self.file = file
        total = file.size()
        tail_at = max(0, total - 65_557 - 20)
        tail = file.read_at(total - tail_at, tail_at)
        end = len(tail) - 22
        while end >= 0 and not (tail[end : end + 4] == b"PK\5\6" and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] == len(tail)):
            end -= 1
        if end < 0:
            raise ValueError("no end of central directory")
        n, size, begin = struct.unpack_from("<HII", tail, end + 10)
        if end >= 20 and tail[end - 20 : end - 16] == b"PK\6\7":
            record = file.read_at(56, struct.unpack_from("<Q", tail, end - 12)[0])
            if record[:4] != b"PK\6\6":
                raise ValueError("broken ZIP64 end record")
            n, size, begin = struct.unpack_from("<QQQ", record, 32)
        directory, at = file.read_at(size, begin), 0
        self.members: dict[str, tuple[int, int, int, int]] = {}  # method, crc, size, offset of the local header
        for _ in range(n):
            if directory[at : at + 4] != b"PK\1\2":
                raise ValueError("broken central directory")
            flags, method = struct.unpack_from("<HH", directory, at + 8)
            crc, packed, plain, n_name, n_extra, n_note = struct.unpack_from("<IIIHHH", directory, at + 16)
            offset, = struct.unpack_from("<I", directory, at + 42)
            name = directory[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
            k = 0
            while k + 4 <= len(extra):
                tag, length = struct.unpack_from("<HH", extra, k)
                if tag == 1:
                    wide = list(struct.unpack_from(f"<{length // 8}Q", extra, k + 4))
                    plain = wide.pop(0) if plain == 0xFFFFFFFF else plain
                    packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                    offset = wide.pop(0) if offset == 0xFFFFFFFF else offset
                k += 4 + length
            self.members[name] = (method, crc, packed, offset)
            at += 46 + n_name + n_extra + n_note

    def place(self, name: str) -> tuple[int, int]:
        """Where a stored member's data begins, and its length."""
        method, _, size, offset = self.members[name]
        if method:
            raise ValueError(f"{name} is not stored")
        head = self.file.read_at(30, offset)
        if head[:4] != b"PK\3\4":
            raise ValueError("broken local header")
        n_name, n_extra = struct.unpack_from("<HH", head, 26)
        return offset + 30 + n_name + n_extra, size

    def read(self, name: str, start: int = 0, length: int | None = None) -> bytes:
        begin, size = self.place(name)
        data = self.file.read_at(size - start if length is None else length, begin + start)
        if start == 0 and length is None and zlib.crc32(data) != self.members[name][1]:
            raise ValueError(f"{name} has another checksum")
        return data


class Opened:
    def __init__(self, handle):
        self.handle = handle

    def size(self) -> int:
        return self.handle.size()

    def read_at(self, length: int, offset: int) -> bytes:
        return self.handle.read_at(length, offset)


# WARC


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    """A name-free UUID that holds the page's id; its first half says whether there is one."""
    h = f"{0x70616765_0000_8000 if page_id is not None else 0x6e6f6e65_0000_8000:016x}{(page_id or 0) % 2**64:016x}"
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def page_of(uri: str) -> int | None:
    h = uri.strip("<>").rpartition(":")[2].replace("-", "")
    if h[:8] != "70616765":
        return None
    n = int(h[16:], 16)
    return n - 2**64 if n >= 2**63 else n


def record(page_id: int | None, url: str | None, payload: bytes, refers: tuple | None) -> bytes:
    """One WARC record; ``refers`` is (page id of the response,) for a revisit."""
    digest = digest_of(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http if refers else http + payload
    head = [
        b"WARC/1.1", b"WARC-Type: " + (b"revisit" if refers else b"response"), b"WARC-Record-ID: " + record_id(page_id).encode(), b"WARC-Date: " + DATE,
        b"WARC-Target-URI: " + quote(url or "", safe=":/?#[]@!$&'()*+,;=%~").encode(), b"WARC-Payload-Digest: sha1:" + digest.encode(), b"Content-Type: application/http;msgtype=response",
    ]
    if refers:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"WARC-Refers-To: " + record_id(refers[0]).encode()]
    return b"\r\n".join([*head, b"Content-Length: %d" % len(body), b"", body, b"", b""])


def headers(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.split(b"\r\n")[1:]:
        k, _, v = line.partition(b":")
        out[k.decode("latin-1").strip().lower()] = v.decode("utf-8", "replace").strip()
    return out


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    warc = headers(head)
    block = rest[: int(warc["content-length"])]
    if len(block) < int(warc["content-length"]):
        raise ValueError("a record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, headers(http), payload


def gzipped(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


# Jobs


def roles(pages: DataFrame, least: int = 0) -> DataFrame:
    """(pid, digest) of the revisits with the page id they refer to. ``pages`` has pid, digest and bytes."""
    slim = pages.select("pid", "bytes", "digest").where(F.col("bytes") >= least).drop("bytes")
    first = slim.groupBy("digest").agg(F.max("pid").alias("refers"), F.min("pid").alias("least")).where("least < refers").select("digest", "refers")
    return slim.join(first, "digest").where("pid < refers").select("pid", "digest", "refers").distinct()


def write_packages(pages: DataFrame, folder: str, least: int = 0, package_bytes: int = 48 << 20) -> DataFrame:
    """Writes packages and returns a row for each: path, records."""
    body = F.col("html").cast("binary")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).withColumns({"pid": F.coalesce("page_id", F.lit(NO_ID)), "bytes": F.octet_length("html"), "digest": F.sha1(body)})
    revisits = written(roles(pages, least), "revisits")
    few = revisits.limit(50_001).count() <= 50_000  # 3 MB at most; else a shuffle join
    dealt = pages.join(F.broadcast(revisits) if few else revisits, ["pid", "digest"], "left").select("page_id", "url", "html", F.col("refers").isNotNull().alias("again"), F.when(F.col("refers") != NO_ID, F.col("refers")).alias("refers"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        context = TaskContext.get()
        part, attempt = (context.partitionId(), context.taskAttemptId()) if context else (0, 0)
        store, root = arrow_fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        made: list[tuple[str, int]] = []

        def records() -> Iterator[tuple]:
            for b in slices(batches, 200):
                yield from zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "again", "refers")))

        todo = records()
        row = next(todo, None)
        while row is not None:
            name = f"part-{part:06d}-{len(made):05d}-{attempt}.wacz"
            with store.open_output_stream(f"{root}/{name}") as out:
                z = ZipWriter(out)
                index: list[bytes] = []

                def chunks() -> Iterator[bytes]:
                    nonlocal row
                    at = 0
                    while row is not None and at < package_bytes:
                        page_id, url, html, again, refers = row
                        data = gzipped(record(page_id, url, html.encode("utf-8", "surrogatepass"), (refers,) if again else None))
                        index.append(struct.pack("<QI", at, len(data)))
                        at += len(data)
                        yield data
                        row = next(todo, None)

                z.add(MEMBER, chunks())
                z.add(INDEX, [b"".join(index)])
                z.close()
            made.append((name, len(index)))
        yield {"name": [n for n, _ in made], "records": [k for _, k in made]}

    return map_arrow(dealt, rows, "name string, records long")


def record_ranges(packages: DataFrame, folder: str, each: int = 2000) -> DataFrame:
    """From each package's directory and index: byte ranges of up to ``each`` records, with the records' lengths."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        store, root = arrow_fs.FileSystem.from_uri(folder)
        for b in batches:
            for name in b.column("name").to_pylist():
                with store.open_input_file(f"{root}/{name}") as f:
                    z = ZipReader(Opened(f))
                    begin, _ = z.place(MEMBER)
                    index = list(struct.iter_unpack("<QI", z.read(INDEX)))
                for k in range(0, len(index), each):
                    part = index[k : k + each]
                    yield {"name": [name], "offset": [begin + part[0][0]], "lengths": [[n for _, n in part]]}

    return map_arrow(packages, rows, "name string, offset long, lengths array<int>")


def read_records(ranges: DataFrame, folder: str, step: int = 64) -> DataFrame:
    """The records of the ranges; a read takes ``step`` records at once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        store, root = arrow_fs.FileSystem.from_uri(folder)
        for b in batches:
            for name, offset, lengths in zip(*(b.column(c).to_pylist() for c in ("name", "offset", "lengths"))):
                with store.open_input_file(f"{root}/{name}") as f:
                    for k in range(0, len(lengths), step):
                        part = lengths[k : k + step]
                        raw, at = f.read_at(sum(part), offset), 0
                        offset += sum(part)
                        out: dict[str, list] = {c: [] for c in ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")}
                        for n in part:
                            warc, http, payload = parse(zlib.decompress(raw[at : at + n], 31))
                            at += n
                            kind = warc["warc-type"]
                            stated = warc["warc-payload-digest"].removeprefix("sha1:")
                            if kind == "response" and digest_of(payload) != stated:
                                raise ValueError(f"a payload in {name} does not match its digest")
                            for c, v in zip(out, (page_of(warc["warc-record-id"]), warc["warc-target-uri"], len(payload) if kind == "response" else int(http["content-length"]), stated, kind, page_of(warc["warc-refers-to"]) if "warc-refers-to" in warc else None, payload if kind == "response" else None)):
                                out[c].append(v)
                        yield out

    return map_arrow(ranges, rows, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write all pages and read all records back; payloads are dropped from the digest rows."""
    folder = shared_folder(pages.sparkSession, "packages")
    packages = written(write_packages(pages, folder, least), "manifest")
    n = max(1, packages.agg(F.sum("records")).first()[0] or 1)
    ranges = record_ranges(packages, folder).repartition(max(6, min(10_000, n // 4000)))
    return read_records(ranges, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
