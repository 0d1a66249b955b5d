"""Formats, WARC files and streaming jobs, on bytes made here."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import functions as F

from pagemill import shared
from pagemill.formats import parsers
from pagemill.plans import sinks
from pagemill.queries import load_time, query, table
from pagemill.sources import lookups, warc
from pagemill.streaming import jobs


def samples() -> list[tuple[str, str | None, bytes]]:
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("a.html", "<title>In zip</title><p>words</p>")
        z.writestr("b.csv", "x;y\n1;2\n")
    return [
        ("http://h/a.html", "text/html", b"<title>T</title><p>text</p>"),
        ("http://h/t.csv", None, b"a;b,c\n1;2,3\n"),
        ("http://h/f.rss", "application/rss+xml", b"<rss><channel><item><title>one</title><link>http://h/1</link><guid>1</guid></item><item><title>two</title><guid>2</guid></item></channel></rss>"),
        ("http://h/z.zip", "application/zip", inner.getvalue()),
        ("http://h/c.vcf", "text/vcard", b"BEGIN:VCARD\nFN:Ann Example\nTITLE:Chief\nURL:http://h/ann\nEND:VCARD\n"),
        ("http://h/m.mm", None, b'<map><node TEXT="root"><node TEXT="leaf"/></node></map>'),
        ("http://h/p.svg", "image/svg+xml", b'<svg xmlns="http://www.w3.org/2000/svg" width="10px" height="20"><title>pic</title></svg>'),
        ("http://h/t.torrent", None, parsers.bencode({b"comment": b"me", b"info": {b"name": b"set", b"files": [{b"path": [b"d", b"f.txt"]}]}})),
        ("http://h/r.rtf", None, rb"{\rtf1{\fonttbl x}Hello \b World\par}"),
        ("http://h/unknown.bin", None, b"\x00\x01"),
    ]


def sample_rows(spark):
    return spark.createDataFrame([(u, m, None, bytearray(b)) for u, m, b in samples()], "url string, mime string, charset string, content binary")


@query()
def parse_formats(spark, sf_dir):
    return parsers.parse_documents(sample_rows(spark))


@query("SELECT page_id, url AS target_uri, octet_length(encode(html))::BIGINT AS bytes, md5(html) AS digest FROM pages")
def warc_roundtrip(spark, sf_dir):
    """Each page as a record of a WARC file of its own, read back by the record reader."""
    pages = table(spark, sf_dir, "pages")
    url, body = F.col("url"), F.col("html").cast("binary")
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n").cast("binary")
    block = F.concat(http, body)
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: <"), url, F.lit(">\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n")).cast("binary")
    files = pages.select(F.col("page_id").cast("string").alias("path"), F.concat(head, block, F.lit("\r\n\r\n").cast("binary")).alias("content"))
    return warc.responses(warc.warc_rows(files)).select(F.col("path").cast("long").alias("page_id"), "target_uri", F.octet_length("payload").cast("long").alias("bytes"), F.md5("payload").alias("digest"))


NESTED = "\\r\\n\\r\\nWARC/1.0\\r\\nWARC-Type: response\\r\\nWARC-Target-URI: <http://nested/>\\r\\nContent-Length: 2\\r\\n\\r\\nab\\r\\n\\r\\n"


@query(f"""WITH p AS (SELECT page_id, url, html || CASE WHEN page_id % 7 = 1 THEN {"'" + NESTED.replace(chr(92) + 'r', "' || chr(13) || '").replace(chr(92) + 'n', "' || chr(10) || '") + "'"} ELSE '' END AS body FROM pages WHERE page_id % 7 <> 3)
 SELECT page_id, url AS target_uri, octet_length(encode(body))::BIGINT AS bytes, md5(body) AS digest FROM p""")
def warc_damaged_ranges(spark, sf_dir):
    """Pages as WARC files, plain and packed, read in ranges of 64 kB by several tasks. Every seventh record says that it is longer than it is, by a few bytes or by far more than its file has; another seventh
    holds what looks like a record; all but the first kind come back once, and nothing else does."""
    pages = table(spark, sf_dir, "pages")
    body = F.concat(F.col("html"), F.when(F.col("page_id") % 7 == 1, F.expr(f"'{NESTED}'")).otherwise(""))
    block = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page: "), F.col("page_id").cast("string"), F.lit("\r\n\r\n"), body)
    length = F.octet_length(block) + F.when(F.col("page_id") % 28 == 10, 2_000_000_000).when(F.col("page_id") % 7 == 3, 11).otherwise(0)
    record = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: <"), F.col("url"), F.lit(">\r\nContent-Length: "), length.cast("string"), F.lit("\r\n\r\n"), block)
    root = shared.folder(spark, "warc")
    for name, odd in (("plain", 0), ("gzip", 1)):
        lines = pages.where(F.col("page_id") % 2 == odd).select(record.alias("value")).repartition(4)
        lines.write.option("lineSep", "\r\n\r\n").option("compression", {"plain": "none"}.get(name, name)).text(f"{root}/{name}")
    files = [f for name in ("plain", "gzip") for f in warc.listed(f"{root}/{name}", "part-")]
    found = warc.responses(warc.read_files(spark, files, 64 << 10))
    return found.select(F.col("headers")["x-page"].cast("long").alias("page_id"), "target_uri", F.octet_length("payload").cast("long").alias("bytes"), F.md5("payload").alias("digest"))


@query()
def stream_jobs(spark, sf_dir):
    """The records that a job over one batch of pages gives, as the stream's batches compute them."""
    pages = table(spark, sf_dir, "pages")
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: <"), F.col("url"), F.lit(">\r\nContent-Length: "), (F.octet_length("html") + 46).cast("string"), F.lit("\r\n\r\nHTTP/1.1 200 OK\r\nContent-Type: text/html    \r\n\r\n"))
    files = pages.select(F.col("url").alias("path"), F.concat(head, F.col("html")).cast("binary").alias("content"))
    return jobs.index_of(files, load_time()).select("id", "url_s", F.try_element_at("title", F.lit(1)).alias("title"), "wordcount_i", "httpstatus_i")


@query("SELECT lower(n_name) AS key, max(r_name) AS value FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY lower(n_name)")
def property_map(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return lookups.property_map(sinks.property_lines(n, "n_name", "r_name"))


@query("SELECT DISTINCT lower(n_name) AS word FROM nation WHERE length(n_name) >= 4")
def word_list(spark, sf_dir):
    return lookups.word_list(table(spark, sf_dir, "nation").select(F.col("n_name").alias("value")))
