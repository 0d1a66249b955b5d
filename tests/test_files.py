"""Formats, WARC files, lookups, jobs."""

import bz2
import gzip
import io
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from pagemill.catalog import files
from pagemill.formats import parsers
from pagemill.functions import charsets
from pagemill.operators import lookup
from pagemill.sources import lookups, warc
from pagemill.streaming import jobs


def test_samples():
    got = {u: parsers.parse(u, m, None, b) for u, m, b in files.samples()}
    by = {u.rpartition("/")[2]: d for u, d in got.items()}
    assert by["a.html"][0]["titles"] == ["T"]
    assert by["t.csv"][0]["titles"] == ["a b,c"]  # of equal widths the semicolon is taken
    assert [d["titles"] for d in by["f.rss"]] == [["one"], ["two"]]
    assert "In zip" in by["z.zip"][0]["titles"] and "x y." in by["z.zip"][0]["text"]
    assert by["c.vcf"][0]["titles"] == ["Ann Example"] and by["c.vcf"][0]["anchors"] == ["http://h/ann"]
    assert by["m.mm"][0]["text"] == "root. leaf"
    assert by["p.svg"][0]["width"] == 10 and by["p.svg"][0]["titles"] == ["pic"]
    assert by["t.torrent"][0]["text"] == "d/f.txt"
    assert by["r.rtf"][0]["text"] == "Hello World"
    assert by["unknown.bin"][0]["parser"] == "generic"


def test_containers_in_containers():
    t = io.BytesIO()
    with tarfile.open(fileobj=t, mode="w") as f:
        data = b"<title>deep</title>"
        i = tarfile.TarInfo("x.html")
        i.size = len(data)
        f.addfile(i, io.BytesIO(data))
    for name, packed in (("a.tgz", gzip.compress(t.getvalue())), ("a.tar.bz2", bz2.compress(t.getvalue())), ("a.tar", t.getvalue())):
        assert "deep" in parsers.parse(f"http://h/{name}", None, None, packed)[0]["titles"]


def test_depth_is_bounded():
    data = b"<title>end</title>"
    name = "x.html"
    for _ in range(parsers.DEPTH + 3):
        z = io.BytesIO()
        with zipfile.ZipFile(z, "w") as f:
            f.writestr(name, data)
        data, name = z.getvalue(), "x.zip"
    assert "end" not in parsers.parse("http://h/x.zip", None, None, data)[0]["titles"]


def test_office():
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("word/document.xml", '<w:document xmlns:w="w"><w:p><w:r><w:t>Hello</w:t></w:r></w:p><w:p><w:r><w:t>there</w:t></w:r></w:p></w:document>')
        f.writestr("docProps/core.xml", '<c xmlns:dc="d"><dc:title>Doc</dc:title><dc:creator>Me</dc:creator></c>')
    d = parsers.parse("http://h/a.docx", None, None, z.getvalue())[0]
    assert (d["titles"], d["creator"], d["text"]) == (["Doc"], "Me", "Hello there")
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("content.xml", "<o xmlns:text='t'><text:h>Head</text:h><text:p>Body</text:p></o>")
        f.writestr("meta.xml", "<o xmlns:dc='d'><dc:title>ODT</dc:title></o>")
    assert parsers.parse("http://h/a.odt", None, None, z.getvalue())[0]["text"] == "Head Body"


def test_images_and_audio():
    png = b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + (5).to_bytes(4, "big") + (7).to_bytes(4, "big") + b"\x08\x02\0\0\0"
    assert (lambda d: (d["width"], d["height"]))(parsers.parse("http://h/a.png", "image/png", None, png)[0]) == (5, 7)
    mp3 = b"\0" * 200 + b"TAG" + b"Song".ljust(30, b"\0") + b"Singer".ljust(30, b"\0") + b"".ljust(65, b"\0")
    d = parsers.parse("http://h/a.mp3", "audio/mpeg", None, mp3)[0]
    assert (d["titles"], d["creator"]) == (["Song"], "Singer")


def test_bencode_round_trip():
    v = {b"a": [1, -2, b"x"], b"b": {b"c": b""}}
    assert parsers.bdecode(parsers.bencode(v))[0] == v


def sample_warc():
    chunked = b"5\r\n<p>ab\r\n3\r\nc\r\n\r\n0\r\n\r\n"
    return b"".join([
        warc.write_record("http://h/1", b"<title>one</title>"), warc.write_record("http://h/2", b"gone", status=404), warc.write_record("http://h/3", b"x", kind="request"),
        warc.write_record("http://h/4", b"x", mime="application/unknown"), warc.write_record("http://h/5", chunked, extra="Transfer-Encoding: chunked\r\n"),
        warc.write_record("http://h/6", gzip.compress(b"<title>six</title>"), extra="Content-Encoding: gzip\r\n"), warc.write_record("nonsense", b"<p>k</p>"),
    ])


@pytest.mark.parametrize("packed", [False, True])
def test_warc(spark, tmp_path, packed):
    data = sample_warc()
    (tmp_path / ("a.warc.gz" if packed else "a.warc")).write_bytes(gzip.compress(data) if packed else data)
    df = warc.read_warc(spark, str(tmp_path))
    assert df.count() == 7
    got = {r.target_uri: bytes(r.payload) for r in warc.responses(df).collect()}
    assert set(got) == {"http://h/1", "http://h/5", "http://h/6", warc.FALLBACK}
    assert got["http://h/5"] == b"<p>abc\r\n" and got["http://h/6"] == b"<title>six</title>"
    rows = warc.warc_rows(spark.read.format("binaryFile").load(str(tmp_path)))
    assert rows.count() == 7


def test_jobs_run_once(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w/a.warc").write_bytes(sample_warc())
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text(json.dumps({"id": "1", "source": str(tmp_path / "w/a.warc"), "crawl_id": "c", "user_id": "u"}))
    out, when = str(tmp_path / "out"), F.lit("2024-01-01").cast("timestamp")
    for _ in range(2):  # the second start finds nothing new
        jobs.start(jobs.messages(spark, str(tmp_path / "in")), out, str(tmp_path / "checkpoint"), when).awaitTermination()
    assert spark.read.text(f"{out}/index").count() == 2 * 4
    assert jobs.statuses(spark, out).count() == 4


def test_windowed_counts_is_streaming(spark):
    s = spark.readStream.format("rate").load()
    assert jobs.windowed_counts(s, "timestamp", "value").isStreaming


def test_lookups(spark):
    text = lambda *v: spark.createDataFrame([(x,) for x in v], "value string")
    v = lookup.vocabulary(text("Größe:size,large#http://l", "# no"), F.lit("x")).collect()
    assert {r.synonym for r in v} == {"groesse", "size", "large"} and v[0].objectlink == "http://l"
    m = {r.key: r.value for r in lookups.property_map(text("# c", "A=1", "b\\=c=2\\n3")).collect()}
    assert m == {"a": "1", "b=c": "2\n3"}
    assert lookups.rewrite_rules(text("a.*=b", "s/x/y", "(=z")) == [("a.*", "b")]
    line = "\t".join(["7", "Köln", "Koeln", "Cologne,Coln", "50.9", "6.9"] + [""] * 8 + ["1000000"] + [""] * 4)
    g = lookup.geonames(text(line), text("coln").withColumnRenamed("value", "word"))
    assert {r.name for r in g.collect()} == {"Köln", "Koeln", "Cologne"}
    p = lookups.opengeodb(text("INSERT INTO geodb_coordinates VALUES (5, 1, 50.1, 8.6, 'x');", "INSERT INTO geodb_textdata VALUES (5, 500100000, 'Frankfurt, Main', 'de');"))
    assert {(r.kind, r.text) for r in p.collect()} == {("point", None), ("name", "Frankfurt, Main")}


def test_damaged_records_do_not_hide_the_rest():
    good = [warc.write_record(f"http://a/{i}", b"<p>x</p>") for i in range(3)]
    bad = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: <http://bad/>\r\nContent-Length: many\r\n\r\nHTTP/1.1 200 OK\r\n\r\nbody\r\n\r\n"
    kinds = lambda data: [(r["warc_type"], r["target_uri"]) for r in warc.records(io.BytesIO(data)) if r["warc_type"] != "damaged"]
    assert kinds(bad + b"".join(good)) == kinds(b"".join(good)) == [("response", f"http://a/{i}") for i in range(3)]
    assert kinds(good[0] + b"noise\r\nmore noise\r\n" + bad + good[1]) == [("response", "http://a/0"), ("response", "http://a/1")]
    cut = list(warc.records(io.BytesIO(good[0] + good[1][:-20])))
    assert [r["warc_type"] for r in cut] == ["response", "damaged"]
    packed = gzip.compress(good[0]) + b"\x1f\x8bbroken"
    assert [r["warc_type"] for r in warc.records(io.BytesIO(packed))] == ["response", "damaged"]
    assert [r["warc_type"] for r in warc.records(io.BytesIO(bad))][0] == "damaged"


def test_charsets():
    text = "grüße"
    for content, kind, want in [
        (text.encode("latin-1"), "text/html; charset=ISO-8859-1", text), (text.encode("latin-1"), None, text), (text.encode(), "text/html", text), (b'<meta charset="windows-1251">' + "привет".encode("cp1251"), None, "привет"),
        (text.encode("utf-16"), "text/html", text), (b"a\xc3", "text/html; charset=utf-8", "a�"), (text.encode(), "text/html; charset=nothing", text), ("日本".encode("shift_jis"), "text/html;charset=Shift_JIS", "日本"), (b"", None, ""),
    ]:
        assert charsets.text_of(content, kind).endswith(want)


def test_pages_in_other_charsets_do_not_fail_a_job(spark, tmp_path):
    data = warc.write_record("http://a/1", "<p>grüße</p>".encode("latin-1"), mime="text/html; charset=iso-8859-1") + warc.write_record("http://a/2", b"<p>a\xff\xfe</p>", mime="text/html; charset=utf-8")
    (tmp_path / "x.warc").write_bytes(data)
    got = {r.url: r.html for r in warc.to_pages(warc.read_warc(spark, str(tmp_path / "x.warc"))).collect()}
    assert got == {"http://a/1": "<p>grüße</p>", "http://a/2": "<p>a��</p>"}
