"""Parsers from bytes to documents, and the chain that tries them.

A parser takes (url, mime, charset, bytes) and gives a list of documents; it raises
if the bytes are not of its kind, and the next candidate is tried: parsers of the mime
type, then of the extension, then the generic one. Containers parse their entries the
same way, to a bounded depth and size, and fold them into one document.
"""

from __future__ import annotations

import base64
import bz2
import csv
import gzip
import io
import quopri
import re
import struct
import tarfile
import xml.etree.ElementTree as ET
import zipfile
import zlib
from collections.abc import Callable
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame

from pagemill.arrow import map_rows
from pagemill.functions import html

DEPTH, MOST_BYTES, FEED_ITEMS = 8, 64 << 20, 10_000
SCHEMA = (
    "url string, mime string, parser string, titles array<string>, creator string, publisher string, sections array<string>, descriptions array<string>, "
    "keywords array<string>, languages array<string>, text string, anchors array<string>, images array<string>, lat double, lon double, width int, height int"
)
Parser = Callable[[str, str, str | None, bytes, int], list[dict]]
BY_MIME: dict[str, list[tuple[str, Parser]]] = {}
BY_EXTENSION: dict[str, list[tuple[str, Parser]]] = {}
DENIED: set[str] = set()


class Failure(Exception):
    pass


def register(name: str, mimes: str, extensions: str) -> Callable[[Parser], Parser]:
    """The extension point: a parser under a name for mime types and extensions."""

    def add(f: Parser) -> Parser:
        for table, keys in ((BY_MIME, mimes), (BY_EXTENSION, extensions)):
            for k in keys.split():
                table.setdefault(k, []).append((name, f))
        return f

    return add


def extension(url: str) -> str:
    name = urlsplit(url).path.rpartition("/")[2].partition(";")[0]
    return name.rpartition(".")[2].lower() if "." in name else ""


def url_tokens(url: str) -> str:
    return " ".join(re.findall(r"[^\W_]+", re.sub(r"([a-zß-ÿ])([A-ZÀ-Þ])", r"\1 \2", unquote(url))))


def document(url: str, mime: str, **more) -> dict:
    empty = {k: [] for k in ("titles", "sections", "descriptions", "keywords", "languages", "anchors", "images")}
    return {"url": url, "mime": mime, "creator": "", "publisher": "", "text": "", "lat": 0.0, "lon": 0.0, "width": None, "height": None} | empty | more


def to_text(data: bytes, charset: str | None) -> str:
    for name in (charset, "utf-8"):
        if name:
            try:
                return data.decode(name)
            except (LookupError, UnicodeDecodeError):
                pass
    return data.decode("windows-1252", "replace")


def candidates(url: str, mime: str) -> list[tuple[str, Parser]]:
    ext = extension(url)
    if mime in DENIED or ext in DENIED:
        return []
    out = [*BY_MIME.get(mime, []), *BY_EXTENSION.get(ext, []), ("generic", generic)]
    return [x for i, x in enumerate(out) if x[0] not in {n for n, _ in out[:i]}]


def parse(url: str, mime: str | None, charset: str | None, data: bytes, depth: int = 0) -> list[dict]:
    """Documents of the first parser that takes the bytes."""
    mime = (mime or "application/octet-stream").partition(";")[0].strip().lower()
    why: list[str] = []
    for name, f in candidates(url, mime):
        try:
            return [{"parser": name} | d for d in f(url, mime, charset, data, depth)]
        except Exception as e:  # whatever a parser meets in bytes it does not understand
            why.append(f"{name}: {e}")
    raise Failure("; ".join(why) or "denied")


def supported(mime: str | None) -> bool:
    """A missing mime type passes."""
    m = (mime or "").partition(";")[0].strip().lower()
    return not m or m not in DENIED and m in BY_MIME


def fold(url: str, mime: str, parts: list[dict], title: str) -> dict:
    """One document with all that the parts have, in order."""
    out = document(url, mime, titles=[title] if title else [])
    for d in parts:
        for k in ("titles", "sections", "descriptions", "keywords", "anchors", "images"):
            out[k] = out[k] + [x for x in d[k] if x not in out[k]]
        out["text"] = "\n".join(x for x in (out["text"], d["text"]) if x)
    return out


def entry(url: str, name: str, data: bytes, depth: int) -> list[dict]:
    if depth >= DEPTH:
        raise Failure("too deep")
    try:
        return parse(f"{url}/{name}", MIME_OF.get(extension(name)), None, data, depth + 1)
    except Failure:
        return []


def bounded(stream, most: int = MOST_BYTES) -> bytes:
    data = stream.read(most + 1)
    if len(data) > most:
        raise Failure("too large")
    return data


# Mime types of common extensions.
MIME_OF = dict(x.split(":") for x in "html:text/html htm:text/html txt:text/plain csv:text/csv xml:application/xml rss:application/rss+xml json:application/json js:application/javascript pdf:application/pdf zip:application/zip gz:application/gzip tar:application/x-tar bz2:application/x-bzip2 svg:image/svg+xml png:image/png gif:image/gif jpg:image/jpeg jpeg:image/jpeg bmp:image/bmp vcf:text/vcard rtf:application/rtf mm:application/freemind torrent:application/x-bittorrent".split())


@register("html", "text/html application/xhtml+xml text/plain application/x-httpd-php text/csv text/sgml", "html htm xhtml shtml php php3 asp aspx jsp cfm txt md")
def page(url, mime, charset, data, depth):
    s = to_text(data, charset)
    if mime == "text/plain":
        s = f"<h1>{s}</h1>" if len(s) < 1000 and "\n" not in s else s
    r = html.parse(s, url)
    if r["binary"]:
        raise Failure("binary")
    metas = dict(r["metas"])
    heads = [x for k in range(1, 7) for x in r[f"h{k}"]]
    titles = [t for t in r["titles"] if t] or [metas["title"]] * ("title" in metas) or heads[:1]
    words = metas.get("keywords", "")
    return [document(
        url, mime, titles=titles, creator=metas.get("author", metas.get("dc.creator", "")), publisher=metas.get("copyright", metas.get("dc.publisher", "")), sections=heads, descriptions=[metas[k] for k in ("description", "dc.description") if k in metas],
        keywords=[w.strip() for w in re.split("," if "," in words else ";" if ";" in words else r"\s+", words) if w.strip()], languages=[r["language"]] if r["language"] else [], text=r["text"], anchors=[a["url"] for a in r["anchors"]], images=[i["url"] for i in r["images"]], lat=r["lat"], lon=r["lon"],
    )]


@register("csv", "", "csv")
def table(url, mime, charset, data, depth):
    lines = [x for x in to_text(data, charset).splitlines() if x.strip()]
    if not lines:
        raise Failure("empty")
    width = {s: max(len(x.split(s)) for x in lines) for s in ("\t", ";", ",")}
    separator = max(width, key=width.get)  # of equal ones the first
    rows = list(csv.reader(lines, delimiter=separator))
    return [document(url, mime, titles=[" ".join(rows[0])], text=" ".join(" ".join(r) + "." for r in rows))]


def generic(url, mime, charset, data, depth):
    name = unquote(urlsplit(url).path.rpartition("/")[2])
    return [document(url, mime, titles=[name or url_tokens(url)], publisher=urlsplit(url).hostname or "", text=url_tokens(url))]


@register("links", "application/javascript application/json text/javascript", "js json py c h cpp java pl sh")
def links(url, mime, charset, data, depth):
    r = html.parse(to_text(data, charset), url)
    found = re.findall(r"https?://[^\s\"'<>]+", to_text(data, charset))
    return [document(url, mime, titles=[url_tokens(url)], text=url_tokens(url), anchors=list(dict.fromkeys([a["url"] for a in r["anchors"]] + found)), images=[i["url"] for i in r["images"]])]


def local(tag: str) -> str:
    return tag.rpartition("}")[2].lower()


@register("feed", "application/rss+xml application/atom+xml application/rdf+xml text/xml application/xml", "rss xml atom rdf")
def feed(url, mime, charset, data, depth):
    items: dict[str, dict] = {}
    for e in ET.fromstring(data).iter():
        if local(e.tag) not in ("item", "entry"):
            continue
        one: dict[str, str] = {}
        for x in e:
            value = (x.text or "").strip() or (x.get("href", "") if local(x.tag) == "link" else "")
            one.setdefault(local(x.tag), value)
        link = one.get("link") or one.get("guid") or one.get("id") or ""
        guid = one.get("guid") or one.get("id") or link or one.get("title", "")
        items.pop(guid, None)
        items[guid] = document(link or url, "text/html", titles=[one.get("title", "")], creator=one.get("author") or one.get("creator", ""), descriptions=[one.get("description") or one.get("summary", "")], keywords=[one["category"]] if one.get("category") else [], text=" ".join(x for x in (one.get("title"), one.get("description") or one.get("summary") or one.get("content")) if x), anchors=[link] if link else [])
        if len(items) > FEED_ITEMS:
            items.pop(next(iter(items)))
    if not items:
        raise Failure("no items")
    return list(items.values())


@register("zip", "application/zip application/java-archive application/x-zip-compressed", "zip jar")
def zipped(url, mime, charset, data, depth):
    parts, left = [], MOST_BYTES
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for i in z.infolist():
            if not i.is_dir() and i.file_size and left > 0:
                inner = bounded(z.open(i), left)
                left -= len(inner)
                parts += entry(url, i.filename, inner, depth)
    return [fold(url, mime, parts, url_tokens(urlsplit(url).path.rpartition("/")[2]))]


@register("tar", "application/x-tar application/tar", "tar")
def tarred(url, mime, charset, data, depth):
    parts = []
    with tarfile.open(fileobj=io.BytesIO(data), mode="r:") as t:
        for m in t:
            if m.isfile() and m.size <= MOST_BYTES:
                parts += entry(url, m.name, t.extractfile(m).read(), depth)
    return [fold(url, mime, parts, url_tokens(urlsplit(url).path.rpartition("/")[2]))]


def unpacked(url, mime, data, depth, inner):
    name = urlsplit(url).path.rpartition("/")[2]
    stem = name.rpartition(".")[0] or name
    stem = f"{stem}.tar" if extension(url) in ("tgz", "tbz", "tbz2") or inner[257:262] == b"ustar" and not stem.endswith(".tar") else stem
    return [fold(url, mime, entry(url, stem, inner, depth), url_tokens(name))]


@register("gzip", "application/gzip application/x-gzip", "gz tgz")
def gzipped(url, mime, charset, data, depth):
    return unpacked(url, mime, data, depth, bounded(gzip.open(io.BytesIO(data))))


@register("bzip2", "application/x-bzip2", "bz2 tbz tbz2")
def bzipped(url, mime, charset, data, depth):
    return unpacked(url, mime, data, depth, bounded(bz2.open(io.BytesIO(data))))


@register("pdf", "application/pdf", "pdf")
def pdf(url, mime, charset, data, depth):
    """Text of plain and deflated streams, as their show operators give it; the title and author of the information dictionary."""
    if not data.startswith(b"%PDF"):
        raise Failure("not a PDF")
    out = []
    for m in re.finditer(rb"stream\r?\n(.*?)\r?\nendstream", data, re.S):
        body = m[1]
        try:
            body = zlib.decompressobj().decompress(body, MOST_BYTES)
        except zlib.error:
            pass
        for shown in re.finditer(rb"\[((?:\((?:\\.|[^\\)])*\)|[^\]])*)\]\s*TJ|\(((?:\\.|[^\\)])*)\)\s*(?:Tj|'|\")", body, re.S):
            pieces = re.findall(rb"\(((?:\\.|[^\\)])*)\)", shown[1]) if shown[1] is not None else [shown[2]]
            out.append("".join(re.sub(r"\\([()\\])", r"\1", p.decode("latin-1")) for p in pieces))
    info = {k: re.search(rb"/" + k + rb"\s*\(((?:\\.|[^\\)])*)\)", data) for k in (b"Title", b"Author", b"Subject")}
    get = lambda k: info[k][1].decode("latin-1") if info[k] else ""
    return [document(url, mime, titles=[get(b"Title")] if get(b"Title") else [], creator=get(b"Author"), descriptions=[get(b"Subject")] if get(b"Subject") else [], text=" ".join(out), anchors=[x.decode("latin-1") for x in re.findall(rb"/URI\s*\(([^)]*)\)", data)])]


def short_title(text: str) -> list[str]:
    t = re.sub(r"\s+", " ", text).strip()[:80]
    return [t] if t else []


@register("office", "application/msword application/vnd.ms-excel application/vnd.ms-powerpoint application/vnd.visio", "doc dot xls xla ppt pps vsd")
def old_office(url, mime, charset, data, depth):
    """Runs of printable characters, of one or two bytes, in a compound file."""
    if not data.startswith(b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"):
        raise Failure("not a compound file")
    wide = [m[0].decode("utf-16-le") for m in re.finditer(rb"(?:[\x20-\x7e\xa0-\xff]\x00){6,}", data)]
    narrow = [m[0].decode("latin-1") for m in re.finditer(rb"[\x20-\x7e\xa0-\xff]{8,}", data)]
    text = " ".join(wide or narrow)
    return [document(url, mime, titles=short_title(text), text=text)]


@register("ooxml", "application/vnd.openxmlformats-officedocument.wordprocessingml.document application/vnd.openxmlformats-officedocument.spreadsheetml.sheet application/vnd.openxmlformats-officedocument.presentationml.presentation", "docx dotx pptx ppsx potx xlsx xltx")
def ooxml(url, mime, charset, data, depth):
    """All parts with text, in the order of their numbers."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        number = lambda n: (int((re.findall(r"\d+", n) or ["0"])[-1]), n)
        parts = sorted((n for n in z.namelist() if re.fullmatch(r"word/document\.xml|xl/sharedStrings\.xml|ppt/slides/slide\d+\.xml|xl/worksheets/sheet\d+\.xml", n)), key=number)
        if not parts:
            raise Failure("no parts")
        text = " ".join(t for n in parts for t in ("".join(x.text or "" for x in p.iter() if local(x.tag) == "t") for p in ET.fromstring(z.read(n)).iter() if local(p.tag) in ("p", "si", "is")) if t)
        core = {local(e.tag): (e.text or "").strip() for e in ET.fromstring(z.read("docProps/core.xml"))} if "docProps/core.xml" in z.namelist() else {}
    return [document(url, mime, titles=[core["title"]] if core.get("title") else short_title(text), creator=core.get("creator", ""), descriptions=[core["description"]] if core.get("description") else [], keywords=re.split(r"[,;\s]+", core["keywords"]) if core.get("keywords") else [], languages=[core["language"]] if core.get("language") else [], text=text)]


@register("opendocument", "application/vnd.oasis.opendocument.text application/vnd.oasis.opendocument.spreadsheet application/vnd.oasis.opendocument.presentation application/vnd.sun.xml.writer application/vnd.sun.xml.calc", "odt ods odp odg odf ott ots otp sxw sxc sxi sxd")
def opendocument(url, mime, charset, data, depth):
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ET.fromstring(z.read("content.xml"))
        text = " ".join(t for t in ("".join(e.itertext()).strip() for e in root.iter() if local(e.tag) in ("p", "h")) if t)
        meta: dict[str, list[str]] = {}
        for e in ET.fromstring(z.read("meta.xml")).iter() if "meta.xml" in z.namelist() else ():
            if e.text and e.text.strip():
                meta.setdefault(local(e.tag), []).append(e.text.strip())
    one = lambda k: (meta.get(k) or [""])[0]
    title = one("subject") or one("title")
    return [document(url, mime, titles=[title] if title else short_title(text), creator=one("creator") or one("initial-creator"), descriptions=meta.get("description", []), keywords=meta.get("keyword", []), languages=meta.get("language", []), text=text)]


@register("rtf", "application/rtf text/rtf text/richtext", "rtf")
def rtf(url, mime, charset, data, depth):
    s = data.decode("latin-1")
    if not s.startswith("{\\rtf"):
        raise Failure("not RTF")
    out, skip, stack = [], False, []
    for m in re.finditer(r"\\'([0-9a-f]{2})|\\([a-z]+)(-?\d+)? ?|\\([^a-z])|([{}])|([^\\{}]+)", s, re.I):
        if m[5] == "{":
            stack.append(skip)
        elif m[5] == "}":
            skip = stack.pop() if stack else False
        elif m[4] == "*" or m[2] in ("fonttbl", "colortbl", "stylesheet", "info", "pict", "header", "footer"):
            skip = True
        elif not skip:
            if m[1]:
                out.append(bytes([int(m[1], 16)]).decode("cp1252", "replace"))
            elif m[2] in ("par", "line", "tab", "cell", "row"):
                out.append(" ")
            elif m[2] == "u" and m[3]:
                out.append(chr(int(m[3]) % 65536))
            elif m[4] in ("{", "}", "\\", "~"):
                out.append(" " if m[4] == "~" else m[4])
            elif m[6]:
                out.append(m[6].replace("\r", "").replace("\n", ""))
    text = re.sub(r"\s+", " ", "".join(out)).strip()
    return [document(url, mime, titles=short_title(text), text=text)]


@register("postscript", "application/postscript", "ps eps")
def postscript(url, mime, charset, data, depth):
    s = data.decode("latin-1")
    if not s.startswith("%!PS"):
        raise Failure("not PostScript")
    text = re.sub(r"\s+", " ", " ".join(re.sub(r"\\([()\\])", r"\1", x) for x in re.findall(r"\(((?:\\.|[^\\()])*)\)", s))).strip()
    title = re.search(r"^%%Title:\s*\(?(.*?)\)?\s*$", s, re.M)
    return [document(url, mime, titles=[title[1]] if title else short_title(text), text=text)]


@register("vcard", "text/vcard text/x-vcard text/directory application/vcard", "vcf")
def vcard(url, mime, charset, data, depth):
    lines: list[str] = []
    for line in to_text(data, charset).splitlines():
        if lines and (line[:1] in " \t" or lines[-1].endswith("=") and "QUOTED-PRINTABLE" in lines[-1].upper()):
            lines[-1] = lines[-1].removesuffix("=") + line.lstrip(" \t")
        else:
            lines.append(line)
    names, sections, anchors, words = [], [], [], []
    for line in lines:
        key, _, value = line.partition(":")
        key, *options = key.upper().split(";")
        if key in ("LOGO", "PHOTO", "SOUND", "KEY", "BEGIN", "END", "VERSION") or key.startswith("X-") or not value:
            continue
        kind = ";".join(options)
        if "QUOTED-PRINTABLE" in kind:
            value = quopri.decodestring(value.encode()).decode("utf-8", "replace")
        elif "BASE64" in kind or "ENCODING=B" in kind:
            value = base64.b64decode(value).decode("utf-8", "replace")
        value = re.sub(r"\s+", " ", value.replace("\\n", " ").replace("\\,", ",").replace(";", " ")).strip()
        if key in ("FN", "N"):
            names.append(value)
        elif key == "TITLE":
            sections.append(value)
        elif key == "URL":
            anchors.append(value)
        words.append(value)
    if not words:
        raise Failure("no card")
    return [document(url, mime, titles=names[:1], sections=names[1:] + sections, anchors=anchors, text=" ".join(words))]


@register("freemind", "application/freemind application/x-freemind", "mm")
def freemind(url, mime, charset, data, depth):
    nodes = [e.get("TEXT") for e in ET.fromstring(data).iter("node") if e.get("TEXT")]
    if not nodes:
        raise Failure("no nodes")
    return [document(url, mime, titles=nodes[:1], text=". ".join(nodes))]


@register("svg", "image/svg+xml", "svg")
def svg(url, mime, charset, data, depth):
    root = ET.fromstring(data)
    if local(root.tag) != "svg":
        raise Failure("not SVG")
    px = lambda k: int(m[1]) if (m := re.match(r"(\d+)(?:\.\d+)?(?:px)?$", root.get(k, ""))) else None
    get = lambda k: next(("".join(e.itertext()).strip() for e in root if local(e.tag) == k), "")
    return [document(url, mime, titles=[get("title")] if get("title") else [], descriptions=[get("desc")] if get("desc") else [], text=" ".join(x for x in (get("title"), get("desc")) if x), width=px("width"), height=px("height"))]


def rational(data: bytes, order: str, at: int, n: int) -> list[float]:
    return [a / b if b else 0.0 for a, b in struct.iter_unpack(order + "II", data[at : at + 8 * n])]


def tiff_tags(data: bytes) -> dict:
    """Texts, sizes and the place from the first directory and the GPS one."""
    order = {b"II": "<", b"MM": ">"}[data[:2]]
    out: dict = {}

    def walk(at: int, names: dict[int, str]) -> None:
        (n,) = struct.unpack_from(order + "H", data, at)
        for k in range(n):
            tag, kind, count_, value = struct.unpack_from(order + "HHII", data, at + 2 + 12 * k)
            small = at + 10 + 12 * k
            if tag in names:
                if kind == 2:
                    raw = data[value : value + count_] if count_ > 4 else data[small : small + count_]
                    out[names[tag]] = raw.split(b"\0")[0].decode("latin-1").strip()
                elif kind == 5:
                    out[names[tag]] = rational(data, order, value, count_)
                else:
                    out[names[tag]] = struct.unpack_from(order + "H", data, small)[0] if kind == 3 else value

    (first,) = struct.unpack_from(order + "I", data, 4)
    walk(first, {0x100: "width", 0x101: "height", 0x10E: "description", 0x10F: "make", 0x110: "model", 0x13B: "artist", 0x8298: "copyright", 0x8825: "gps"})
    if "gps" in out:
        walk(out["gps"], {1: "ns", 2: "lat", 3: "ew", 4: "lon"})
    return out


def place(tags: dict) -> tuple[float, float]:
    angle = lambda k: sum(x / 60**i for i, x in enumerate(tags.get(k, [])))
    return angle("lat") * (-1 if tags.get("ns") == "S" else 1), angle("lon") * (-1 if tags.get("ew") == "W" else 1)


@register("image", "image/png image/gif image/jpeg image/bmp image/tiff image/x-icon image/webp image/vnd.adobe.photoshop", "png gif jpg jpeg jpe bmp tif tiff ico psd webp")
def image(url, mime, charset, data, depth):
    tags: dict = {}
    if data.startswith(b"\x89PNG"):
        w, h = struct.unpack_from(">II", data, 16)
        for m in re.finditer(rb"tEXt(Title|Author|Description|Copyright)\0([^\0]*?)(?=.{4}.{4}[a-zA-Z]{4}|\Z)", data, re.S):
            tags[{"Author": "artist", "Title": "title"}.get(m[1].decode(), m[1].decode().lower())] = m[2].decode("latin-1")
    elif data[:3] == b"GIF":
        w, h = struct.unpack_from("<HH", data, 6)
    elif data[:2] == b"BM":
        w, h = struct.unpack_from("<ii", data, 18)
        h = abs(h)
    elif data[:4] in (b"II*\0", b"MM\0*"):
        tags = tiff_tags(data)
        w, h = tags.get("width"), tags.get("height")
    elif data[:4] == b"8BPS":
        h, w = struct.unpack_from(">II", data, 14)
    elif data[:4] == b"\0\0\1\0":
        w, h = (data[6] or 256), (data[7] or 256)
    elif data[:4] == b"RIFF" and data[8:12] == b"WEBP":
        w = h = None
    elif data[:2] == b"\xff\xd8":
        w = h = None
        at = 2
        while at + 4 <= len(data) and data[at] == 0xFF:
            marker, length = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
            if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack_from(">HH", data, at + 5)
                break
            if marker == 0xE1 and data[at + 4 : at + 10] == b"Exif\0\0":
                tags = tiff_tags(data[at + 10 : at + 2 + length])
            at += 2 + length
    else:
        raise Failure("unknown image")
    lat, lon = place(tags)
    name = urlsplit(url).path.rpartition("/")[2]
    title = tags.get("title") or tags.get("description") or unquote(name)
    text = " ".join(str(v) for k, v in tags.items() if isinstance(v, str) and k not in ("ns", "ew"))
    return [document(url, mime, titles=[title], creator=tags.get("artist", ""), publisher=tags.get("copyright", ""), text=text or url_tokens(url), images=[url], width=w, height=h, lat=lat, lon=lon)]


@register("audio", "audio/mpeg audio/ogg audio/flac audio/x-flac audio/mp4", "mp3 ogg oga flac m4a m4p wma")
def audio(url, mime, charset, data, depth):
    """ID3 version 2 and 1 tags, and Vorbis comments."""
    tags: dict[str, str] = {}
    if data[:3] == b"ID3":
        size = sum((b & 127) << s for b, s in zip(data[6:10], (21, 14, 7, 0)))
        at = 10
        while at + 10 <= 10 + size and data[at : at + 4].strip(b"\0"):
            key = data[at : at + 4].decode("latin-1")
            n = int.from_bytes(data[at + 4 : at + 8], "big") if data[3] < 4 else sum((b & 127) << s for b, s in zip(data[at + 4 : at + 8], (21, 14, 7, 0)))
            body = data[at + 10 : at + 10 + n]
            if key in ("TIT2", "TPE1", "TALB", "TCON", "TYER", "TDRC", "COMM", "TCOM") and body:
                tags[key] = body[1:].decode(("latin-1", "utf-16", "utf-16-be", "utf-8")[body[0] & 3], "replace").strip("\0 ")
            at += 10 + n
    elif data[-128:-125] == b"TAG":
        t = data[-128:]
        tags = {k: v for k, v in {"TIT2": t[3:33], "TPE1": t[33:63], "TALB": t[63:93], "TYER": t[93:97], "COMM": t[97:127]}.items()}
        tags = {k: v.split(b"\0")[0].decode("latin-1").strip() for k, v in tags.items()}
    else:
        for key, name in ((b"TITLE", "TIT2"), (b"ARTIST", "TPE1"), (b"ALBUM", "TALB"), (b"GENRE", "TCON"), (b"DATE", "TYER")):
            if m := re.search(rb"(?i)(.{4})" + key + rb"=", data[:65536], re.S):
                n = int.from_bytes(m[1], "little")
                tags[name] = data[m.end() : m.start() + 4 + n].decode("utf-8", "replace")
    values = [v for v in tags.values() if v]
    if not values:
        raise Failure("no tags")
    return [document(url, mime, titles=[tags["TIT2"]] if tags.get("TIT2") else [], creator=tags.get("TPE1", ""), descriptions=values, text=" ".join(values))]


@register("sid", "audio/prs.sid", "sid psid")
def sid(url, mime, charset, data, depth):
    if len(data) < 128 or data[:4] not in (b"PSID", b"RSID") or data[5] not in (1, 2):
        raise Failure("not SID")
    name, author, publisher = (data[a : a + 32].split(b"\0")[0].decode("latin-1").strip() for a in (0x16, 0x36, 0x56))
    return [document(url, mime, titles=[name], creator=author, publisher=publisher, text=f"{name} {author} {publisher}")]


def bdecode(data: bytes, at: int = 0):
    """A value and the place after it."""
    c = data[at : at + 1]
    if c == b"i":
        end = data.index(b"e", at)
        return int(data[at + 1 : end]), end + 1
    if c in (b"l", b"d"):
        at += 1
        out = []
        while data[at : at + 1] != b"e":
            v, at = bdecode(data, at)
            out.append(v)
        return (out if c == b"l" else dict(zip(out[::2], out[1::2]))), at + 1
    colon = data.index(b":", at)
    n = int(data[at:colon])
    return data[colon + 1 : colon + 1 + n], colon + 1 + n


def bencode(v) -> bytes:
    if isinstance(v, int):
        return b"i%de" % v
    if isinstance(v, (list, tuple)):
        return b"l" + b"".join(map(bencode, v)) + b"e"
    if isinstance(v, dict):
        return b"d" + b"".join(bencode(k) + bencode(v[k]) for k in sorted(v)) + b"e"
    v = v.encode() if isinstance(v, str) else v
    return b"%d:%s" % (len(v), v)


@register("torrent", "application/x-bittorrent", "torrent")
def torrent(url, mime, charset, data, depth):
    root, _ = bdecode(data)
    get = lambda d, k: d.get(k, b"").decode("utf-8", "replace")
    info = root[b"info"]
    files = [b"/".join(f[b"path"]).decode("utf-8", "replace") for f in info.get(b"files", [])]
    return [document(url, mime, titles=[get(info, b"name")], creator=get(root, b"comment"), text=" ".join(files or [get(info, b"name")]))]


@register("apk", "application/vnd.android.package-archive", "apk")
def apk(url, mime, charset, data, depth):
    """Permissions, entry names and links from the string pools of a package."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        if "AndroidManifest.xml" not in names:
            raise Failure("no manifest")
        strings: list[str] = []
        for n in ("AndroidManifest.xml", "resources.arsc"):
            if n in names:
                raw = bounded(z.open(n))
                strings += [m[0].decode("utf-16-le") for m in re.finditer(rb"(?:[\x20-\x7e]\x00){3,}", raw)] + [m[0].decode() for m in re.finditer(rb"[\x20-\x7e]{6,}", raw)]
    permissions = [s for s in strings if s.startswith("android.permission.")]
    return [document(url, mime, titles=[unquote(urlsplit(url).path.rpartition("/")[2])], sections=permissions, text=" ".join(dict.fromkeys(strings + names)), anchors=[s for s in strings if s.startswith("http")])]


def parse_documents(df: DataFrame) -> DataFrame:
    """url, mime, charset and content of each row become its documents, with an error where no parser took the bytes."""

    def rows(it):
        for r in it:
            try:
                for n, d in enumerate(parse(r["url"] or "", r["mime"], r["charset"], bytes(r["content"] or b""))):
                    yield d | {"source": r["url"], "part": n, "error": None}
            except Failure as e:
                yield {"source": r["url"], "part": 0, "error": str(e)[:500], "url": r["url"], "mime": r["mime"]}

    return map_rows(df.select("url", "mime", "charset", "content"), rows, f"source string, part int, error string, {SCHEMA}", size=50)
