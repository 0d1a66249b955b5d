"""Everything the index record needs from a page's markup, in one pass.

The reader is deliberately literal: an element ends only at its own end tag, and an
end tag that does not match the innermost open element is content of that element. What
is still open at the end of the page is not reported, except the innermost one.
An element's content is its text and the source of its children; a child that was
left open swallows what follows. Text is collected as it is met, so the page's
text is whole even where elements are not.
"""

from __future__ import annotations

import json
import re
from collections import Counter, deque
from urllib.parse import urljoin

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from pagemill import ship
from pagemill.arrow import by_row

# Elements that stand alone, and those with content.
SINGLE = frozenset("area base basefont br col embed frame hr html iframe img input link meta param source".split())
PAIR = frozenset(
    "a abbr acronym address applet article aside audio b bdi bdo big blockquote body button canvas caption center cite code colgroup data datalist dd del details dfn dialog "
    "dir div dl dt em fieldset figcaption figure font footer form frameset h1 h2 h3 h4 h5 h6 head header i ins li p script small span strong style time title u".split()
)
# Entities that are decoded, besides numeric ones.
ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "iexcl": "¡", "cent": "¢", "pound": "£", "curren": "¤", "yen": "¥", "brvbar": "¦", "sect": "§", "uml": "¨",
    "copy": "©", "ordf": "ª", "laquo": "«", "not": "¬", "shy": "­", "reg": "®", "macr": "¯", "deg": "°", "plusmn": "±", "sup2": "²", "sup3": "³", "acute": "´", "micro": "µ", "para": "¶",
    "middot": "·", "cedil": "¸", "sup1": "¹", "ordm": "º", "raquo": "»", "frac14": "¼", "frac12": "½", "frac34": "¾", "iquest": "¿", "Auml": "Ä", "auml": "ä", "Ouml": "Ö", "ouml": "ö", "Uuml": "Ü",
    "uuml": "ü", "szlig": "ß", "Aacute": "Á", "aacute": "á", "Agrave": "À", "agrave": "à", "Acirc": "Â", "acirc": "â", "Aring": "Å", "aring": "å", "AElig": "Æ", "aelig": "æ", "Ccedil": "Ç", "ccedil": "ç",
    "Eacute": "É", "eacute": "é", "Egrave": "È", "egrave": "è", "Ecirc": "Ê", "ecirc": "ê", "Euml": "Ë", "euml": "ë", "Iacute": "Í", "iacute": "í", "Ntilde": "Ñ", "ntilde": "ñ", "Oacute": "Ó", "oacute": "ó",
    "Oslash": "Ø", "oslash": "ø", "Uacute": "Ú", "uacute": "ú", "euro": "€", "trade": "™", "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "bull": "•", "hellip": "…",
}
_REF = re.compile(r"&(?:#([0-9]{1,7})|#[xX]([0-9a-fA-F]{1,6})|([a-zA-Z][a-zA-Z0-9]{1,7}));")
_BLANKS = re.compile(r"[\x00- ]+")
_CONTROL = re.compile(r"[\x00-\x07\x0e-\x1f]")
_TOKEN = re.compile(r"<!--.{1,}?-.>|<!--.*\Z|<(?:[^<>\"']|\"[^\">]*(?:\"|(?=>))|'[^'>]*(?:'|(?=>)))*(?:>|(?=<)|\Z)|[^<]+", re.S)
_NAME = re.compile(r"</?([!a-zA-Z0-9-]*)")
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_LINK = re.compile(r"(?:smb|ftp|http|https)://[^ ]*")
_POINT = re.compile(r"([NS]) ([0-9]+(?:\.[0-9]+)?)° ?([0-9]+(?:\.[0-9]+)?)['′]?|([EW]) ([0-9]+(?:\.[0-9]+)?)° ?([0-9]+(?:\.[0-9]+)?)['′]?")
_INT = re.compile(r" *([+-]?[0-9]+)")
MAX_HEAD, MAX_ANCHOR, MAX_LINKS = 1024, 2048, 10_000

SCHEMA = """titles array<string>, h1 array<string>, h2 array<string>, h3 array<string>, h4 array<string>, h5 array<string>, h6 array<string>,
    bold array<struct<text:string,n:int,first:int>>, italic array<struct<text:string,n:int,first:int>>, underline array<struct<text:string,n:int,first:int>>,
    li array<string>, dt array<string>, dd array<string>, articles array<string>, metas map<string,string>,
    anchors array<struct<url:string,text:string,name:string,rel:string>>, images array<struct<url:string,alt:string,width:int,height:int>>,
    icons array<struct<url:string,rels:array<string>,sizes:array<string>>>, css array<string>, scripts array<string>, frames array<string>, iframes array<string>,
    embeds array<struct<url:string,width:int,height:int,type:string>>, rss array<struct<url:string,title:string>>, hreflang map<string,string>, navigation map<string,string>,
    canonical string, publisher_link string, breadcrumbs int, start_dates array<string>, end_dates array<string>, lat double, lon double, text string, ld array<string>, language string, binary boolean"""


def decode(s: str) -> str:
    """References become characters; what &amp; sets free is decoded as well; unknown ones stay."""
    if "&" not in s:
        return s

    def one(m: re.Match) -> str:
        if m[3]:
            return ENTITIES.get(m[3], m[0])
        n = int(m[1]) if m[1] else int(m[2], 16)
        return chr(n) if 0 < n < 0x110000 and not 0xD800 <= n < 0xE000 else "" if m[1] else m[0]

    return _REF.sub(one, s.replace("&amp;", "&"))


def strip_tags(s: str) -> str:
    """Text outside angle brackets; brackets nest."""
    if "<" not in s and ">" not in s:
        return s.strip()
    out, depth = [], 0
    for part in re.split(r"([<>])", s):
        if part == "<":
            depth += 1
            if out and not out[-1].endswith(" "):
                out.append(" ")
        elif part == ">":
            depth -= 1
        elif depth <= 0 and part:
            out.append(part)
    return "".join(out).strip()


def clean(s: str) -> str:
    return _BLANKS.sub(" ", s).strip(" ")


def plain(s: str) -> str:
    return clean(decode(strip_tags(s)))


def size_of(s: str | None) -> int | None:
    """-1 if missing, None if unusable or no int (the image is then dropped), 0 for words such as auto."""
    if s is None:
        return -1
    m = _INT.match(s)
    if m:
        n = int(m[1])
        return n if -(1 << 31) <= n < 1 << 31 else None
    return 0 if s.strip()[:1] >= ":" else None


def new_item(a: dict[str, str]) -> dict:
    """A linked-data node from the attributes of microdata or RDFa."""
    kind = a.get("itemtype") or a.get("typeof") or ""
    out: dict = {}
    if "/" in kind:
        out["@context"], _, kind = kind.rpartition("/")
    elif a.get("vocab"):
        out["@context"] = a["vocab"]
    if kind:
        out["@type"] = kind
    if a.get("itemid") or a.get("resource") or a.get("about"):
        out["@id"] = a.get("itemid") or a.get("resource") or a.get("about")
    return out


class Element:
    __slots__ = ("name", "attrs", "parts", "item")

    def __init__(self, name: str, attrs: dict[str, str]):
        self.name, self.attrs, self.parts = name, attrs, []
        self.item = new_item(attrs) if "itemscope" in attrs or "typeof" in attrs else None

    def source(self) -> str:
        opts = "".join(f' {k}="{v}"' for k, v in self.attrs.items())
        inner = "".join(self.parts)
        return f"<{self.name}{opts}>{inner}</{self.name}>" if inner else f"<{self.name}{opts}/>"


class Reader:
    """Accumulates what a page gives."""

    token = _TOKEN

    def __init__(self, url: str):
        self.base = url
        self.lists: dict[str, list] = {k: [] for k in ("titles", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "articles", "anchors", "images", "icons", "css", "scripts", "frames", "iframes", "embeds", "rss", "start_dates", "end_dates", "ld")}
        self.styles = {k: Counter() for k in ("bold", "italic", "underline")}
        self.lists["anchors"] = deque(maxlen=MAX_LINKS)  # the oldest go
        self.metas: dict[str, str] = {}
        self.hreflang: dict[str, str] = {}
        self.navigation: dict[str, str] = {}
        self.one: dict = {"canonical": None, "publisher_link": None, "breadcrumbs": 0, "lat": 0.0, "lon": 0.0, "language": None}
        self.text: list[str] = []
        self.off = False

    def resolve(self, link: str) -> str:
        try:
            return urljoin(self.base, link.strip())
        except ValueError:
            return link.strip()

    def put(self, kind: str, value, once: bool = False) -> None:
        if not once or value not in self.lists[kind]:
            self.lists[kind].append(value)

    def anchor(self, url: str, text: str = "", name: str = "", rel: str = "") -> None:
        if url:
            self.put("anchors", {"url": url, "text": text, "name": name, "rel": rel})

    def read(self, page: str) -> None:
        stack: list[Element] = []
        for m in self.token.finditer(page):
            token = m[0]
            top = stack[-1] if stack else None
            if token[0] != "<" or len(token) <= 2:
                self.words(token, top.name if top else None)
                if top:
                    top.parts.append(token)
                continue
            if token.startswith("<!--"):
                self.remark(token)
                continue
            name = _NAME.match(token)[1].lower()
            if token[1] == "/":
                if top and top.name == name:
                    stack.pop()
                    self.closed(top)
                    self.learn(top.attrs, top.item, "".join(top.parts), stack)
                    if stack:
                        stack[-1].parts.append(top.source())
                elif top:
                    top.parts.append(token)
                continue
            if top and top.name == "script":
                continue
            attrs = self.attributes(token[1 + len(name) :].rstrip(">"))
            if name in SINGLE:
                self.single(name, attrs)
                if stack:
                    self.learn(attrs, None, "", stack)
            if name in PAIR:
                self.opened(name, attrs)
                stack.append(Element(name, attrs))
            elif top:
                top.parts.append(token)
        if stack:
            self.closed(stack[-1])

    @staticmethod
    def attributes(raw: str) -> dict[str, str]:
        return {m[1].lower(): m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or "" for m in _ATTR.finditer(raw)} if raw.strip() else {}

    def remark(self, comment: str) -> None:
        self.off = True if "googleoff:" in comment else False if "googleon:" in comment else self.off

    def opened(self, name: str, a: dict[str, str]) -> None:
        self.properties(a)

    def words(self, raw: str, inside: str | None) -> None:
        if self.off or inside in ("script", "style"):
            return
        s = decode(raw)
        if "°" in s:
            for m in _POINT.finditer(s):
                if m[1]:
                    self.one["lat"] = (-1 if m[1] == "S" else 1) * (float(m[2]) + float(m[3]) / 60)
                else:
                    self.one["lon"] = (-1 if m[4] == "W" else 1) * (float(m[5]) + float(m[6]) / 60)
        s = clean(strip_tags(s))
        if not s:
            return
        if inside is not None and inside != "a" and s[-1] not in ".!?":
            s += "."
        if "://" in s:
            for m in _LINK.finditer(s):
                self.anchor(m[0].removesuffix("."))
        self.text.append(s)

    def properties(self, a: dict[str, str]) -> None:
        prop = a.get("itemprop") or a.get("property") or ""
        content = a.get("content") or a.get("datetime") or ""
        if prop in ("latitude", "longitude"):
            try:
                self.one[prop[:3]] = float(content)
            except ValueError:
                pass
        elif prop in ("startDate", "endDate") and content:
            self.put("start_dates" if prop == "startDate" else "end_dates", content)

    def learn(self, a: dict[str, str], item: dict | None, inner: str, above: list[Element]) -> None:
        """A property goes to the nearest open item; an item that is no property is a node of the page."""
        names = (a.get("itemprop") or a.get("property") or "").split()
        owner = next((e.item for e in reversed(above) if e.item is not None), None)
        if names and owner is not None:
            value = item if item is not None else a.get("content") or a.get("datetime") or (self.resolve(a.get("href") or a.get("src") or "") if a.get("href") or a.get("src") else plain(inner))
            for n in names:
                owner.setdefault(n, []).append(value)
        elif item:
            self.put("ld", json.dumps(item, ensure_ascii=False))

    def single(self, name: str, a: dict[str, str]) -> None:
        self.properties(a)
        if name == "img" and a.get("src"):
            w, h = size_of(a.get("width")), size_of(a.get("height"))
            if w is not None and h is not None:
                url = self.resolve(a["src"])
                self.lists["images"] = [x for x in self.lists["images"] if x["url"] != url] + [{"url": url, "alt": plain(a.get("alt", "")), "width": w, "height": h}]
        elif name == "base" and a.get("href"):
            self.base = self.resolve(a["href"])
        elif name in ("frame", "iframe") and a.get("src"):
            self.put(name + "s", self.resolve(a["src"]), once=True)
        elif name == "meta":
            key = a.get("name") or a.get("http-equiv") or a.get("property")
            if key:
                self.metas[key.lower()] = decode(a.get("content", ""))
        elif name == "area" and a.get("href"):
            self.anchor(self.resolve(a["href"]), decode(a.get("alt", "")), a.get("name", ""), a.get("rel", ""))
        elif name == "link" and a.get("href"):
            self.link(a)
        elif name in ("embed", "source") and a.get("src"):
            w, h = size_of(a.get("width")), size_of(a.get("height"))
            if w is not None and h is not None:
                self.put("embeds", {"url": self.resolve(a["src"]), "width": w, "height": h, "type": a.get("type", "")})
        elif name == "param" and a.get("name", "").lower() == "movie" and a.get("value"):
            self.anchor(self.resolve(a["value"]))
        elif name == "html" and len(a.get("lang", "")) >= 2:
            self.one["language"] = a["lang"][:2].lower()

    def link(self, a: dict[str, str]) -> None:
        url, rel, kind = self.resolve(a["href"]), a.get("rel", "").lower(), a.get("type", "").lower()
        rels = rel.split()
        icons = [r for r in rels if r in ("icon", "apple-touch-icon", "apple-touch-icon-precomposed", "mask-icon", "fluid-icon")]
        if icons:
            self.put("icons", {"url": url, "rels": icons, "sizes": [s.lower() for s in a.get("sizes", "").split() if re.fullmatch(r"\d+[xX]\d+", s)]})
        elif rel == "canonical":
            self.one["canonical"] = url
            self.anchor(url, decode(a.get("title", "")), a.get("name", ""), rel)
        elif rel == "publisher":
            self.one["publisher_link"] = url
        elif rel in ("top", "up", "next", "prev", "first", "last"):
            self.navigation[rel] = url
        elif "alternate" in rels and kind in ("application/rss+xml", "application/atom+xml"):
            self.put("rss", {"url": url, "title": decode(a.get("title", ""))})
        elif "alternate" in rels and a.get("hreflang"):
            self.hreflang[a["hreflang"]] = url
        elif "stylesheet" in rels:
            if kind == "text/css":
                self.put("css", url, once=True)
        else:
            self.anchor(url, decode(a.get("title", "")), a.get("name", ""), rel)

    def closed(self, e: Element) -> None:
        name, a = e.name, e.attrs
        if name == "a":
            inner = "".join(e.parts)
            if len(inner) < MAX_ANCHOR and a.get("href"):
                rel = a.get("rel", "")
                if "nofollow" in self.metas.get("robots", "").lower() and "nofollow" not in rel:
                    rel = f"{rel} nofollow".strip()
                self.anchor(self.resolve(a["href"]), plain(inner), a.get("name", ""), rel)
        elif name == "script":
            if a.get("src"):
                self.put("scripts", self.resolve(a["src"]), once=True)
            elif a.get("type", "").lower() == "application/ld+json":
                self.put("ld", "".join(e.parts).strip())
        elif name in ("h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd"):
            inner = "".join(e.parts)
            if len(inner) < MAX_HEAD and (t := plain(inner)):
                self.put(name, t)
        elif name == "title":
            self.put("titles", plain("".join(e.parts)), once=True)
        elif name in ("b", "strong", "em", "i", "u"):
            inner = "".join(e.parts)
            if len(inner) < MAX_HEAD and (t := plain(inner)):
                self.styles[{"i": "italic", "u": "underline"}.get(name, "bold")][t] += 1
        elif name == "article":
            self.put("articles", plain("".join(e.parts)))
        elif name == "time" and a.get("datetime"):
            self.put("start_dates", a["datetime"])
        elif name == "div" and "breadcrumb" in a.get("itemtype", "").lower():
            self.one["breadcrumbs"] += 1

    def result(self) -> dict:
        styles = {k: [{"text": t, "n": n, "first": i} for i, (t, n) in enumerate(c.items())] for k, c in self.styles.items()}
        return self.lists | styles | self.one | {"anchors": list(self.lists["anchors"]), "metas": self.metas, "hreflang": self.hreflang, "navigation": self.navigation, "text": " ".join(self.text), "binary": False}


def parse(page: str | None, url: str | None) -> dict:
    """A page's record as SCHEMA has it. A page with binary characters gives only that mark."""
    r = Reader(url or "")
    if page and _CONTROL.search(page):
        return r.result() | {"binary": True}
    r.read(page or "")
    return r.result()


def with_html(df: DataFrame, html: str = "html", url: str = "url", out: str = "page") -> DataFrame:
    """The rows with a struct ``out`` of what the markup gives; the markup itself is dropped after reading."""
    ship.ensure(df.sparkSession)
    read = by_row(parse, StructType.fromDDL(SCHEMA)).asNondeterministic()  # else a filter on its fields would read each page again
    return df.select(*[c for c in df.columns if c not in (html, out)], read(html, url).alias(out))
