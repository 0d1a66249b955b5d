"""Text of a page's bytes by the charset that its header, its markup or its bytes tell.

Where nothing declares it, the bytes do: marks and zero bytes tell UTF-16, escapes ISO-2022-JP, and UTF-8 tells itself
even with a few broken places. Of the East Asian sets that one is taken in which most characters are everyday ones of its
language; bytes beyond ASCII that stand alone as Western letters inside words are none of those. Sets of one byte are told by the letters: how frequent they are in the language, whether
their neighbours are of the same script, and whether capitals stand inside words. A word that is repeated counts once. The fewer different ones there are, the more the usual set is preferred. Hungarian, whose own letters are rare
ones of Western languages, may pass for those.
"""

from __future__ import annotations

import codecs
import re
from collections import Counter

MARKS = ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF32_LE, "utf-32-le"), (codecs.BOM_UTF32_BE, "utf-32-be"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"))
HEADER = re.compile(r"charset\s*=\s*[\"']?([^\s;\"'>]+)", re.I)
MARKUP = re.compile(rb"<meta[^>]*charset\s*=\s*[\"']?\s*([a-zA-Z0-9_.:-]+)|<\?xml[^>]*encoding\s*=\s*[\"']([a-zA-Z0-9_.:-]+)", re.I)
#: What pages that name these sets really hold.
REALLY = {"iso-8859-1": "cp1252", "ascii": "cp1252", "iso-8859-9": "cp1254", "gb2312": "gb18030", "gbk": "gb18030", "euc_kr": "cp949", "shift_jis": "cp932"}


# Letters beyond ASCII by how frequent they are, for the languages of a set of one byte.
WESTERN, TURKISH, POLISH, CZECH, HUNGARIAN = "éíóàáñüèöäçãêßúåøæôâîûëïõùò", "ıüşöçğ", "ęąłóżśćńź", "íáéěžšřčýůúňťďóľôä", "éáóőöüúíű"
LATIN = (WESTERN, TURKISH, POLISH, CZECH, HUNGARIAN)
CYRILLIC = "оеаинтсрвлкмдпуяыьгзбчйхіжшюцщэфїєъё"
GREEK, HEBREW, ARABIC = "αοιετνσηυρπκμςλόίάωέήδγύχθώφβξζψ", "יוהלארתבשמםנכדפחעקצגטזןסךףץ", "اليمونترهةبعدسفكقحجشطصأخزىذضثءغئؤظإآ"
SINGLE = (
    [("cp1252", WESTERN), ("cp1254", TURKISH), ("cp1253", GREEK), ("cp1255", HEBREW), ("cp1256", ARABIC)]
    + [(name, letters) for name in ("cp1250", "iso8859_2") for letters in (POLISH, CZECH, HUNGARIAN)]
    + [(name, CYRILLIC) for name in ("cp1251", "koi8_r", "iso8859_5")]
)
#: East Asian sets: which first bytes hold a language's everyday characters in the set in brackets.
DOUBLE = {"cp949": ("euc_kr", 0xB0, 0xC8), "gb18030": ("gb2312", 0xB0, 0xD7), "big5": ("big5", 0xA4, 0xC6), "euc_jp": ("euc_jp", 0xB0, 0xCF), "cp932": ("euc_jp", 0xB0, 0xCF)}
TAG = re.compile(rb"<[^>]*>")
AROUND = re.compile(rb"(?=(.[\x80-\xff].))", re.S)
#: What sets of two bytes have and words of Western letters need not: bytes that are no letters of cp1252, or, where plain letters are fewer, two characters side by side.
SIGN, PAIRED = re.compile(rb"[\x80-\xbf\xd7\xf7]"), re.compile(rb"[\x80-\xff]{4}")
#: A word of another script. Where the letters are mostly plain ones and none has so many, the text is of a Latin set.
LONG, PLAIN = re.compile(rb"[\x80-\xff]{5}"), re.compile(rb"[A-Za-z]")
#: How much the usual set of the web is preferred (once, and again by the number of different letters that tell), what a letter of another script beside a plain one costs, and from which share of everyday characters on a set of two bytes is believed.
USUAL, USUALLY, MIXED, EVERYDAY = 0.2, 0.6, 1.5, 0.6


def letters_fit(name: str, letters: str, around: Counter) -> float:
    """The mean over bytes beyond ASCII, each with its neighbours: 1 for the most frequent letter, 0 for the rarest, less for what no word has."""
    chars = bytes(range(256)).decode(name, "replace")
    latin = letters in LATIN
    total = count = 0.0
    for (before, byte, after), n in around.items():
        c, left, right = chars[byte], chars[before], chars[after]
        beside = [x for x in (left, right) if x.isalpha()]
        if c != "\ufffd" and not beside:
            continue  # a sign or letter alone says nothing
        if c.isalpha():
            at = letters.find(c.lower())
            fit = -1.0 if c.isupper() and left.islower() else -0.5 if at < 0 else (1 - at / len(letters)) * (0.5 if c.isupper() else 1)
            fit -= sum(0.5 if latin else MIXED for x in beside if (x > "\x7f") == latin)
        elif c == "\ufffd" or len(beside) == 2:
            fit = -1.0
        else:
            continue
        total, count = total + n * fit, count + n
    return total / count if count else 0.0


def everyday(name: str, content: bytes) -> float:
    """The share of everyday characters among those beyond ASCII; 0 if the bytes cannot be of this set."""
    try:
        found = Counter(c for c in content.decode(name) if c > "\x7f")
    except UnicodeDecodeError:
        return 0.0
    plain, low, high = DOUBLE[name]
    japanese, good, count = plain == "euc_jp", 0.0, 0
    for c, n in found.items():
        if c in "\u3000、。，！？「」":
            continue
        first = c.encode(plain, "ignore")[:1]
        everyday_one = bool(first) and low <= first[0] <= high
        good += n * (1.0 if japanese and "\u3041" <= c <= "\u30fc" else 0.6 if japanese and everyday_one else everyday_one and not japanese)
        count += n
    return good / count if count else 0.0


def guessed(content: bytes) -> str:
    """The charset of bytes that nothing describes. All of them are read."""
    if zeros := content.count(0):
        even = content[::2].count(0)
        if zeros > len(content) // 4 and not 0.2 < even / zeros < 0.8:
            return "utf-16-be" if even * 2 > zeros else "utf-16-le"
    if b"\x1b$B" in content or b"\x1b$@" in content:
        return "iso2022_jp"
    text = content.decode("utf-8", "replace")
    broken = text.count("\ufffd")
    if broken * 2 <= sum(len(x) for x in re.findall(r"[^\x00-\x7f\ufffd]+", text)):
        return "utf-8"
    shown = b" ".join(dict.fromkeys(TAG.sub(b" ", content).split()))  # a word that fills the text counts once
    around = Counter(m[1] for m in AROUND.finditer(b" " + shown + b" "))
    plainly = len(PLAIN.findall(shown)) >= around.total()
    if SIGN.search(shown) or not plainly and PAIRED.search(shown):
        best, share = max(((name, everyday(name, shown)) for name in DOUBLE), key=lambda x: x[1])
        if share >= EVERYDAY:
            return best
    sets = [x for x in SINGLE if x[1] in LATIN] if plainly and not LONG.search(shown) else SINGLE
    usual = USUAL + USUALLY / max(1, len({byte for before, byte, after in around if before > 127 or after > 127 or chr(before).isalpha() or chr(after).isalpha()}))
    return max(sets, key=lambda x: letters_fit(*x, around) + (usual if x[0] == "cp1252" else 0))[0]


def known(name: str | None) -> str | None:
    try:
        found = codecs.lookup((name or "").strip().lower())
    except (LookupError, ValueError):
        return None
    return REALLY.get(found.name, found.name) if found._is_text_encoding else None


def charset_of(content: bytes, content_type: str | None) -> tuple[str, int]:
    """The charset and the length of the byte order mark."""
    for mark, name in MARKS:
        if content.startswith(mark):
            return name, len(mark)
    header = HEADER.search(content_type or "")
    markup = MARKUP.search(content[:1024])
    for name in (header and header[1], markup and (markup[1] or markup[2]).decode("ascii")):
        if found := known(name):
            return found, 0
    return guessed(content), 0


def text_of(content: bytes, content_type: str | None) -> str:
    name, skip = charset_of(content, content_type)
    return content[skip:].decode(name, "replace")
