"""Text functions as Column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = r"[\x00- ]+"


def clean_line(s: Column) -> Column:
    """Controls and blanks become one blank; trimmed."""
    return F.trim(F.regexp_replace(s, BLANKS, " "))


def word_count(s: Column) -> Column:
    """0 for the empty text, else one more than its blanks."""
    return F.when(F.coalesce(s, F.lit("")) == "", 0).otherwise(F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit(""))) + 1).cast("long")


def sentences(s: Column) -> Column:
    """Apart after . ! or ? where neither a letter, a digit nor such a mark follows."""
    marked = F.regexp_replace(F.regexp_replace(s, BLANKS, " "), r"([.!?][^\p{L}\p{Nd}.!?])", "$1\u0001")
    return F.filter(F.transform(F.split(marked, "\u0001"), lambda x: F.trim(x)), lambda x: x != "")


#: Punctuation that is written by its number.
NUMBERED = "\\^`{|}~"


def encoded(s: Column, entities: dict[str, str], with_ampersand: bool = True) -> Column:
    """Characters as references to these entities (name to character), some punctuation by its number. A text is gone through for those characters alone that it has, the ampersand first, as all others bring ampersands in."""
    names = {c: f"&{n};" for n, c in entities.items() if len(c) == 1 and c not in "' \u00a0" and (with_ampersand or c != "&")} | {c: f"&#{ord(c):03};" for c in NUMBERED}

    def one(t: str) -> str:
        for c in sorted(names.keys() & set(t), key=lambda c: c != "&"):
            t = t.replace(c, names[c])
        return t

    @F.pandas_udf("string")
    def references(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else one(t) for t in texts], dtype=object)

    return references(s)


def normalized_term(s: Column) -> Column:
    """Trimmed small letters, umlauts spelled out, commas as blanks."""
    out = F.lower(F.trim(s))
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"), (",", " ")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def keywords(s: Column) -> Column:
    """Apart at commas, else at semicolons, else at blanks; trimmed, distinct, in order."""
    parts = F.when(s.contains(","), F.split(s, ",")).when(s.contains(";"), F.split(s, ";")).otherwise(F.split(s, r"\s+"))
    return F.array_distinct(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != ""))


def charset_name(s: Column) -> Column:
    """Common misspellings of charset names put right; null if too short to be one."""
    t = F.upper(F.trim(F.regexp_replace(s, "[\"']", "")))
    return (
        F.when(s.isNull() | (F.length(F.trim(s)) < 3), F.lit(None).cast("string"))
        .when(t.rlike("^UTF[_ -]?8$"), "UTF-8").when(t.rlike("^UTF[_ -]?16$"), "UTF-16")
        .when(t.rlike(r"^(X-)?(WINDOWS|CP|WIN)[_ -]?125[0-8]$"), F.concat(F.lit("windows-"), F.regexp_extract(t, "(125[0-8])$", 1)))
        .when(t.rlike(r"^ISO[_ -]?8859[_ -]?[0-9]{1,2}$"), F.concat(F.lit("ISO-8859-"), F.regexp_extract(t, "([0-9]{1,2})$", 1)))
        .when(t.rlike("^(US[_ -]?)?ASCII$"), "US-ASCII").when(t.rlike("^LATIN[_ -]?1$"), "ISO-8859-1")
        .when(t.rlike("^(X-)?SJIS$|^SHIFT[_ -]?JIS$"), "Shift_JIS").when(t.rlike("^GB[_ -]?2312$"), "GB2312").when(t.rlike("^BIG[_ -]?5$"), "Big5")
        .otherwise(t)
    )


def bytes_name(n: Column) -> Column:
    """A size in words: steps of 1024, taken if the number exceeds the unit."""
    out = F.when(n.isNull() | (n < 0), F.lit("unknown"))
    for unit, k in (("gbyte", 1 << 30), ("mbyte", 1 << 20), ("kbyte", 1 << 10)):
        out = out.when(n > k, F.concat(F.floor(n / k).cast("string"), F.lit(f" {unit}")))
    return out.otherwise(F.concat(n.cast("string"), F.lit(" byte")))


def leading_int(s: Column) -> Column:
    """The number at the start; 0 if a character above the digits stands there; null if one below, or nothing."""
    digits = F.regexp_extract(s, r"^ *([+-]?[0-9]+)", 1)
    return F.when(digits != "", digits.try_cast("int")).when(s.rlike(r"^ *[:-\x{10FFFF}]"), F.lit(0))


def content_charset(content_type: Column) -> Column:
    got = F.regexp_extract(content_type, r"(?i)charset\s*=\s*[\"']?([^\s;\"']+)", 1)
    return F.when(got != "", got)


def media_type(content_type: Column) -> Column:
    """The mime type in its normal form: small letters, cut at the semicolon."""
    return F.lower(F.trim(F.substring_index(content_type, ";", 1)))


def nth_field(s: Column, separator: str, n: int) -> Column:
    return F.split_part(s, F.lit(separator), F.lit(n))


def robots_mask(meta: Column, header: Column) -> Column:
    """Bits 0-5 from the robots meta element, 8-16 from the X-Robots-Tag header; none sets noindex and nofollow there."""
    out = F.lit(0)
    low, high = F.lower(F.coalesce(meta, F.lit(""))), F.lower(F.coalesce(header, F.lit("")))
    for bit, word in enumerate(("all", "index", "follow", "noindex", "nofollow", "noarchive")):
        named = low.rlike(rf"(^|[ ,]){word}") if word in ("index", "follow") else low.contains(word)
        out = out.bitwiseOR(F.when(named, 1 << bit).otherwise(0))
    for bit, word in enumerate(("all", "noindex", "nofollow", "noarchive", "nosnippet", "noodp", "notranslate", "noimageindex", "unavailable_after"), 8):
        named = high.contains(word) | high.contains("none") if word in ("noindex", "nofollow") else high.contains(word)
        out = out.bitwiseOR(F.when(named, 1 << bit).otherwise(0))
    return out


def header_text(headers: Column) -> Column:
    """A map of headers as lines, names sorted."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\r\n")


def headers_of(text: Column) -> Column:
    """Header lines as a map with small-letter names; of repeated names the last value."""
    lines = F.filter(F.split(text, r"\r?\n"), lambda x: x.contains(":"))
    pairs = F.transform(lines, lambda x: F.struct(F.lower(F.trim(F.substring_index(x, ":", 1))).alias("k"), F.trim(F.regexp_extract(x, "^[^:]*:(.*)$", 1)).alias("v")))
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.transform(F.filter(pairs, lambda p: p["k"] == k), lambda p: p["v"]), -1)))


def picked_language(declared: Column, domain: Column) -> Column:
    """The only declared language, else that of the top-level domain if declared, else the first."""
    return F.when(F.size(declared) == 1, F.element_at(declared, 1)).when(F.array_contains(declared, domain), domain).otherwise(F.try_element_at(declared, F.lit(1)))
