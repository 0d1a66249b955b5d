"""Dates and times. Everything is UTC; the present is always a parameter."""

from __future__ import annotations

import calendar
import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.arrow import by_row

DAY_MS, HOUR_MS = 86_400_000, 3_600_000


def microdate_days(ts: Column) -> Column:
    return (F.floor(F.unix_millis(ts.cast("timestamp")) / DAY_MS) % 262144).cast("int")


def microdate_hours(ts: Column) -> Column:
    return (F.floor(F.unix_millis(ts.cast("timestamp")) / HOUR_MS) % 262144).cast("int")


def microdate_time(days: Column) -> Column:
    return F.timestamp_millis(days.cast("long") * DAY_MS)


HTTP_FORMATS = ("EEE, dd MMM yyyy HH:mm:ss", "EEEE, dd-MMM-yy HH:mm:ss", "EEE MMM d HH:mm:ss yyyy")


def http_date(s: Column) -> Column:
    """RFC 1123, RFC 1036 and asctime forms; null if none fits. Day names are not read, so wrong ones do no harm."""
    t = F.trim(F.regexp_replace(F.trim(s), r"\s*(GMT|UTC|Z)$", ""))
    body = F.regexp_replace(t, r"^[A-Za-z]+,\s*", "")
    asctime = F.regexp_replace(F.regexp_replace(t, r"^[A-Za-z]{3}\s+", ""), r"\s+", " ")
    return F.coalesce(F.try_to_timestamp(body, F.lit("d MMM yyyy HH:mm:ss")), F.try_to_timestamp(body, F.lit("dd-MMM-yy HH:mm:ss")), F.try_to_timestamp(asctime, F.lit("MMM d HH:mm:ss yyyy")))


def iso8601(s: Column) -> Column:
    """The longest reading of a date with optional time and zone; offsets count as what they say."""
    t = F.regexp_extract(s, r"([0-9]{4}(?:-[0-9]{2}(?:-[0-9]{2}(?:[T ][0-9]{2}:[0-9]{2}(?::[0-9]{2})?(?:\.[0-9]+)?(?:Z|[+-][0-9]{2}:?[0-9]{2})?)?)?)?)", 1)
    date = F.rpad(F.regexp_extract(t, r"^([0-9-]+?)(?:[T ]|$)", 1), 10, "-01-01")
    full = F.when(F.length(F.regexp_extract(t, r"^([0-9-]+?)(?:[T ]|$)", 1)) == 4, F.concat(F.substring(t, 1, 4), F.lit("-01-01"))).when(F.length(F.regexp_extract(t, r"^([0-9-]+?)(?:[T ]|$)", 1)) == 7, F.concat(F.substring(t, 1, 7), F.lit("-01"))).otherwise(date)
    clock = F.regexp_extract(t, r"[T ]([0-9]{2}:[0-9]{2}(?::[0-9]{2})?)", 1)
    clock = F.when(clock == "", F.lit("00:00:00")).when(F.length(clock) == 5, F.concat(clock, F.lit(":00"))).otherwise(clock)
    zone = F.regexp_extract(t, r"([+-])([0-9]{2}):?([0-9]{2})$", 0)
    has_zone = t.rlike(r":[0-9]{2}(\.[0-9]+)?[+-][0-9]{2}:?[0-9]{2}$")
    sign = F.when(F.regexp_extract(t, r"([+-])[0-9]{2}:?[0-9]{2}$", 1) == "-", -1).otherwise(1)
    minutes = sign * (F.regexp_extract(zone, r"([0-9]{2}):?[0-9]{2}$", 1).try_cast("int") * 60 + F.regexp_extract(zone, r"([0-9]{2})$", 1).try_cast("int"))
    base = F.try_to_timestamp(F.concat_ws(" ", full, clock), F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.when(t != "", F.timestamp_seconds(F.unix_seconds(base) - F.when(has_zone, minutes * 60).otherwise(0)))


GENERIC = {"short_day": "yyyyMMdd", "short_minute": "yyyyMMddHHmm", "short_second": "yyyyMMddHHmmss", "simple": "yyyy/MM/dd HH:mm:ss"}


def generic(s: Column, form: str) -> Column:
    return F.try_to_timestamp(s, F.lit(GENERIC[form]))


def iso8601_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def feed_date(s: Column) -> Column:
    return F.coalesce(http_date(F.regexp_replace(s, r"\s*[+-][0-9]{4}$", "")), iso8601(s))


def epoch_or_date(s: Column, now: Column) -> Column:
    """Seconds, then milliseconds since the epoch, then ISO and HTTP forms; nothing at or before the epoch or after now."""
    n = s.try_cast("long")
    forms = [F.when(n < 10**11, F.timestamp_seconds(n)), F.timestamp_millis(n), iso8601(s), http_date(s)]
    zero = F.timestamp_seconds(F.lit(0))
    return F.coalesce(*[F.when((x > zero) & (x <= now), x) for x in forms])


def fresh_until(load: Column, modified: Column) -> Column:
    """Load time plus half the age at load."""
    return F.timestamp_millis(F.unix_millis(load) + F.floor(F.greatest(F.lit(0), F.unix_millis(load) - F.unix_millis(modified.cast("timestamp"))) / 2))


# Dates in running text

# Month names in six languages, in the order of the months.
MONTHS = {
    "en": "january february march april may june july august september october november december",
    "de": "januar februar märz april mai juni juli august september oktober november dezember",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "it": "gennaio febbraio marzo aprile maggio giugno luglio agosto settembre ottobre novembre dicembre",
    "cs": "leden únor březen duben květen červen červenec srpen září říjen listopad prosinec",
}


def month_numbers() -> dict[str, int]:
    """Names and their first three letters; three letters that stand for two months in different languages are left out."""
    out: dict[str, int] = {}
    short: dict[str, set[int]] = {}
    for names in MONTHS.values():
        for i, n in enumerate(names.split(), 1):
            out[n] = i
            short.setdefault(n[:3], set()).add(i)
    return {s: min(m) for s, m in short.items() if len(m) == 1} | out


MONTH = month_numbers()
_NAME = r"([^\W\d_]{3,11})\.?"
_D, _M, _Y = r"(\d{1,2})", r"(\d{1,2})", r"(\d{4}|\d{2})"
_EDGE, _STOP = r"(?:^|(?<=[\s(,;:]))", r"(?=$|[\s),;:.!?])"
DMY = re.compile(rf"{_EDGE}{_D}(?:\.\s?|\s|-|/){_NAME}(?:\s|-|/|,\s?){_Y}{_STOP}|{_EDGE}{_D}([./-]){_M}\5{_Y}{_STOP}")
SHORT = re.compile(rf"{_EDGE}(?:am|le|il|el)\s{_D}\.?\s{_NAME}(?!\s\d){_STOP}", re.I)
MDY = re.compile(rf"{_EDGE}(?:on\s)?{_NAME}\s{_D}(?:st|nd|rd|th)?,?\s{_Y}{_STOP}|{_EDGE}{_M}/{_D}/{_Y}{_STOP}")
ON = re.compile(rf"{_EDGE}on\s{_NAME}\s{_D}(?:st|nd|rd|th)?(?!,?\s\d){_STOP}")
YMD = re.compile(rf"{_EDGE}(\d{{4}})([./-]){_M}\2{_D}{_STOP}|{_EDGE}(\d{{4}})\s{_NAME}\s{_D}{_STOP}")
MOST = 100


def easter(year: int) -> dt.date:
    a, b, c = year % 19, year // 100, year % 100
    d = (19 * a + b - b // 4 - ((b - (b + 8) // 25 + 1) // 3) + 15) % 30
    e = (32 + 2 * (b % 4) + 2 * (c // 4) - d - c % 4) % 7
    f = d + e - 7 * ((a + 11 * d + 22 * e) // 451) + 114
    return dt.date(year, f // 31, f % 31 + 1)


# Holiday names, with a day of the year or days after Easter Sunday.
FIXED_DAYS = {"Neujahr": (1, 1), "New Year's Day": (1, 1), "Tag der Arbeit": (5, 1), "Tag der Deutschen Einheit": (10, 3), "Reformationstag": (10, 31), "Halloween": (10, 31), "Allerheiligen": (11, 1), "Nikolaus": (12, 6), "Heiligabend": (12, 24), "Christmas Eve": (12, 24), "Christmas": (12, 25), "Silvester": (12, 31)}
EASTER_DAYS = {"Rosenmontag": -48, "Fastnacht": -47, "Aschermittwoch": -46, "Palmsonntag": -7, "Karfreitag": -2, "Good Friday": -2, "Ostersonntag": 0, "Easter Sunday": 0, "Ostermontag": 1, "Easter Monday": 1, "Christi Himmelfahrt": 39, "Pfingstsonntag": 49, "Pfingstmontag": 50, "Fronleichnam": 60}


def holidays(run: dt.date) -> list[tuple[str, list[dt.date]]]:
    """Each name with its dates in the years around the run."""
    years = range(run.year - 1, run.year + 3)
    return [(n, [dt.date(y, m, d) for y in years]) for n, (m, d) in FIXED_DAYS.items()] + [(n, [easter(y) + dt.timedelta(k) for y in years]) for n, k in EASTER_DAYS.items()]


def _date(day: str, month: str | int, year: str, run: dt.date) -> dt.date | None:
    m = month if isinstance(month, int) else int(month) if month.isdigit() else MONTH.get(month.lower(), MONTH.get(month.lower()[:3], 0))
    y, d = int(year), int(day)
    y += 2000 if y < 100 else 0
    if not 1 <= m <= 12 or y > run.year + 10 or y < 1000 or not 1 <= d <= max(calendar.monthrange(2020, m)[1], 28):
        return None
    return dt.date(y, m, d) if d <= calendar.monthrange(y, m)[1] else dt.date(y, m, 28) + dt.timedelta(d - 28)


def dates_in(text: str, run: dt.date) -> list[dt.date]:
    """Dates of a text: by day first, else month first, else year first; then holidays. More than a hundred count as noise."""
    out: set[dt.date] = set()
    if any(c.isdigit() for c in text):
        for m in DMY.finditer(text):
            out.add(_date(m[1], m[2], m[3], run) if m[1] else _date(m[4], m[6], m[7], run))
        for m in SHORT.finditer(text):
            out.update(_date(m[1], m[2], str(run.year + k), run) for k in (0, 1))
        out.discard(None)
        if not out:
            for m in MDY.finditer(text):
                out.add(_date(m[2], m[1], m[3], run) if m[1] else _date(m[5], m[4], m[6], run))
            for m in ON.finditer(text):
                out.update(_date(m[2], m[1], str(run.year + k), run) for k in (0, 1))
            out.discard(None)
        if not out:
            for m in YMD.finditer(text):
                out.add(_date(m[4], m[3], m[1], run) if m[1] else _date(m[7], m[6], m[5], run))
            out.discard(None)
        if len(out) > MOST:
            out.clear()
    for name, days in holidays(run):
        if name in text:
            out.update(days)
    return sorted(out)


def dates_in_text(run: dt.date):
    """A function from texts to arrays of dates."""
    return by_row(lambda t: dates_in(t or "", run), T.ArrayType(T.DateType()))
