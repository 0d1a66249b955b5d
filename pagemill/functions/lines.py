"""The date that a line names, as column expressions only."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions import times

_D, _Y, _NAME = r"(\d{1,2})", r"(\d{4}|\d{2})", r"(\p{L}{3,11})\.?"
_EDGE, _STOP = r"(?:^|(?<=[\s(,;:]))", r"(?=$|[\s),;:.!?])"
#: Patterns of a style with the groups of day, month and year; no year means this year and the next. The first style that finds a date decides.
STYLES = [
    [(rf"{_EDGE}{_D}(?:\.\s?|\s|-|/){_NAME}(?:\s|-|/|,\s?){_Y}{_STOP}", 1, 2, 3), (rf"{_EDGE}{_D}([./-]){_D}\2{_Y}{_STOP}", 1, 3, 4), (rf"(?iu){_EDGE}(?:am|le|il|el)\s{_D}\.?\s{_NAME}(?!\s\d){_STOP}", 1, 2, 0)],
    [(rf"{_EDGE}(?:on\s)?{_NAME}\s{_D}(?:st|nd|rd|th)?,?\s{_Y}{_STOP}", 2, 1, 3), (rf"{_EDGE}{_D}/{_D}/{_Y}{_STOP}", 2, 1, 3), (rf"{_EDGE}on\s{_NAME}\s{_D}(?:st|nd|rd|th)?(?!,?\s\d){_STOP}", 2, 1, 0)],
    [(rf"{_EDGE}(\d{{4}})([./-]){_D}\2{_D}{_STOP}", 4, 3, 1), (rf"{_EDGE}(\d{{4}})\s{_NAME}\s{_D}{_STOP}", 3, 2, 1)],
]
# Days told from the present one.
RELATIVE = {"today": 0, "heute": 0, "tomorrow": 1, "morgen": 1, "dayaftertomorrow": 2, "uebermorgen": 2, "yesterday": -1, "gestern": -1}
#: Of a month at most.
DAYS = [31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]


def _map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def _parts(day: Column, month: Column, year: Column) -> Column:
    """Texts or numbers as a struct of whole numbers, so that each is worked out once."""
    names, low = _map(times.MONTH), F.lower(month.cast("string"))
    m = F.coalesce(month.try_cast("int"), F.try_element_at(names, low), F.try_element_at(names, F.left(low, F.lit(3))))
    y = year.try_cast("int")
    return F.struct(day.try_cast("int").alias("d"), m.alias("m"), F.when(y < 100, y + 2000).otherwise(y).alias("y"))


def _dates(parts: Column, run: dt.date) -> Column:
    """The dates of an array of such structs. The 29th of February of other years is the 1st of March."""
    longest = F.array(*map(F.lit, DAYS))
    fits = lambda p: (p["m"] >= 1) & (p["m"] <= 12) & (p["d"] >= 1) & (p["y"] >= 1000) & (p["y"] <= run.year + 10) & (p["d"] <= F.try_element_at(longest, p["m"]))
    return F.transform(F.filter(parts, fits), lambda p: F.date_add(F.make_date(p["y"], p["m"], F.lit(1)), p["d"] - 1))


def _found(line: Column, pattern: str, day: int, month: int, year: int, run: dt.date) -> Column:
    """The dates of all places where a pattern fits."""
    part = lambda g: F.regexp_extract_all(line, F.lit(pattern), F.lit(g))
    if year:
        parts = F.transform(F.arrays_zip(part(day).alias("d"), part(month).alias("m"), part(year).alias("y")), lambda x: _parts(x["d"], x["m"], x["y"]))
    else:
        parts = F.flatten(F.transform(F.arrays_zip(part(day).alias("d"), part(month).alias("m")), lambda x: F.array(*[_parts(x["d"], x["m"], F.lit(run.year + k)) for k in (0, 1)])))
    return F.when(line.rlike(pattern), _dates(parts, run)).otherwise(F.expr("cast(array() as array<date>)"))


def line_date(line: Column, run: dt.date) -> Column:
    """The date of a line with one expression: fixed formats from its start, then dates as in running text (the earliest), then words
    for days around ``run``, then a holiday's name (its day in the year of ``run``). Null if there is none."""
    start = lambda p, *g: [F.nullif(F.regexp_extract(line, p, i), F.lit("")) for i in g]
    y, m, d = start(r"^(\d{4})/(\d{1,2})/(\d{1,2})", 1, 2, 3)
    d1, m1, y1 = start(r"^[A-Za-z]{3}, (\d{1,2}) ([A-Za-z]{3}) (\d{4})", 1, 2, 3)
    m2, d2, y2 = start(r"^[A-Za-z]{3} ([A-Za-z]{3}) +(\d{1,2}) \d{2}:\d{2}:\d{2} (\d{4})", 1, 2, 3)
    fixed = [F.try_element_at(_dates(F.array(_parts(*x)), run), F.lit(1)) for x in ((d, m, y), (d1, m1, y1), (d2, m2, y2))]
    raw = [F.when(line.rlike("[0-9]"), F.array_min(F.concat(*[_found(line, *p, run) for p in style]))) for style in STYLES]
    near = F.date_add(F.lit(run), F.try_element_at(_map(RELATIVE), line))
    feast = F.try_element_at(_map({name: days[1] for name, days in times.holidays(run)}), line)
    return F.coalesce(*fixed, *raw, near, feast)
