"""Scalar functions against known values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pagemill.functions import codec, geo, phonetic, times
from pagemill.functions import text as T
from pagemill.functions import url as U


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize("given,want", [("HTTP://A.Org:80/x/../y/./z#f", "http://a.org/y/z"), ("https://a.org", "https://a.org/"), ("http://a.org:8080/q?b=1#c", "http://a.org:8080/q?b=1"), ("http://a.org/a/b/..", "http://a.org/a/")])
def test_normal_form(spark, given, want):
    assert one(spark, U.normal_form(F.col("u")), u=given) == want


def test_host_parts(spark):
    h = F.col("h")
    assert one(spark, F.array(U.domain_class(h), U.organization(h), U.organization_domain(h), U.subdomain(h)), h="www.bbc.co.uk") == ["co.uk", "bbc", "bbc.co.uk", "www"]


def test_parameters_last_wins(spark):
    assert one(spark, U.parameters(F.col("u")), u="http://h/?a=1&b=2&a=3&c") == {"a": "3", "b": "2", "c": ""}


def test_decoded(spark):
    assert one(spark, U.decoded(F.col("u")), u="a+b%20c?d+e%41") == "a+b c?d eA"
    assert one(spark, U.decoded(F.col("u")), u="bad%zz") == "bad%zz"


@pytest.mark.parametrize("given,want", [("550px", 550), (" 7", 7), ("auto", 0), ("%5", None), ("", None)])
def test_leading_int(spark, given, want):
    assert one(spark, T.leading_int(F.col("s")), s=given) == want


def test_text(spark):
    assert one(spark, T.sentences(F.col("s")), s="A b.  c d! E?f g? h") == ["A b.", "c d!", "E?f g?", "h"]
    assert one(spark, T.clean_line(F.col("s")), s="\ta  b\n") == "a b"
    assert one(spark, T.normalized_term(F.col("s")), s=" Größe,Öl ") == "groesse oel"


def test_codecs(spark):
    assert one(spark, codec.b64_cardinal(F.col("s")), s="AAAAAAAAAAAA") == 7
    assert one(spark, codec.b64_cardinal(F.col("s")), s="____________") == 2**63 - 1
    assert one(spark, codec.ring_distance(F.lit(10), F.lit(3))) == 2**63 - 1 - 10 + 3 + 1
    got = one(spark, codec.protocol_list(F.col("p")), p=["http", "https", "http", "ftp"])
    assert got == ["001-https", "003-ftp"]
    assert one(spark, codec.protocols_of(F.col("p"), F.lit(4)), p=got) == ["http", "https", "http", "ftp"]
    assert one(spark, codec.b64_decode(codec.b64_encode(F.col("s"))).cast("string"), s="any carnal pleas") == "any carnal pleas"


def test_geo(spark):
    p = geo.pack(F.lit(52.5), F.lit(13.25))
    assert abs(one(spark, geo.latitude(p)) - 52.5) < 1e-6 and abs(one(spark, geo.longitude(p)) - 13.25) < 1e-6
    assert one(spark, geo.checked(F.lit(0.0), F.lit(0.0))) is None


@pytest.mark.parametrize(
    "text,want",
    [("Donnerstag, 18. Dezember 2014 xyz", ["2014-12-18"]), ("on October 5, 2014", ["2014-10-05"]), ("1996-04-22", ["1996-04-22"]), ("22/04/96", []), ("am 4. April noch", ["2020-04-04", "2021-04-04"]), ("Karfreitag", ["2019-04-19", "2020-04-10", "2021-04-02", "2022-04-15"]), ("99.99.2014", [])],
)
def test_dates(text, want):
    assert [d.isoformat() for d in times.dates_in(text, dt.date(2020, 6, 1))] == want


@pytest.mark.parametrize("given,want", [("2014-01-01T10:20:30Z", "2014-01-01 10:20:30"), ("2014-01-01T10:20:30+0530", "2014-01-01 04:50:30"), ("2014-01-01T10:20+01:00", "2014-01-01 09:20:00"), ("2014", "2014-01-01 00:00:00"), ("2014-05", "2014-05-01 00:00:00"), ("no", None)])
def test_iso8601(spark, given, want):
    got = one(spark, F.date_format(times.iso8601(F.col("s")), "yyyy-MM-dd HH:mm:ss"), s=given)
    assert got == want


@pytest.mark.parametrize("given", ["Sun, 06 Nov 1994 08:49:37 GMT", "Sunday, 06-Nov-94 08:49:37 GMT", "Sun Nov  6 08:49:37 1994"])
def test_http_date(spark, given):
    got = one(spark, F.date_format(times.http_date(F.col("s")), "MM-dd HH:mm:ss"), s=given)
    assert got == "11-06 08:49:37"


def test_microdate(spark):
    assert one(spark, times.microdate_days(F.lit("2014-01-01").cast("timestamp"))) == 16071


@pytest.mark.parametrize("word,want", [("Robert", "R163"), ("Ashcraft", "A261"), ("Pfister", "P236"), ("Zoë", "Zoë")])
def test_soundex(spark, word, want):
    assert one(spark, phonetic.soundex(F.col("w")), w=word) == want


@pytest.mark.parametrize("word,want", [("Müller", "657"), ("Wikipedia", "3412"), ("Breschnew", "17863"), ("Meyer", "67")])
def test_cologne(word, want):
    assert phonetic.cologne(word) == want


def test_metaphones():
    assert phonetic.metaphone("Knight") == "NT"
    assert phonetic.double_metaphone("Smith") == ("SM0", "XMT")
    assert phonetic.double_metaphone("Catherine") == ("K0RN", "KTRN")
