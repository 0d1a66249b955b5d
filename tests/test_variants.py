"""Charsets that nothing declares, elements of models, media of many documents, phrases, classes of hosts, agents."""

import hashlib

import pytest
from pyspark.sql import functions as F

from pagemill.catalog.variants import QUIRKS, SPOKEN, filled
from pagemill.functions import agents, charsets, html
from pagemill.functions import text as T
from pagemill.functions import url as U
from pagemill.operators import documents, patterns
from pagemill.plans import media


@pytest.mark.parametrize("name", SPOKEN)
def test_guessed(name):
    for wrap in ("{}", "<html><body class='x'>{}</body></html>", "{} 12 plain words"):
        content = wrap.format(SPOKEN[name]).encode(name)
        assert charsets.text_of(content, "text/html") == wrap.format(SPOKEN[name])
        assert charsets.text_of(content, f"text/html; charset={name}") == wrap.format(SPOKEN[name])


@pytest.mark.parametrize("text,name", [("plain words", "utf-16-le"), ("plain words", "utf-16-be"), ("吾輩は猫である。", "iso2022_jp"), ("Übung für größere Häuser — “so”", "cp1252"), ("où l’être naît à l’été", "cp1252"), ("el niño y la canción", "cp1252"), ("É È ÊTRE ÉTÉ", "cp1252"), ("naïve © 2024 ½", "cp1252")])
def test_guessed_plainly(text, name):
    assert charsets.text_of(text.encode(name), None) == text


def test_guessed_damaged():
    assert charsets.guessed(b"") == "utf-8" and charsets.guessed(b"plain") == "utf-8"
    assert charsets.guessed("größe für alle".encode() + b" \xff") == "utf-8"  # a broken place in UTF-8
    assert charsets.guessed(b"\xe9") == "cp1252"
    assert charsets.guessed(bytes(range(256))) in [n for n, _ in charsets.SINGLE]
    long = ("Мороз и солнце; день чудесный! " * 40_000).encode("koi8_r")
    assert charsets.guessed(long) == "koi8_r"


@pytest.mark.parametrize(
    "text", ["vi élem vi élem oi étre Éré. La aièè ait", "LA!! ÈOUC ÉAUXÉ!! ÉÈÇ!! LEÉÇQUE IERÈ!! ÊIER", "ENU SCHÄIE!! ÄSCH", "Äau Äau au Äau", "De Ber enê ieren and", "Pfää Pfää und Pfää", "Of er thedtion èê esou atlyre", "Und Und üß Und üß", "Ouelle ê ê Ouelle êê", "Re chellement éç ééê, èêoi reoi.", "thoninst Ñí oningat", "ENÄÜ!! GEÄLICH ÖÖÄ!!"]
)
def test_guessed_invented(text):
    """Words that no language has: letters beyond ASCII among plain ones are of the usual set."""
    assert charsets.text_of(text.encode("cp1252"), None) == text


@pytest.mark.parametrize(
    "text", ["elleéch. en " + "Éç " * 14, "ierç, la èrele é, ÈONÊ!! éoieau " + "êtioneux " * 50, "cióndo un cojación así, ó de. " + "óíñ " * 34, "est anqueeau ÉÈÈÈ!! EUXON!! est outionêeau", "de. elleellech ouê et è ç", "Lereè " + "éç " * 60 + "une"]
)
def test_guessed_repeated(text):
    """A word that fills the text, four letters beyond ASCII in a row among plain ones, and letters that stand alone do not make another set."""
    assert charsets.text_of(text.encode("cp1252"), None) == text
    assert charsets.text_of(("Мороз и солнце " + "день " * 60).encode("cp1251"), None) == "Мороз и солнце " + "день " * 60


def test_guesses_of_texts_that_end_with_a_line(spark, tmp_path):
    """A last line separator is no letter of the Latin set."""
    from pagemill.catalog import variants

    texts = [(14, "über\u2028"), (15, "so\u0085"), (30, "naïve\n"), (31, None)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["body"] for r in variants.charset_guesses(spark, str(tmp_path)).collect()}
    assert got == {k: t and hashlib.md5(t.encode()).hexdigest() for k, t in texts}


@pytest.mark.parametrize("text,name", [("Да", "cp1251"), ("нет 3D", "koi8_r"), ("page of правда and more words", "cp1251"), ("一人", "big5"), ("Cześć, mały świat", "cp1250"), ("ή όχι", "cp1253")])
def test_guessed_short(text, name):
    assert charsets.text_of(text.encode(name), None) == text


def test_elements_and_models(spark):
    page = '<title>a</title><base href="http://b.org/"><frame src="f"><a href="x"></a><!-- two\nlines --><body class="c"><div id="d"><script>one();</script></div>text &amp; more'
    pages = spark.createDataFrame([(1, page, "http://a.org/"), (2, None, "http://n.org/"), (3, "\x01<p>x</p>", "http://c.org/"), (4, "<p>y</p>", None), (5, "", None)], "id int, html string, url string")
    got = sorted((r["id"], r["element"], r["value"]) for r in patterns.page_elements(pages, "id", "html", "url").collect())
    assert got == sorted(
        [(1, "url", "http://a.org/"), (1, "text", "a"), (1, "title", "a"), (1, "framepath", "http://b.org/f"), (1, "apath", "x"), (1, "comment", " two lines "), (1, "bodyclass", "c"), (1, "scriptcode", "one();"), (1, "divid", "d"), (1, "text", "text & more")]
        + [(2, "url", "http://n.org/"), (3, "url", "http://c.org/"), (4, "text", "y")]
    )
    scores = spark.createDataFrame([(1, "m", "b", 2), (1, "m", "a", 2), (1, "m", "c", 5), (2, "other", "z", 1)], "id int, model string, subject string, n long")
    rows = {r["id"]: r for r in patterns.with_models(pages.select("id"), "id", scores, ["m"]).collect()}
    assert (rows[1]["ext_m_txt"], rows[1]["ext_m_val"]) == (["c", "a", "b"], [5, 2, 2]) and rows[2]["ext_m_txt"] is None and len(rows) == 5
    assert patterns.with_models(pages.select("id"), "id", scores, []).columns == ["id"]
    with pytest.raises(ValueError):
        patterns.with_models(pages, "id", scores, ["m", "m"])


def test_media(spark):
    pages = [
        (2, "http://a.org/two", '<title>T</title><img src="/i.png" alt="shown"><a href="/i.png">linked</a><a href="/s.mp3"></a>'),
        (1, "http://a.org/one", '<h2>head</h2><a href="/s.mp3">first</a><a href="/page" rel="nofollow">p</a><meta http-equiv="refresh" content="0; url=http://r.org/">'),
        (None, None, '<a href="http://a.org/s.mp3">never</a>'), (3, "http://a.org/none", None),
    ]
    docs = html.with_html(spark.createDataFrame(pages, "n int, url string, html string"))
    got = {(r["kind"], r["url"]): (r["description"], r["mentions"]) for r in media.media_links(docs, "n").collect()}
    assert got == {("image", "http://a.org/i.png"): ("T  - linked", 2), ("audio", "http://a.org/s.mp3"): ("T  - http a org two", 3)}
    links = {r["url"]: (r["text"], r["mentions"]) for r in media.hyperlinks(docs, "n", with_nofollow=False).collect()}
    assert links == {"http://a.org/i.png": ("linked", 1), "http://a.org/s.mp3": ("", 3), "http://r.org/": ("refresh", 1)}
    assert "http://a.org/page" in {r["url"] for r in media.hyperlinks(docs, "n").collect()}
    assert media.media_links(docs.where("false"), "n").count() == 0


def test_latest_among_many(spark):
    docs = spark.range(4000).select(F.col("id").alias("n"), F.concat(F.lit("http://a.org/"), "id").alias("url"), F.concat(F.lit('<a href="http://a.org/x.zip">t'), "id", F.lit("</a>")).alias("html"))
    (row,) = media.media_links(html.with_html(docs.repartition(8)), "n").collect()
    assert (row["mentions"], row["description"].endswith("- t3999")) == (4000, True)


def test_phrases(spark):
    df = spark.createDataFrame([(2, ["a", "b", "a"]), (1, ["b", None]), (3, []), (4, None)], "d int, p array<string>")
    got = {r["phrase"]: tuple(r)[1:] for r in documents.phrases(df, "d", F.col("p")).collect()}
    assert got == {"a": (2, 1, 2, 0), "b": (2, 2, 1, 0), None: (1, 1, 1, 1)}


def test_encoded(spark):
    df = spark.createDataFrame([(1, 'a<b & "ü" {x}'), (2, None), (3, ""), (4, "plain"), (5, "😀 é")], "id int, s string")
    got = [r[0] for r in df.orderBy("id").select(T.encoded(F.col("s"), html.ENTITIES)).collect()]
    assert got == ["a&lt;b &amp; &quot;&uuml;&quot; &#123;x&#125;", None, "", "plain", "😀 &eacute;"]
    assert df.where("id = 1").select(T.encoded(F.col("s"), html.ENTITIES, with_ampersand=False)).first()[0].startswith("a&lt;b & &quot;")
    assert all(html.decode(g) == s for g, s in zip(got, ['a<b & "ü" {x}', None, "", "plain", "😀 é"]) if g)


def test_host_classes(spark):
    df = spark.createDataFrame([("a.de", 1), (None, 2), ("", 3), ("localhost", 4), ("10.0.0.1", 5), ("x.new", 6), ("b.DE", 7)], "h string, id int")
    classes = spark.createDataFrame([("DE", 3), ("de", 0), (None, 1)], "tld string, class int")
    got = {r["id"]: r["c"] for r in U.domain_classes(df, "h", classes, "c").collect()}
    assert got == {1: 0, 2: 7, 3: 7, 4: 7, 5: 7, 6: 6, 7: 0}
    assert U.domain_classes(df, "h", classes.where("false"), "c").where("c = 6").count() == 3


def test_agents(spark):
    df = spark.createDataFrame([("x (a; b/c) d", "1.5/3", "7"), (None, None, None), ("", "x", "1e3")], "a string, v string, l string")
    rows = df.select(agents.agent_location(F.col("a")).alias("a"), agents.peer_version(F.col("v")).alias("v"), agents.serves_records(F.col("v")).alias("s"), agents.minutes_unseen(F.col("l")).alias("l"), agents.seen_at(F.lit("2024-01-01 01:00:00").cast("timestamp"), F.col("l")).cast("string").alias("t")).collect()
    assert [tuple(r) for r in rows] == [("b/c", 1.5, True, 7, "2024-01-01 00:53:00"), (None, 0.0, False, agents.NEVER, rows[1]["t"]), ("", 0.0, False, agents.NEVER, rows[1]["t"])]


def test_pages_of_a_short_table_are_dealt_out(spark, tmp_path):
    """Customers in one file of one piece: their pages are made and parsed by several tasks of bounded size, none of them lost."""
    spark.range(1, 12_001).withColumnRenamed("id", "c_custkey").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    sizes = [r["n"] for r in filled(spark, tmp_path, QUIRKS).groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 3 and sum(sizes) == 12_000 and max(sizes) < 5000


def test_encoded_goes_through_no_single_characters(spark):
    """A text is not split into its characters, each looked up among all entities, but gone through for those it has."""
    text = ("plain words & <more> " + "".join(c for c in html.ENTITIES.values() if c not in "' \u00a0")) * 1000
    done = spark.createDataFrame([(text,)], "s string").select(T.encoded(F.col("s"), html.ENTITIES).alias("e"))
    assert "split(" not in done._jdf.queryExecution().optimizedPlan().toString()
    assert len(done.first()["e"]) > 3 * len(text)
