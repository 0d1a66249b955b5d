"""Columns of the index record, group by group, over pages made from a table so that SQL can say what each must hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.functions import html
from pagemill.operators import lookup
from pagemill.plans import index as plan
from pagemill.queries import load_time, query, table
from pagemill.sources import warc

#: {n} is the name of a nation, {k} its number.
PAGE = (
    '<html lang="en"><head><title>T {n}</title><meta name="author" content="{n}"><meta name="description" content="about {n}"><meta name="keywords" content="x{k},y"><meta name="generator" content="gen {k}">'
    '<meta property="og:title" content="og {n}"><meta property="og:type" content="article"><meta property="og:url" content="http://o/{k}"><meta property="og:image" content="http://o/{k}.png"><meta name="robots" content="noindex, nofollow">'
    '<link rel="canonical" href="/n/{k}"><link rel="stylesheet" type="text/css" href="/s{k}.css"><link rel="alternate" hreflang="de" href="/de/{k}"><link rel="next" href="/next/{k}"><link rel="publisher" href="http://p.org/{k}">'
    '<script src="/j{k}.js"></script></head><body><h1>A {n}</h1><h2>B1</h2><h2>B2 {k}</h2><h4>D</h4><p><b>bold {k}</b> <b>once</b> <b>bold {k}</b> <i>it {k}</i> <u>un</u></p>'
    '<ul><li>l1</li><li>l {k}</li></ul><dl><dt>t</dt><dd>d {k}</dd></dl><article>art {k}</article><img src="/i{k}.png" alt="pic {k}" width="10px" height="20"><iframe src="/f{k}.html"></iframe>'
    '<a href="/in/{k}">in {k}</a> <a href="http://other.org/{k}" rel="nofollow">out {k}</a> <a href="/m{k}.mp3">song</a><div itemtype="http://schema.org/Breadcrumb">x</div>'
    '<span itemprop="latitude" content="50.5"></span><span itemprop="longitude" content="8.{k}"></span></body></html>'
)


def made(spark, sf_dir):
    n, k = F.col("n_name"), F.col("n_nationkey").cast("string")
    page = F.replace(F.replace(F.lit(PAGE), F.lit("{n}"), n), F.lit("{k}"), k)
    return table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("http://www.h.org/n/"), k).alias("url"), page.alias("html"))


def record(spark, sf_dir):
    return plan.index_record(html.with_html(made(spark, sf_dir)), load_time())


def flat(column: str):
    return F.array_join(F.transform(column, lambda x: x.cast("string")), "|").alias(column)


BASE = "FROM nation"
OWN = "'http://www.h.org/'"


@query(f"""SELECT n_nationkey, 'T ' || n_name AS title, 1::BIGINT AS title_count_i, (2 + length(n_name))::VARCHAR AS title_chars_val, (1 + len(string_split(n_name, ' ')))::VARCHAR AS title_words_val, 'about ' || n_name AS description_txt, 1::BIGINT AS description_count_i,
 (6 + length(n_name))::VARCHAR AS description_chars_val, (1 + len(string_split(n_name, ' ')))::VARCHAR AS description_words_val, n_name AS author, n_name AS author_sxt, 'x' || n_nationkey || ' y' AS keywords, 'og ' || n_name AS opengraph_title_t, 'article' AS opengraph_type_s,
 'http://o/' || n_nationkey AS opengraph_url_s, 'http://o/' || n_nationkey || '.png' AS opengraph_image_s, 'gen ' || n_nationkey AS metagenerator_t, 'en' AS language_s {BASE}""")
def record_meta(spark, sf_dir):
    r = record(spark, sf_dir)
    return r.select(
        "n_nationkey", flat("title"), F.col("title_count_i").cast("long").alias("title_count_i"), flat("title_chars_val"), flat("title_words_val"), flat("description_txt"), F.col("description_count_i").cast("long").alias("description_count_i"),
        flat("description_chars_val"), flat("description_words_val"), "author", flat("author_sxt"), "keywords", "opengraph_title_t", "opengraph_type_s", "opengraph_url_s", "opengraph_image_s", "metagenerator_t", "language_s",
    )


@query(f"""SELECT n_nationkey, 'A ' || n_name AS h1_txt, 1::BIGINT AS h1_i, 'B1|B2 ' || n_nationkey AS h2_txt, 2::BIGINT AS h2_i, '' AS h3_txt, 0::BIGINT AS h3_i, 'D' AS h4_txt, 1::BIGINT AS h4_i, 0::BIGINT AS h5_i, 0::BIGINT AS h6_i, 11::BIGINT AS htags_i, 1::BIGINT AS schema_org_breadcrumb_i {BASE}""")
def record_headings(spark, sf_dir):
    r = record(spark, sf_dir)
    return r.select("n_nationkey", *(flat(f"h{i}_txt") for i in range(1, 5)), *(F.col(c).cast("long").alias(c) for c in ("h1_i", "h2_i", "h3_i", "h4_i", "h5_i", "h6_i", "htags_i", "schema_org_breadcrumb_i")))


@query(f"""SELECT n_nationkey, 2::BIGINT AS boldcount_i, 'bold ' || n_nationkey || '|once' AS bold_txt, '2|1' AS bold_val, 1::BIGINT AS italiccount_i, 'it ' || n_nationkey AS italic_txt, '1' AS italic_val, 1::BIGINT AS underlinecount_i, 'un' AS underline_txt, '1' AS underline_val,
 2::BIGINT AS licount_i, 'l1|l ' || n_nationkey AS li_txt, 1::BIGINT AS dtcount_i, 't' AS dt_txt, 1::BIGINT AS ddcount_i, 'd ' || n_nationkey AS dd_txt, 1::BIGINT AS articlecount_i, 'art ' || n_nationkey AS article_txt {BASE}""")
def record_styles(spark, sf_dir):
    r = record(spark, sf_dir)
    counts = ("boldcount_i", "italiccount_i", "underlinecount_i", "licount_i", "dtcount_i", "ddcount_i", "articlecount_i")
    return r.select("n_nationkey", *(F.col(c).cast("long").alias(c) for c in counts), *(flat(c) for c in ("bold_txt", "bold_val", "italic_txt", "italic_val", "underline_txt", "underline_val", "li_txt", "dt_txt", "dd_txt", "article_txt")))


@query(f"""SELECT n_nationkey, 1::BIGINT AS imagescount_i, {OWN} || 'i' || n_nationkey || '.png' AS images_sxt, 'pic ' || n_nationkey AS images_alt_sxt, '20' AS images_height_val, '10' AS images_width_val, '200' AS images_pixel_val, 1::BIGINT AS images_withalt_i,
 'http www h org i' || n_nationkey || ' png pic ' || n_nationkey AS images_text_t, 1::BIGINT AS csscount_i, '<link rel="stylesheet" type="text/css" href="' || {OWN} || 's' || n_nationkey || '.css" />' AS css_tag_sxt, {OWN} || 's' || n_nationkey || '.css' AS css_url_sxt,
 1::BIGINT AS scriptscount_i, {OWN} || 'j' || n_nationkey || '.js' AS scripts_sxt, 0::BIGINT AS framesscount_i, 1::BIGINT AS iframesscount_i, {OWN} || 'f' || n_nationkey || '.html' AS iframes_sxt {BASE}""")
def record_embedded(spark, sf_dir):
    r = record(spark, sf_dir)
    counts = ("imagescount_i", "images_withalt_i", "csscount_i", "scriptscount_i", "framesscount_i", "iframesscount_i")
    return r.select("n_nationkey", *(F.col(c).cast("long").alias(c) for c in counts), "images_text_t", *(flat(c) for c in ("images_sxt", "images_alt_sxt", "images_height_val", "images_width_val", "images_pixel_val", "css_tag_sxt", "css_url_sxt", "scripts_sxt", "iframes_sxt")))


@query(f"""SELECT n_nationkey, {OWN} || 'n/' || n_nationkey AS canonical_s, true AS canonical_equal_sku_b, false AS flash_b, 'de' AS hreflang_cc_sxt, {OWN} || 'de/' || n_nationkey AS hreflang_url_sxt, 'next' AS navigation_type_sxt, {OWN} || 'next/' || n_nationkey AS navigation_url_sxt,
 'http://p.org/' || n_nationkey AS publisher_url_s, 3::BIGINT AS linkscount_i, 3::BIGINT AS linksnofollowcount_i, 2::BIGINT AS inboundlinkscount_i, 2::BIGINT AS inboundlinksnofollowcount_i, 1::BIGINT AS outboundlinkscount_i, 1::BIGINT AS outboundlinksnofollowcount_i,
 {OWN} || 'in/' || n_nationkey AS inboundlinks_sxt, 'in ' || n_nationkey AS inboundlinks_anchortext_txt, 'http://other.org/' || n_nationkey AS outboundlinks_sxt, 'out ' || n_nationkey AS outboundlinks_anchortext_txt, 1::BIGINT AS audiolinkscount_i, 0::BIGINT AS videolinkscount_i, 0::BIGINT AS applinkscount_i {BASE}""")
def record_links(spark, sf_dir):
    r = record(spark, sf_dir)
    counts = [f"{k}linkscount_i" for k in ("", "inbound", "outbound", "audio", "video", "app")] + [f"{k}linksnofollowcount_i" for k in ("", "inbound", "outbound")]
    lists = ("hreflang_cc_sxt", "hreflang_url_sxt", "navigation_type_sxt", "navigation_url_sxt", "inboundlinks_sxt", "inboundlinks_anchortext_txt", "outboundlinks_sxt", "outboundlinks_anchortext_txt")
    return r.select("n_nationkey", "canonical_s", "canonical_equal_sku_b", "flash_b", "publisher_url_s", *(F.col(c).cast("long").alias(c) for c in counts), *(flat(c) for c in lists))


@query(f"""SELECT n_nationkey, 'T ' || n_name || '. A ' || n_name || '. B1. B2 ' || n_nationkey || '. D. bold ' || n_nationkey || '. once. bold ' || n_nationkey || '. it ' || n_nationkey || '. un. l1. l ' || n_nationkey || '. t. d ' || n_nationkey || '. art ' || n_nationkey || '. in ' || n_nationkey || ' out ' || n_nationkey || ' song x.' AS text_t,
 (26 + 2 * len(string_split(n_name, ' ')) + 2)::BIGINT AS wordcount_i, '50.5,' || ('8.' || n_nationkey)::DOUBLE AS coordinate_p, 50.5::DOUBLE AS coordinate_lat_d, ('8.' || n_nationkey)::DOUBLE AS coordinate_lon_d, 'text/html' AS content_type, 0::BIGINT AS crawldepth_i, 'UTF-8' AS charset_s, 200::BIGINT AS httpstatus_i, 0::BIGINT AS responsetime_i, length({OWN} || 'n/' || n_nationkey)::BIGINT AS size_i {BASE}""")
def record_text(spark, sf_dir):
    r = record(spark, sf_dir)
    return r.select("n_nationkey", "text_t", "coordinate_p", "coordinate_lat_d", "coordinate_lon_d", flat("content_type"), "charset_s", *(F.col(c).cast("long").alias(c) for c in ("wordcount_i", "crawldepth_i", "httpstatus_i", "responsetime_i", "size_i")))


@query(f"SELECT {OWN} || 'n/' || n_nationkey AS source, {OWN} || 'in/' || n_nationkey AS target, 'inbound' AS kind, 'in ' || n_nationkey AS text {BASE} UNION ALL SELECT {OWN} || 'n/' || n_nationkey, 'http://other.org/' || n_nationkey, 'outbound', 'out ' || n_nationkey {BASE}")
def record_edges(spark, sf_dir):
    return plan.edges(record(spark, sf_dir))


@query(r"SELECT page_id, array_to_string(regexp_extract_all(html, '<li><a href=\"[^\"]*\">([^<]*)</a></li>', 1), '|') AS li_txt, len(regexp_extract_all(html, '<li>'))::BIGINT AS licount_i, regexp_extract(html, '<html lang=\"([a-z]*)\"', 1) AS language_s FROM pages")
def html_lists(spark, sf_dir):
    r = plan.index_record(html.with_html(table(spark, sf_dir, "pages")), load_time())
    return r.select("page_id", flat("li_txt"), F.col("licount_i").cast("long").alias("licount_i"), "language_s")


@query("SELECT n_nationkey, 'grüße ' || n_name AS body FROM nation")
def charset_choice(spark, sf_dir):
    """Pages as bytes: in windows-1252 by the header, by the markup or by neither, and in UTF-8."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("grüße "), "n_name").alias("body"), (F.col("n_nationkey") % 4).alias("way"))
    text = F.when(F.col("way") == 1, F.concat(F.lit('<meta charset="latin1">'), "body")).otherwise(F.col("body"))
    payload = F.when(F.col("way") == 3, F.encode(text, "UTF-8")).otherwise(F.encode(text, "ISO-8859-1"))
    kind = F.when(F.col("way") == 0, "text/html; charset=iso-8859-1").otherwise("text/html")
    out = n.select("n_nationkey", warc.decoded(payload, kind).alias("t"))
    return out.select("n_nationkey", F.regexp_replace("t", "^<[^>]*>", "").alias("body"))


WORDS = "trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(lower(text), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss'), ',', ' '), '[.!?;:()]', ' ', 'g'), ' +', ' ', 'g'))"


@query(f"""WITH d AS (SELECT doc_id, ' ' || {WORDS} || ' ' AS w FROM documents), v AS (SELECT * FROM (VALUES ('article', 'article'), ('article', 'the'), ('article', 'der'), ('article', 'le'), ('long', 'of the and in of the'), ('long', 'long')) AS t(term, synonym))
 SELECT doc_id, 'small' AS vocabulary, array_to_string(list_sort(list(DISTINCT term)), ',') AS terms FROM d JOIN v ON contains(w, ' ' || synonym || ' ') GROUP BY doc_id""")
def tagging_long_terms(spark, sf_dir):
    """Synonyms of one and of many words."""
    lines = spark.createDataFrame([("article:the,der,le",), ("long:of the and in of the",)], "value string")
    out = lookup.facets(table(spark, sf_dir, "documents"), "doc_id", "text", lookup.vocabulary(lines, F.lit("small")))
    return out.withColumn("terms", F.array_join("terms", ","))
