"""URL, markup and index queries over pages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pagemill.functions import html
from pagemill.functions import url as U
from pagemill.operators.joins import matching_rules
from pagemill.plans import index as plan
from pagemill.plans import sinks
from pagemill.queries import load_time, query, table

HOST = r"lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1))"
NORM = f"lower(regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*)://', 1)) || '://' || {HOST} || regexp_replace(regexp_replace(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*', ''), '#.*$', '')"
PATH = r"regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
QUERY = r"regexp_extract(url, '\?([^#]*)', 1)"


def pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


def records(spark, sf_dir, **more):
    return plan.index_record(html.with_html(pages(spark, sf_dir)), load_time(), **more)


@query(f"SELECT page_id, {NORM} AS url_s, lower(split_part(url, '://', 1)) AS url_protocol_s, length({NORM})::BIGINT AS url_chars_i FROM pages")
def url_core(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", U.normal_form(F.col("url")).alias("url_s"), U.scheme(F.col("url")).alias("url_protocol_s"), F.length(U.normal_form(F.col("url"))).cast("long").alias("url_chars_i"))


@query(f"""SELECT page_id, {HOST} AS host_s, split_part({HOST}, '.', -1) AS host_dnc_s, split_part({HOST}, '.', -2) AS host_organization_s,
 split_part({HOST}, '.', -2) || '.' || split_part({HOST}, '.', -1) AS host_organizationdnc_s, regexp_extract({HOST}, '^(.*)\\.[^.]*\\.[^.]*$', 1) AS host_subdomain_s FROM pages""")
def url_host_parts(spark, sf_dir):
    h = U.host(F.col("url"))
    return pages(spark, sf_dir).select("page_id", h.alias("host_s"), U.domain_class(h).alias("host_dnc_s"), U.organization(h).alias("host_organization_s"), U.organization_domain(h).alias("host_organizationdnc_s"), U.subdomain(h).alias("host_subdomain_s"))


@query(f"""SELECT page_id, len(list_filter(string_split(regexp_extract({PATH}, '^(.*)/[^/]*$', 1), '/'), lambda s: s <> ''))::BIGINT AS url_paths_count_i,
 array_to_string(list_filter(string_split(regexp_extract({PATH}, '^(.*)/[^/]*$', 1), '/'), lambda s: s <> ''), '|') AS url_paths FROM pages""")
def url_paths(spark, sf_dir):
    s = U.path_segments(F.col("url"))
    return pages(spark, sf_dir).select("page_id", F.size(s).cast("long").alias("url_paths_count_i"), F.array_join(s, "|").alias("url_paths"))


@query(f"""SELECT page_id, len(list_filter(string_split({QUERY}, '&'), lambda s: s <> ''))::BIGINT AS url_parameter_i,
 array_to_string(list_transform(list_filter(string_split({QUERY}, '&'), lambda s: s <> ''), lambda s: regexp_extract(s, '^([^=]*)', 1)), '|') AS keys,
 array_to_string(list_transform(list_filter(string_split({QUERY}, '&'), lambda s: s <> ''), lambda s: regexp_extract(s, '^[^=]*=(.*)$', 1)), '|') AS vals FROM pages""")
def url_params(spark, sf_dir):
    p = U.parameters(F.col("url"))
    return pages(spark, sf_dir).select("page_id", F.size(p).cast("long").alias("url_parameter_i"), F.array_join(F.map_keys(p), "|").alias("keys"), F.array_join(F.map_values(p), "|").alias("vals"))


@query(f"""SELECT page_id, regexp_replace(regexp_extract({PATH}, '([^/]*)$', 1), '\\.[^.]*$', '') AS stem, lower(regexp_extract(regexp_extract({PATH}, '([^/]*)$', 1), '\\.([^.]*)$', 1)) AS ext FROM pages""")
def url_file(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", U.file_stem(F.col("url")).alias("stem"), U.file_extension(F.col("url")).alias("ext"))


@query(f"SELECT page_id, url LIKE 'http://%' AS http_unique_b, {HOST} LIKE 'www.%' AS www_unique_b, NOT contains({HOST}, '.') AS local_b, CASE WHEN url LIKE 'https%' THEN 443 ELSE 80 END::BIGINT AS port FROM pages")
def url_flags(spark, sf_dir):
    h = U.host(F.col("url"))
    return pages(spark, sf_dir).select("page_id", (U.scheme(F.col("url")) == "http").alias("http_unique_b"), h.startswith("www.").alias("www_unique_b"), U.is_local(h).alias("local_b"), U.port(F.col("url")).cast("long").alias("port"))


@query(r"SELECT page_id, array_to_string(list_filter(string_split_regex(regexp_replace(url, '(\p{Ll})(\p{Lu})', '\1 \2', 'g'), '[^\p{L}\p{N}]+'), lambda s: s <> ''), ' ') AS tokens FROM pages")
def url_tokens(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", F.array_join(U.tokens(F.col("url")), " ").alias("tokens"))


@query(f"""WITH p AS (SELECT page_id, lower(split_part(url, '://', 1)) || '://' || {HOST} AS base, list_filter(string_split(regexp_extract({PATH}, '^(.*)/[^/]*$', 1), '/'), lambda s: s <> '') AS parts FROM pages)
 SELECT page_id, CASE WHEN i = 0 THEN base || '/' ELSE base || '/' || array_to_string(parts[1:i], '/') || '/' END AS sub FROM p, unnest(range(0, len(parts) + 1)) AS t(i)""")
def url_sub_paths(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", F.explode(U.sub_urls(F.col("url"))).alias("sub"))


@query(r"SELECT page_id, regexp_replace(regexp_replace(url, '^http://', 'https://'), '[?].*$', '') AS rewritten FROM pages")
def url_rewrite(spark, sf_dir):
    rules = [(r"http://(.*)", "https://$1"), (r"([^?]*)[?].*", "$1")]
    return pages(spark, sf_dir).select("page_id", U.rewritten(F.col("url"), rules).alias("rewritten"))


@query("SELECT page_id, 'http://b.org/' || page_id AS inner_url FROM pages")
def url_embedded(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", U.embedded_url(F.concat(F.lit("http://a.example.org/?u=http://b.org/"), "page_id")).alias("inner_url"))


@query("SELECT md5(url_s) AS id, '{\"index\":{\"_index\":\"web\",\"_id\":\"' || md5(url_s) || '\"}}' || chr(10) || '{\"url_s\":\"' || url_s || '\"}' AS line FROM (SELECT " + NORM + " AS url_s FROM pages)")
def page_md5_bulk_lines(spark, sf_dir):
    p = pages(spark, sf_dir).select(F.md5(U.normal_form(F.col("url"))).alias("id"), U.normal_form(F.col("url")).alias("url_s"))
    return plan.bulk_lines(p).select(F.get_json_object(F.split_part("value", F.lit("\n"), F.lit(1)), "$.index._id").alias("id"), F.col("value").alias("line"))


RULES = [("english", r".*/en/.*"), ("german", r".*/de/.*"), ("secure", r"https://.*"), ("mobile", r"https?://m\..*")]


@query("SELECT page_id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_full_match(url, '{p}') THEN '{n}' END" for n, p in RULES) + "], lambda x: x IS NOT NULL), ',') AS collections FROM pages")
def collections_match(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", F.array_join(matching_rules(F.col("url"), RULES), ",").alias("collections"))


@query(f"WITH p AS (SELECT page_id, {NORM} AS url_s FROM pages) SELECT page_id, regexp_replace(url_s, '[?].*$', '') = url_s AS canonical, CASE WHEN regexp_replace(url_s, '[?].*$', '') = url_s THEN 'parsed' ELSE 'noncanonical' END AS status FROM p")
def canonical_split(spark, sf_dir):
    p = pages(spark, sf_dir).select("page_id", U.normal_form(F.col("url")).alias("url_s")).withColumn("canonical_s", F.regexp_replace("url_s", "[?].*$", ""))
    return p.select("page_id", plan.is_canonical(p).alias("canonical"), F.when(plan.is_canonical(p), "parsed").otherwise("noncanonical").alias("status"))


CLEAN = r"trim(regexp_replace(replace(replace(replace(replace(replace(replace({0}, '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&'), '\s+', ' ', 'g'))"


@query("SELECT page_id, " + CLEAN.format("regexp_extract(html, '<title>([^<]*)</title>', 1)") + " AS title, " + CLEAN.format("regexp_extract(html, '<h1>([^<]*)</h1>', 1)") + " AS h1 FROM pages")
def html_title_h1(spark, sf_dir):
    return records(spark, sf_dir).select("page_id", F.try_element_at("title", F.lit(1)).alias("title"), F.try_element_at("h1_txt", F.lit(1)).alias("h1"))


@query(r"""SELECT page_id, len(regexp_extract_all(html, '<a href="([^"]*)"', 1))::BIGINT AS anchors, array_to_string(list_transform(regexp_extract_all(html, '<a href="([^"]*)"', 1), lambda x: regexp_extract(url, '^([a-z]+://[^/]*)', 1) || x), ' ') AS targets FROM pages""")
def html_links(spark, sf_dir):
    p = html.with_html(pages(spark, sf_dir))
    return p.select("page_id", F.size("page.anchors").cast("long").alias("anchors"), F.array_join(F.transform("page.anchors", lambda a: a["url"]), " ").alias("targets"))


@query(r"""WITH p AS (SELECT page_id, len(list_distinct(regexp_extract_all(html, '<a href="([^"]*)"', 1)))::BIGINT AS n, len(regexp_extract_all(html, '<a href="([^"]*)"', 1))::BIGINT AS every FROM pages)
 SELECT page_id, n AS linkscount_i, 0::BIGINT AS linksnofollowcount_i, n AS inboundlinkscount_i, 0::BIGINT AS inboundlinksnofollowcount_i, 0::BIGINT AS outboundlinkscount_i, 0::BIGINT AS outboundlinksnofollowcount_i, every AS listed_in, 0::BIGINT AS listed_out FROM p""")
def link_counts(spark, sf_dir):
    """The links of these pages are all relative, so none leads out and none is marked; links are counted once and listed as often as they stand."""
    r = records(spark, sf_dir).withColumns({"listed_in": F.size("inboundlinks_sxt"), "listed_out": F.size("outboundlinks_sxt")})
    counts = ("linkscount_i", "linksnofollowcount_i", "inboundlinkscount_i", "inboundlinksnofollowcount_i", "outboundlinkscount_i", "outboundlinksnofollowcount_i", "listed_in", "listed_out")
    return r.select("page_id", *(F.col(c).cast("long").alias(c) for c in counts))


EDGES = (
    f"SELECT source, regexp_extract(source, '^([a-z]+://[^/]*)', 1) || target AS target, 'inbound' AS kind, {CLEAN.format('text')} AS text FROM (SELECT {NORM} AS source, "
    """unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS target, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) AS text FROM pages)"""
)


@query(EDGES)
def graph_edges(spark, sf_dir):
    return plan.edges(records(spark, sf_dir))


@query()
def graph_record(spark, sf_dir):
    return plan.graph_record(records(spark, sf_dir), "page_id")


@query()
def html_text_wordcount(spark, sf_dir):
    return records(spark, sf_dir).select("page_id", "text_t", "wordcount_i")


@query()
def html_bold(spark, sf_dir):
    return records(spark, sf_dir).select("page_id", "boldcount_i", "bold_txt", "bold_val")


@query()
def html_index_wide(spark, sf_dir):
    return records(spark, sf_dir, collections=RULES, run_date=dt.date(2020, 6, 1))


@query(f"""SELECT md5(url) AS id, url, 'parsed' AS status, {CLEAN.format("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS comment, TIMESTAMP '2024-01-01 00:00:00' AS updated FROM (SELECT {NORM} AS url, html FROM pages)""")
def crawler_status(spark, sf_dir):
    return plan.crawler_status(records(spark, sf_dir), load_time())


@query()
def index_bulk_lines(spark, sf_dir):
    return plan.bulk_lines(records(spark, sf_dir).drop("page_id"))


@query("SELECT '<item><title>' || " + "regexp_replace(source, '&', '&amp;', 'g')" + " || '</title><link>http://d/' || doc_id || '</link><guid>' || doc_id || '</guid></item>' AS value FROM documents")
def rss_items(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("title"), F.concat(F.lit("http://d/"), "doc_id").alias("url"), F.col("doc_id").cast("string").alias("id"))
    return sinks.rss_items(d)


@query("SELECT page_id, CASE WHEN url LIKE 'http://%' THEN 'c1' END AS crawl_id_s, CASE WHEN url LIKE 'http://%' THEN 'u7' END AS user_id_s FROM pages")
def enriched_records(spark, sf_dir):
    crawls = spark.createDataFrame([("http", "c1", "u7"), ("https", "", "")], "job string, crawl_id string, user_id string")
    return plan.enriched(pages(spark, sf_dir).select("page_id", U.scheme(F.col("url")).alias("job")), crawls, "job").select("page_id", "crawl_id_s", "user_id_s")
