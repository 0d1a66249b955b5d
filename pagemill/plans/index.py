"""The index record: one wide row for each page, and what follows from it.

Input rows have url, the struct ``page`` of pagemill.functions.html and, if there,
mime, charset, http_status, headers (map, small keys), depth and referrer. All
columns are native expressions over them. null means that a record lacks a column;
ip_s always is, as no names are looked up on the network.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.functions import times
from pagemill.functions import url as U
from pagemill.operators.joins import matching_rules
from pagemill.operators.scores import ordered_texts

# Extensions of media files.
MEDIA = {
    "image": "bmp gif ico jpeg jpg png svg tif tiff webp",
    "audio": "aac aif aiff flac m4a m4p mid mp2 mp3 oga ogg ram sid wav wma",
    "video": "3gp asf avi flv m4v mkv mov mp4 mpeg mpg ogm ogv qt rm swf webm wmv",
    "app": "apk bin bz2 deb dmg exe gz iso jar msi rar rpm sh tar tgz xz zip 7z",
}

GRAPH_COLUMNS = (
    "url_s url_protocol_s url_file_name_s url_file_ext_s host_s host_organization_s inboundlinkscount_i inboundlinksnofollowcount_i inboundlinks_sxt inboundlinks_anchortext_txt "
    "outboundlinkscount_i outboundlinksnofollowcount_i outboundlinks_sxt outboundlinks_anchortext_txt images_sxt images_alt_sxt canonical_s refresh_s "
    "iframes_sxt frames_sxt css_url_sxt scripts_sxt linkscount_i linksnofollowcount_i"
).split()


def media_class(link: Column) -> Column:
    out = F.lit(None).cast("string")
    ext = U.file_extension(link)
    for name, exts in MEDIA.items():
        out = F.when(ext.isin(*exts.split()), name).otherwise(out)
    return out


def document_type(ext: Column, mime: Column) -> Column:
    """One letter: from the extension, else from the mime type."""
    out = F.when(ext.isin("pdf", "ps"), "p").when(ext.isin("htm", "html", "shtml", "php", "asp", "jsp"), "h").when(ext.isin("txt", "csv", "md"), "t").when(ext.isin("doc", "docx", "odt", "rtf"), "w").when(ext.isin("xls", "xlsx", "ods"), "x")
    for name, letter in (("image", "i"), ("audio", "m"), ("video", "M"), ("app", "A")):
        out = out.when(ext.isin(*MEDIA[name].split()), letter)
    return out.when(mime.startswith("text/html"), "h").when(mime.startswith("text/"), "t").when(mime.startswith("image/"), "i").when(mime.startswith("audio/"), "m").when(mime.startswith("video/"), "M").when(mime == "application/pdf", "p").otherwise("u")


def valid_response(status: Column, x_robots: Column, set_cookie: Column) -> Column:
    """A struct: whether a response is complete, whether it forbids indexing, whether it sets cookies."""
    robots = F.lower(F.coalesce(x_robots, F.lit("")))
    return F.struct(status.isin(200, 203).alias("valid"), (robots.contains("noindex") | robots.contains("none")).alias("forbids"), (F.coalesce(set_cookie, F.lit("")) != "").alias("cookies"))


def words_of(s: Column) -> Column:
    return F.size(F.split(s, " "))


def array_count(a: Column) -> Column:
    return F.coalesce(F.size(a), F.lit(0))


def index_record(docs: DataFrame, load_time: Column, collections: list[tuple[str, str]] | None = None, run_date=None) -> DataFrame:
    """``load_time`` stands for the present. ``run_date`` turns on the search for dates in the text."""
    have = set(docs.columns)
    p = lambda c: F.col(f"page.{c}")
    given = lambda c, kind: F.col(c) if c in have else F.lit(None).cast(kind)
    url = U.normal_form(F.col("url"))
    host = U.host(F.col("url"))
    headers = given("headers", "map<string,string>")
    header = lambda k: F.try_element_at(headers, F.lit(k))
    meta = lambda *names: F.coalesce(*[F.when(F.try_element_at(p("metas"), F.lit(n)) != "", F.try_element_at(p("metas"), F.lit(n))) for n in names])
    mime = T.media_type(F.coalesce(given("mime", "string"), header("content-type"), F.lit("text/html")))

    base = docs.withColumns({
        "_host": host, "_url": url,
        "_titles": F.when(F.size(p("titles")) > 0, p("titles")).when(meta("title").isNotNull(), F.array(meta("title"))).otherwise(F.slice(F.concat(p("h1"), p("h2"), p("h3"), p("h4"), p("h5"), p("h6")), 1, 1)),
        "_descriptions": F.filter(F.array_distinct(F.array(meta("description"), meta("dc.description"), meta("og:description"))), lambda x: x.isNotNull()),
        "_images": F.transform(p("images"), lambda i: i["url"]),
        "_refresh": F.regexp_extract(meta("refresh"), r"(?i)url\s*=\s*['\"]?([^'\"\s]+)", 1),
        "_link_canonical": F.regexp_extract(header("link"), r"(?i)<([^>]*)>\s*;\s*rel=\"?canonical", 1),
    }).withColumns({
        "_canonical": F.coalesce(p("canonical"), F.when(F.col("_link_canonical") != "", F.col("_link_canonical"))),
        "_anchors": F.transform(F.filter(p("anchors"), lambda a: ~a["url"].startswith("mailto:")), lambda a: a.withField("url", U.normal_form(a["url"]))),
    })
    removed = F.concat(F.col("_images"), p("css"), p("scripts"), p("frames"), p("iframes"), F.filter(F.array(F.col("_canonical"), F.when(F.col("_refresh") != "", F.col("_refresh"))), lambda x: x.isNotNull()))
    base = base.withColumn("_distinct", F.array_distinct(F.filter(F.transform(F.col("_anchors"), lambda a: a["url"]), lambda u: u != F.col("_url"))))
    base = base.withColumn("_removed", removed).withColumn("_links", F.array_except("_distinct", "_removed"))
    own = F.col("_host")
    nofollow = lambda links: F.size(F.array_intersect(links, F.transform(F.filter(F.col("_anchors"), lambda a: a["rel"].contains("nofollow")), lambda a: a["url"])))
    inbound = F.filter("_links", lambda u: U.same_site(own, U.host(u)))
    outbound = F.filter("_links", lambda u: ~U.same_site(own, U.host(u)))
    hyper = F.filter("_anchors", lambda a: (a["url"] != F.col("_url")) & media_class(a["url"]).isNull())
    in_list = F.filter(hyper, lambda a: U.same_host(own, U.host(a["url"])))
    out_list = F.filter(hyper, lambda a: ~U.same_host(own, U.host(a["url"])))
    media = lambda kind: F.size(F.filter("_links", lambda u: media_class(u) == kind))
    author = F.coalesce(meta("author", "dc.creator"), meta("copyright", "dc.publisher"))
    kw = meta("keywords", "dc.description")
    modified = F.least(F.coalesce(times.http_date(header("last-modified")), times.http_date(header("date")), load_time), F.coalesce(times.epoch_or_date(meta("date", "dc.date", "last-modified"), load_time), load_time))
    is_image = mime.startswith("image/")
    first = {
        "id": F.md5("_url"), "url_s": F.col("_url"), "ip_s": F.lit(None).cast("string"), "host_s": own, "host_dnc_s": U.domain_class(own), "host_organization_s": U.organization(own), "host_organizationdnc_s": U.organization_domain(own), "host_subdomain_s": U.subdomain(own),
        "url_chars_i": F.length("_url"), "url_protocol_s": U.scheme(F.col("_url")), "url_paths_count_i": F.size(U.path_segments(F.col("_url"))), "url_paths_sxt": U.path_segments(F.col("_url")),
        "url_file_name_s": U.file_stem(F.col("_url")), "url_file_name_tokens_t": F.array_join(U.tokens(U.file_stem(F.col("_url"))), " "), "url_file_ext_s": U.file_extension(F.col("_url")),
        "url_parameter_i": F.size(U.parameters(F.col("_url"))), "url_parameter_key_sxt": F.when(F.size(U.parameters(F.col("_url"))) > 0, F.map_keys(U.parameters(F.col("_url")))), "url_parameter_value_sxt": F.when(F.size(U.parameters(F.col("_url"))) > 0, F.map_values(U.parameters(F.col("_url")))),
        "content_type": F.array(mime), "crawldepth_i": F.coalesce(given("depth", "int"), F.lit(0)), "collection_sxt": matching_rules(F.col("_url"), collections or []) if collections else F.lit(None).cast("array<string>"),
        "title": F.col("_titles"), "title_count_i": F.size("_titles"), "title_chars_val": F.transform("_titles", F.length), "title_words_val": F.transform("_titles", words_of),
        "description_txt": F.col("_descriptions"), "description_count_i": F.size("_descriptions"), "description_chars_val": F.transform("_descriptions", F.length), "description_words_val": F.transform("_descriptions", words_of),
        "author": author, "author_sxt": F.when(author.isNotNull(), F.array(author)), "last_modified": modified, "keywords": F.when(kw.isNotNull(), F.array_join(T.keywords(kw), " ")),
        "http_unique_b": U.scheme(F.col("_url")) == "http", "www_unique_b": own.startswith("www."),
    }
    heads = {}
    for k in range(1, 7):
        heads |= {f"h{k}_txt": p(f"h{k}"), f"h{k}_i": F.size(p(f"h{k}"))}
    tags = F.lit(0)
    for k in range(1, 7):
        tags = tags.bitwiseOR(F.when(F.size(p(f"h{k}")) > 0, 1 << (k - 1)).otherwise(0))
    styled = {}
    for name in ("bold", "italic", "underline"):
        ordered = ordered_texts(p(name))
        some = F.size(p(name)) > 0
        styled |= {f"{name}count_i": F.size(p(name)), f"{name}_txt": F.when(some, F.transform(ordered, lambda x: x["text"])), f"{name}_val": F.when(some, F.transform(ordered, lambda x: x["n"]))}
    pixel = lambda i: F.when((i["height"] >= 0) & (i["width"] >= 0), i["height"] * i["width"]).otherwise(-1)
    image_words = F.array_distinct(F.flatten(F.concat(F.transform(p("images"), lambda i: U.tokens(i["url"])), F.transform(p("images"), lambda i: T.sentences(i["alt"])))))
    ld = p("ld")
    second = {
        "htags_i": tags, "schema_org_breadcrumb_i": p("breadcrumbs"), "opengraph_title_t": meta("og:title"), "opengraph_type_s": meta("og:type"), "opengraph_url_s": meta("og:url"), "opengraph_image_s": meta("og:image"),
        "robots_i": T.robots_mask(F.try_element_at(p("metas"), F.lit("robots")), header("x-robots-tag")), "metagenerator_t": meta("generator"),
        "licount_i": F.size(p("li")), "li_txt": p("li"), "dtcount_i": F.size(p("dt")), "dt_txt": p("dt"), "ddcount_i": F.size(p("dd")), "dd_txt": p("dd"),
        "startDates_dts": F.filter(F.transform(p("start_dates"), times.iso8601), lambda d: d.isNotNull()), "endDates_dts": F.filter(F.transform(p("end_dates"), times.iso8601), lambda d: d.isNotNull()),
        "articlecount_i": F.size(p("articles")), "article_txt": p("articles"),
        "imagescount_i": F.size(p("images")), "images_sxt": F.col("_images"), "images_alt_sxt": F.transform(p("images"), lambda i: i["alt"]), "images_height_val": F.transform(p("images"), lambda i: i["height"]), "images_width_val": F.transform(p("images"), lambda i: i["width"]), "images_pixel_val": F.transform(p("images"), pixel), "images_withalt_i": F.size(F.filter(p("images"), lambda i: i["alt"] != "")), "images_text_t": F.array_join(F.when(is_image, U.tokens(F.col("_url"))).otherwise(image_words), " "),
        "csscount_i": F.size(p("css")), "css_tag_sxt": F.transform(p("css"), lambda u: F.concat(F.lit('<link rel="stylesheet" type="text/css" href="'), u, F.lit('" />'))), "css_url_sxt": p("css"), "scriptscount_i": F.size(p("scripts")), "scripts_sxt": p("scripts"), "framesscount_i": F.size(p("frames")), "frames_sxt": p("frames"), "iframesscount_i": F.size(p("iframes")), "iframes_sxt": p("iframes"),
        "canonical_s": F.col("_canonical"), "canonical_equal_sku_b": F.when(F.col("_canonical").isNotNull(), U.normal_form(F.col("_canonical")) == F.col("_url")), "refresh_s": F.when(F.col("_refresh") != "", F.col("_refresh")),
        "flash_b": F.exists("_links", lambda u: U.file_extension(u) == "swf"), "responsetime_i": F.coalesce(header("response-time-millis").try_cast("int"), F.lit(0)),
        "hreflang_cc_sxt": F.map_keys(p("hreflang")), "hreflang_url_sxt": F.map_values(p("hreflang")), "navigation_type_sxt": F.map_keys(p("navigation")), "navigation_url_sxt": F.map_values(p("navigation")), "publisher_url_s": p("publisher_link"),
        "text_t": p("text"), "wordcount_i": T.word_count(p("text")), "linkscount_i": F.size("_links"), "linksnofollowcount_i": nofollow(F.col("_links")), "inboundlinkscount_i": F.size(inbound), "inboundlinksnofollowcount_i": nofollow(inbound), "outboundlinkscount_i": F.size(outbound), "outboundlinksnofollowcount_i": nofollow(outbound),
        "inboundlinks_sxt": F.transform(in_list, lambda a: a["url"]), "inboundlinks_anchortext_txt": F.transform(in_list, lambda a: a["text"]), "outboundlinks_sxt": F.transform(out_list, lambda a: a["url"]), "outboundlinks_anchortext_txt": F.transform(out_list, lambda a: a["text"]),
        "charset_s": F.coalesce(T.charset_name(given("charset", "string")), T.charset_name(T.content_charset(header("content-type"))), F.lit("UTF-8")), "httpstatus_i": F.coalesce(given("http_status", "int"), F.lit(200)),
        "coordinate_p": F.when((p("lat") != 0) & (p("lon") != 0), F.concat_ws(",", p("lat"), p("lon"))), "coordinate_lat_d": F.when((p("lat") != 0) & (p("lon") != 0), p("lat")), "coordinate_lon_d": F.when((p("lat") != 0) & (p("lon") != 0), p("lon")),
        "load_date_dt": load_time, "fresh_date_dt": times.fresh_until(load_time, modified), "referrer_url_s": given("referrer", "string"), "publisher_t": meta("copyright", "dc.publisher"), "language_s": p("language"),
        "size_i": F.greatest(F.length("_url"), F.coalesce(header("content-length").try_cast("int"), F.lit(0))), "audiolinkscount_i": media("audio"), "videolinkscount_i": media("video"), "applinkscount_i": media("app"),
        "ld_o": F.when(F.size(ld) > 0, F.element_at(ld, 1)), "ld_s": F.when(F.size(ld) > 0, F.concat(F.lit("["), F.array_join(ld, ","), F.lit("]"))), "ld_context_sxt": F.filter(F.transform(ld, lambda x: F.get_json_object(x, "$['@context']")), lambda x: x.isNotNull()),
    }
    if run_date is not None:
        base = base.withColumn("_dates", times.dates_in_text(run_date)(p("text")))
        second |= {"dates_in_content_count_i": F.size("_dates"), "dates_in_content_dts": F.col("_dates")}
    keep = [c for c in docs.columns if c not in ("page", "headers", "url")]
    return base.select(*keep, *[c.alias(n) for n, c in (first | heads | styled | second).items()])


def graph_record(index: DataFrame, *keys: str) -> DataFrame:
    return index.select(*keys, *[c for c in GRAPH_COLUMNS if c in index.columns])


def edges(index: DataFrame) -> DataFrame:
    """(source, target, kind, text) of each listed link."""
    listed = lambda kind: F.coalesce(F.transform(F.arrays_zip(F.col(f"{kind}links_sxt").alias("u"), F.col(f"{kind}links_anchortext_txt").alias("t")), lambda x: F.struct(x["u"].alias("target"), F.lit(kind).alias("kind"), x["t"].alias("text"))), F.array())
    # both lists in one pass, so that a page is parsed once
    return index.select(F.col("url_s").alias("source"), F.explode(F.concat(listed("inbound"), listed("outbound"))).alias("l")).select("source", "l.*")


def is_canonical(index: DataFrame) -> Column:
    return F.coalesce(F.col("canonical_s"), F.lit("")).isin("") | (F.col("canonical_s") == F.col("url_s"))


def canonical_split(index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records for the index, and those of pages that name another address."""
    own = is_canonical(index)
    return index.where(own), index.where(~own)


def crawler_status(index: DataFrame, at: Column) -> DataFrame:
    """id, status, comment and time of each page: parsed, with its title, or noncanonical, with the other address."""
    own = is_canonical(index)
    return index.select("id", F.col("url_s").alias("url"), F.when(own, "parsed").otherwise("noncanonical").alias("status"), F.when(own, F.coalesce(F.try_element_at("title", F.lit(1)), F.lit(""))).otherwise(F.concat(F.lit("the canonical address is "), F.col("canonical_s"))).alias("comment"), at.alias("updated"))


def bulk_lines(index: DataFrame, index_name: str = "web") -> DataFrame:
    """Two lines in one value for each record: the action and the document; so they stay together whatever the order."""
    action = F.to_json(F.struct(F.struct(F.lit(index_name).alias("_index"), F.col("id").alias("_id")).alias("index")))
    return index.select(F.concat_ws("\n", action, F.to_json(F.struct(*[c for c in index.columns if c != "id"]), {"ignoreNullFields": "true"})).alias("value"))


def enriched(records: DataFrame, crawls: DataFrame, key: str) -> DataFrame:
    """Records with the crawl and user of their job; empty ids are left out, the user joins the list of users."""
    c = crawls.select(key, F.nullif(F.col("crawl_id"), F.lit("")).alias("crawl_id_s"), F.nullif(F.col("user_id"), F.lit("")).alias("user_id_s"))
    return records.join(c, key, "left").withColumn("user_id_sxt", F.when(F.col("user_id_s").isNotNull(), F.array("user_id_s")))
