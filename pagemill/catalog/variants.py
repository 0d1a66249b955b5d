"""Pages that differ by customer, so that SQL can say what each must hold: quirks of markup, dates and robots, models, media over many documents, charsets, hosts and agents."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.catalog.records import flat
from pagemill.functions import agents, html, url
from pagemill.functions import text as T
from pagemill.operators import documents as D
from pagemill.operators import patterns
from pagemill.plans import index as plan
from pagemill.plans import media
from pagemill.queries import load_time, query, table
from pagemill.shared import spread
from pagemill.sources import warc


def filled(spark, sf_dir, pages: list[str], **more):
    """Customers with their page: of so many templates that of the number; {k} is the number, {m} its remainder by 40, {s} that of the next."""
    k = F.col("c_custkey")
    page = F.lit(pages[0])
    for i, p in enumerate(pages[1:], 1):
        page = F.when(k % len(pages) == i, p).otherwise(page)
    for name, value in {"k": k, "m": k % 40, "s": (k + 1) % 40}.items():
        page = F.replace(page, F.lit(f"{{{name}}}"), value.cast("string"))
    return spread(table(spark, sf_dir, "customer").select(k)).select(k, F.concat(F.lit("http://h.org/p/"), k.cast("string")).alias("url"), page.alias("html"), *[c.alias(n) for n, c in more.items()])


#: What a page's markup may hold beside plain elements, one case in each.
QUIRKS = [
    "<p>seen</p><!-- googleoff: all --><p>hidden {k}</p><!-- googleon: all --><p>again</p>",
    "<script>var a = \"<b>no</b>\";</script><b>yes {k}</b>",
    "<p>one <i>two <b>three {k}</b></p> four</i>",
    "<base href=\"http://b.org/x/\"><a href=\"y{k}\">based</a><a href=\"../z\">up</a>",
    "<area href=\"/area{k}\" alt=\"map\"><param name=\"movie\" value=\"/m{k}.swf\">",
    "<p>see http://t.org/{k} now</p><p>at N 50° 30.0' E 8° 15.0'</p>",
    "<img src=\"/a{k}.png\" alt=\"a\" width=\"12px\" height=\"auto\"><img src=\"/a{k}.png\" alt=\"b\"><img alt=\"none\">",
]


@query("""WITH c AS (SELECT c_custkey AS k, c_custkey % 7 AS v FROM customer)
 SELECT k AS c_custkey, CASE v WHEN 0 THEN 'seen. again.' WHEN 1 THEN 'yes ' || k || '.' WHEN 2 THEN 'one. two. three ' || k || '. four.' WHEN 3 THEN 'based up' WHEN 4 THEN '' WHEN 5 THEN 'see http://t.org/' || k || ' now. at N 50° 30.0'' E 8° 15.0''.' ELSE '' END AS text_t,
 CASE v WHEN 3 THEN 'http://b.org/x/y' || k || '|http://b.org/z' WHEN 4 THEN 'http://h.org/area' || k WHEN 5 THEN 'http://t.org/' || k ELSE '' END AS links, CASE v WHEN 1 THEN 'yes ' || k WHEN 2 THEN 'three ' || k ELSE '' END AS bold, v = 4 AS flash_b,
 CASE WHEN v = 5 THEN 50.5 END::DOUBLE AS coordinate_lat_d, CASE WHEN v = 5 THEN 8.25 END::DOUBLE AS coordinate_lon_d, CASE WHEN v = 6 THEN 'http://h.org/a' || k || '.png' ELSE '' END AS images, CASE WHEN v = 6 THEN 'b' ELSE '' END AS alts FROM c""")
def page_quirks(spark, sf_dir):
    r = plan.index_record(html.with_html(filled(spark, sf_dir, QUIRKS)), load_time())
    joined = lambda *cs: F.array_join(F.concat(*[F.coalesce(F.col(c), F.array()) for c in cs]), "|")
    return r.select("c_custkey", "text_t", joined("inboundlinks_sxt", "outboundlinks_sxt").alias("links"), joined("bold_txt").alias("bold"), "flash_b", "coordinate_lat_d", "coordinate_lon_d", joined("images_sxt").alias("images"), joined("images_alt_sxt").alias("alts"))


#: Missing titles, dates in several places, robots in both, refresh, linked data.
HEADS = [
    "<meta name=\"title\" content=\"meta {k}\"><h2>second</h2><meta name=\"robots\" content=\"noindex\"><meta http-equiv=\"refresh\" content=\"5; url=/r{k}\">",
    "<h3>third {k}</h3><h2>second {k}</h2><meta name=\"date\" content=\"2023-05-06\"><meta name=\"robots\" content=\"follow\"><meta name=\"robots\" content=\"nofollow, noarchive\">",
    "<title></title><title>late {k}</title><time datetime=\"2024-03-01\">then</time><script type=\"application/ld+json\">{\"@context\":\"http://schema.org\",\"n\":{k}}</script>",
    "<p>no title</p><span itemprop=\"startDate\" content=\"2024-02-03T10:00:00Z\"></span><span itemprop=\"endDate\" content=\"2024-02-04\"></span><meta name=\"date\" content=\"2031-01-01\">",
]


@query("""WITH c AS (SELECT c_custkey AS k, c_custkey % 4 AS v FROM customer)
 SELECT k AS c_custkey, CASE v WHEN 0 THEN 'meta ' || k WHEN 1 THEN 'second ' || k WHEN 2 THEN '|late ' || k ELSE '' END AS title, CASE v WHEN 0 THEN 8 WHEN 1 THEN 48 ELSE 0 END + CASE WHEN k % 3 = 0 THEN 2560 ELSE 0 END::BIGINT AS robots_i,
 CASE WHEN v = 0 THEN '/r' || k END AS refresh_s, CASE v WHEN 2 THEN '2024-03-01 00:00:00' WHEN 3 THEN '2024-02-03 10:00:00' ELSE '' END AS "startDates_dts", CASE v WHEN 3 THEN '2024-02-04 00:00:00' ELSE '' END AS "endDates_dts",
 CASE WHEN v = 2 THEN '[{"@context":"http://schema.org","n":' || k || '}]' END AS ld_s, CASE WHEN v = 2 THEN '{"@context":"http://schema.org","n":' || k || '}' END AS ld_o, CASE WHEN v = 2 THEN 'http://schema.org' ELSE '' END AS ld_context_sxt,
 CASE WHEN v = 1 THEN least(CASE WHEN k % 3 = 1 THEN '2023-04-05 06:07:08' ELSE '2024-01-01 00:00:00' END, '2023-05-06 00:00:00') WHEN k % 3 = 1 THEN '2023-04-05 06:07:08' ELSE '2024-01-01 00:00:00' END AS last_modified FROM c""")
def record_heads(spark, sf_dir):
    k = F.col("c_custkey")
    headers = F.when(k % 3 == 0, F.create_map(F.lit("x-robots-tag"), F.lit("noindex, noarchive"))).when(k % 3 == 1, F.create_map(F.lit("last-modified"), F.lit("Wed, 05 Apr 2023 06:07:08 GMT")))
    r = plan.index_record(html.with_html(filled(spark, sf_dir, HEADS, headers=headers)), load_time())
    return r.select("c_custkey", flat("title"), F.col("robots_i").cast("long").alias("robots_i"), "refresh_s", flat("startDates_dts"), flat("endDates_dts"), "ld_s", "ld_o", flat("ld_context_sxt"), F.col("last_modified").cast("string").alias("last_modified"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'http h org p ' || c_custkey || ' png' ELSE 'page' END AS images_text_t, CASE WHEN c_custkey % 2 = 0 THEN 'image/png' ELSE 'text/html' END AS content_type FROM customer")
def record_images(spark, sf_dir):
    """Records of images themselves and of pages that show one."""
    k = F.col("c_custkey")
    made = filled(spark, sf_dir, ["", "<img src=\"\" alt=\"none\"><img src=\"page\" alt=\"\">"], mime=F.when(k % 2 == 0, "image/png").otherwise("text/html"))
    made = made.withColumn("url", F.when(k % 2 == 0, F.concat("url", F.lit(".png"))).otherwise(F.col("url")))
    r = plan.index_record(html.with_html(made), load_time())
    words = F.when(k % 2 == 0, F.col("images_text_t")).otherwise(F.element_at(F.split("images_text_t", " "), -1))
    return r.select("c_custkey", words.alias("images_text_t"), flat("content_type"))


@query("""WITH c AS (SELECT c_custkey AS k FROM customer) SELECT k AS c_custkey, 'http://h.org/p/' || k AS url_s, 'http' AS url_protocol_s, 'h.org' AS host_s, 1::BIGINT AS inboundlinkscount_i, 'http://h.org/in' || k AS inboundlinks_sxt, 'in' AS inboundlinks_anchortext_txt, 1::BIGINT AS outboundlinkscount_i, 1::BIGINT AS outboundlinksnofollowcount_i,
 'http://o.org/' || k AS outboundlinks_sxt, 'http://h.org/i' || k || '.png' AS images_sxt, 'http://h.org/c' || k AS canonical_s, 'http://h.org/f' || k AS iframes_sxt, 'http://h.org/s.css' AS css_url_sxt, 'http://h.org/j.js' AS scripts_sxt, 2::BIGINT AS linkscount_i, 24::BIGINT AS width FROM c""")
def graph_projection(spark, sf_dir):
    page = "<link rel=\"canonical\" href=\"/c{k}\"><link rel=\"stylesheet\" type=\"text/css\" href=\"/s.css\"><script src=\"/j.js\"></script><iframe src=\"/f{k}\"></iframe><img src=\"/i{k}.png\"><a href=\"/in{k}\">in</a><a href=\"http://o.org/{k}\" rel=\"nofollow\">out</a>"
    g = plan.graph_record(plan.index_record(html.with_html(filled(spark, sf_dir, [page])), load_time()), "c_custkey")
    own = F.filter("inboundlinks_sxt", lambda u: u != F.col("canonical_s"))
    return g.select("c_custkey", "url_s", "url_protocol_s", "host_s", *[F.col(c).cast("long").alias(c) for c in ("inboundlinkscount_i", "outboundlinkscount_i", "outboundlinksnofollowcount_i", "linkscount_i")], F.array_join(own, "|").alias("inboundlinks_sxt"),
        F.array_join(F.filter("inboundlinks_anchortext_txt", lambda t: t != ""), "|").alias("inboundlinks_anchortext_txt"), flat("outboundlinks_sxt"), flat("images_sxt"), "canonical_s", flat("iframes_sxt"), flat("css_url_sxt"), flat("scripts_sxt"), F.lit(len(g.columns) - 1).cast("long").alias("width"))


SITE = "<html><head><title>t</title><meta name=\"generator\" content=\"Press {m}\"><link rel=\"stylesheet\" type=\"text/css\" href=\"/themes/a.css\"><script src=\"/tag.js\"></script><script>track({k});\n</script></head><body class=\"home c{m}\"><!-- made\nby hand --><div id=\"top\"><a href=\"/buy\">Buy</a></div><div id=\"n{m}\"></div><img src=\"/logo.png\"><iframe src=\"/ads\"></iframe>last words</body></html>"
#: Subjects of two models, the element and pattern of each; two subjects share a pattern, one has several, one finds nothing.
RULES = [("cms", "press", "metagenerator", "Press [0-9]+"), ("cms", "theme", "csspath", "/themes/.*"), ("cms", "home", "bodyclass", "home c1?[0-9]"), ("cms", "hand", "comment", " made by hand "), ("cms", "none", "title", "x.*"), ("shop", "boxes", "divid", ".*"),
    ("shop", "boxes", "apath", "/buy"), ("shop", "code", "scriptcode", "track\\([0-9]+\\); "), ("shop", "code", "scriptpath", "/tag\\.js"), ("shop", "adverts", "iframepath", "http://h\\.org/ads"), ("shop", "logo", "imgpath", ".*logo.*"), ("shop", "title", "title", "t"), ("shop", "words", "text", "last words"), ("shop", "here", "url", "http://h.org/.*")]


@query("""SELECT c_custkey, CASE WHEN c_custkey % 40 < 20 THEN 'hand|home|press|theme' ELSE 'hand|press|theme' END AS ext_cms_txt, CASE WHEN c_custkey % 40 < 20 THEN '1|1|1|1' ELSE '1|1|1' END AS ext_cms_val, 'boxes|code|adverts|here|logo|title|words' AS ext_shop_txt, '3|2|1|1|1|1|1' AS ext_shop_val, true AS ext_other_txt FROM customer""")
def model_columns(spark, sf_dir):
    """Scores of pattern models as columns of the record, from the elements of the markup."""
    pages = filled(spark, sf_dir, [SITE])
    scores = patterns.evaluate(patterns.page_elements(pages, "c_custkey", "html", "url"), spark.createDataFrame(RULES, "model string, subject string, element string, pattern string"))
    out = patterns.with_models(plan.index_record(html.with_html(pages), load_time()), "c_custkey", scores, ["cms", "shop", "other"])
    return out.select("c_custkey", *[flat(f"ext_{m}_{c}") for m in ("cms", "shop") for c in ("txt", "val")], F.col("ext_other_txt").isNull().alias("ext_other_txt"))


SHOP = [
    f"<title>C{{k}}</title><meta name=\"description\" content=\"{about}\"><meta name=\"keywords\" content=\"a, b\"><img src=\"/i{{m}}.png\" alt=\"pic {{k}}\"><a href=\"/i{{s}}.png\">see {{k}}</a><a href=\"/s{{m}}.mp3\"></a>"
    "<a href=\"/v{m}.mp4\" rel=\"nofollow\">film {k}</a><a href=\"/x{m}.zip\">zip {k}</a><iframe src=\"/f{m}.html\"></iframe><embed src=\"/e{m}.svg\">"
    for about in ("C{k}", "about {k}")
]


@query("""WITH c AS (SELECT c_custkey AS k, 'C' || c_custkey || CASE WHEN c_custkey % 2 = 1 THEN ' about ' || c_custkey ELSE '' END || ' a,b - ' AS d FROM customer),
 m AS (SELECT 'image' AS kind, 'http://h.org/i' || k % 40 || '.png' AS url, 2 * k AS o, d || 'pic ' || k AS description FROM c UNION ALL SELECT 'image', 'http://h.org/i' || (k + 1) % 40 || '.png', 2 * k + 1, d || 'see ' || k FROM c
  UNION ALL SELECT 'audio', 'http://h.org/s' || k % 40 || '.mp3', k, d || 'http h org p ' || k FROM c UNION ALL SELECT 'video', 'http://h.org/v' || k % 40 || '.mp4', k, d || 'film ' || k FROM c UNION ALL SELECT 'app', 'http://h.org/x' || k % 40 || '.zip', k, d || 'zip ' || k FROM c)
 SELECT kind, url, arg_max(description, o) AS description, count(*) AS mentions FROM m GROUP BY kind, url""")
def media_links(spark, sf_dir):
    return media.media_links(html.with_html(filled(spark, sf_dir, SHOP)), "c_custkey")


@query("""WITH c AS (SELECT c_custkey AS k FROM customer), m AS (SELECT '/i' || (k + 1) % 40 || '.png' AS u, k AS o, 'see ' || k AS t FROM c UNION ALL SELECT '/s' || k % 40 || '.mp3', k, '' FROM c UNION ALL SELECT '/x' || k % 40 || '.zip', k, 'zip ' || k FROM c
  UNION ALL SELECT '/f' || k % 40 || '.html', k, 'iframe' FROM c UNION ALL SELECT '/e' || k % 40 || '.svg', k, 'embed' FROM c)
 SELECT 'http://h.org' || u AS url, arg_max(t, o) AS text, count(*) AS mentions FROM m GROUP BY u""")
def followed_links(spark, sf_dir):
    return media.hyperlinks(html.with_html(filled(spark, sf_dir, SHOP)), "c_custkey", with_nofollow=False)


SENTENCES = r"list_filter(list_transform(string_split(regexp_replace(regexp_replace(text, '[\x00- ]+', ' ', 'g'), '([.!?][^\p{L}\p{Nd}.!?])', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '')"


@query(f"""WITH s AS (SELECT doc_id, {SENTENCES} AS s FROM documents), p AS (SELECT doc_id, unnest(s) AS phrase, unnest(range(len(s))) AS place FROM s)
 SELECT md5(phrase) AS phrase, count(*)::BIGINT AS n, count(DISTINCT doc_id) AS documents, min(doc_id) AS first_document, arg_min(place, doc_id * 1000000 + place)::BIGINT AS first_place FROM p GROUP BY phrase""")
def phrase_counts(spark, sf_dir):
    p = D.phrases(table(spark, sf_dir, "documents"), "doc_id", T.sentences(F.col("text")))
    return p.select(F.md5("phrase").alias("phrase"), F.col("n").cast("long").alias("n"), "documents", "first_document", F.col("first_place").cast("long").alias("first_place"))


#: Sentences by charset: bytes that nothing describes.
SPOKEN = {
    "cp1251": "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему.", "koi8_r": "Всё смешалось в доме, и жена узнала, что муж был в связи.", "iso8859_5": "Мороз и солнце; день чудесный! Ещё ты дремлешь, друг прелестный.",
    "cp1253": "Η γλώσσα μου έδωσαν ελληνική, το σπίτι φτωχικό στις αμμουδιές.", "cp1255": "בראשית ברא אלהים את השמים ואת הארץ", "cp1256": "يولد جميع الناس أحرارا متساوين في الكرامة والحقوق",
    "cp1250": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności.", "iso8859_2": "Všichni lidé rodí se svobodní a sobě rovní co do důstojnosti a práv.", "cp1254": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar.",
    "cp932": "すべての人間は、生まれながらにして自由であり、権利とについて平等である。", "euc_jp": "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。", "gb18030": "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心。", "big5": "人人生而自由，在尊嚴和權利上一律平等。他們賦有理性和良心。", "cp949": "모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다.",
}
KINDS = len(SPOKEN) + 2
LATIN = r"regexp_matches(coalesce(text, ''), '^[\x00-\x7f\xa0-\xff]*$')"


@query("SELECT doc_id, CASE doc_id % " + str(KINDS) + " " + " ".join(f"WHEN {i} THEN '{t}' || ' ' || doc_id" for i, t in enumerate(SPOKEN.values())) + " ELSE md5(text) END AS body FROM documents")
def charset_guesses(spark, sf_dir):
    """Documents as bytes that nothing describes: in windows-1252 as far as they can be written so, else in UTF-8; of others a sentence in one of fourteen charsets."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", (F.col("doc_id") % KINDS).alias("v"))
    latin = F.col("text").rlike(r"^[\x00-\x7f\xa0-\xff]*\z")
    payload = F.when(latin, F.encode(F.when(latin, F.col("text")), "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    for i, (name, sentence) in enumerate(SPOKEN.items()):
        payload = F.when(F.col("v") == i, F.concat(F.unhex(F.lit(sentence.encode(name).hex())), F.encode(F.concat(F.lit(" "), F.col("doc_id").cast("string")), "UTF-8"))).otherwise(payload)
    told = d.select("doc_id", "v", warc.decoded(payload, F.lit("text/html")).alias("body"))
    return told.select("doc_id", F.when(F.col("v") < len(SPOKEN), F.col("body")).otherwise(F.md5("body")).alias("body"))


ENCODED = "replace(replace(replace(replace(text, '&', '&amp;'), '\"', '&quot;'), '<', '&lt;'), '>', '&gt;')"
for _name, _char in html.ENTITIES.items():
    if _char not in "&\"<>'  ":
        ENCODED = f"replace({ENCODED}, '{_char}', '&{_name};')"
for _char in T.NUMBERED:
    ENCODED = f"replace({ENCODED}, '{_char}', '&#{ord(_char):03};')"


@query(f"SELECT doc_id, md5({ENCODED}) AS encoded FROM documents")
def html_encoded(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.encoded(F.col("text"), html.ENTITIES)).alias("encoded"))


HOSTS = [("localhost", 7, True), ("127.0.0.1", 7, True), ("192.168.1.9", 7, True), ("172.20.0.1", 7, True), ("172.40.0.1", 6, False), ("[::1]", 7, True), ("fe80:1:2%eth0", 7, True), ("fd00:1", 7, True), ("www.a.DE", 0, False), ("b.jp", 2, False), ("c.unknown", 6, False), ("name", 6, False), ("", 7, False)]


@query("SELECT c_custkey, CASE c_custkey % 13 " + " ".join(f"WHEN {i} THEN {n}" for i, (_, n, _) in enumerate(HOSTS)) + " END::BIGINT AS class, c_custkey % 13 IN (" + ", ".join(str(i) for i, x in enumerate(HOSTS) if x[2]) + ") AS intranet FROM customer")
def host_classes(spark, sf_dir):
    host = F.expr("CASE c_custkey % 13 " + " ".join(f"WHEN {i} THEN '{h}'" for i, (h, _, _) in enumerate(HOSTS)) + " END")
    c = table(spark, sf_dir, "customer").select("c_custkey", host.alias("host"))
    classes = spark.createDataFrame([("de", 0), ("jp", 2), ("us", 4), ("com", 6)], "tld string, class int")
    return url.domain_classes(c, "host", classes, "class").select("c_custkey", F.col("class").cast("long").alias("class"), url.is_intranet(F.col("host")).alias("intranet"))


AGENTS = [("bot (linux; Europe/de) x", "Europe/de"), ("bot (Asia/jp) v; 1", "Asia/jp"), ("bot (open", "open"), ("plain", "plain"), ("a; b", "a; b"), ("x) y; (z)", "z)")]


@query("SELECT c_custkey, CASE c_custkey % 6 " + " ".join(f"WHEN {i} THEN '{w}'" for i, (_, w) in enumerate(AGENTS)) + " END AS location, CASE c_custkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1.25 WHEN 2 THEN 0 WHEN 3 THEN 0 ELSE 1 END::DOUBLE AS version, c_custkey % 5 = 1 AS serves, CASE WHEN c_custkey % 3 = 0 THEN 2147483647 ELSE c_custkey END::BIGINT AS unseen FROM customer")
def agent_facts(spark, sf_dir):
    k = F.col("c_custkey")
    pick = lambda n, values: F.expr(f"CASE c_custkey % {n} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END")
    version, last = pick(5, ["x/1", "1.25/9", "1.25", "/", "1/0"]), F.when(k % 3 == 0, "long ago").otherwise(k.cast("string"))
    return table(spark, sf_dir, "customer").select(k, agents.agent_location(pick(6, [a for a, _ in AGENTS])).alias("location"), agents.peer_version(version).cast("double").alias("version"), agents.serves_records(version).alias("serves"), agents.minutes_unseen(last).cast("long").alias("unseen"))
