"""Further operators: orders, pattern models, linked data, feeds, merges over documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.catalog.pages import EDGES
from pagemill.functions import codec, html, jsonld
from pagemill.functions import text as T
from pagemill.operators import documents as D
from pagemill.operators import feeds, lookup, patterns
from pagemill.plans import index as plan
from pagemill.plans import sinks
from pagemill.queries import load_time, query, table
from pagemill.sources import lookups

B64 = "rtrim(translate(base64(unhex(md5(c_name))), '+/', '-_'), '=')"


@query(f"SELECT c_custkey, {B64} AS h FROM customer ORDER BY translate({B64}, '{codec.URL_SAFE}', '{codec.SORTABLE}'), c_custkey")
def b64_order(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", codec.b64_encode(F.unhex(F.md5("c_name"))).alias("h"))
    return c.orderBy(codec.b64_sort_key(F.col("h")), "c_custkey")


@query("SELECT c_custkey, md5(c_name) AS h FROM customer ORDER BY md5(c_name) < '8', md5(c_name), c_custkey")
def rotated_order(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.md5("c_name").alias("h"))
    return c.orderBy(*codec.rotated_order(F.col("h"), F.lit("8")), "c_custkey")


MODELS = [("cms", "wordy", "text", ".*the.*"), ("cms", "long", "text", ".{500,}"), ("cms", "english", "url", "en"), ("cms", "none", "bogus", ".*")]


@query("""WITH e AS (SELECT doc_id AS id, 'text' AS element, replace(text, chr(10), ' ') AS value FROM documents UNION ALL SELECT doc_id, 'url', lang FROM documents),
 m AS (SELECT * FROM (VALUES ('wordy', 'text', '.*the.*'), ('long', 'text', '.{500,}'), ('english', 'url', 'en')) AS v(subject, element, pattern))
 SELECT id, 'cms' AS model, subject, count(*) AS n FROM e JOIN m USING (element) WHERE regexp_full_match(value, pattern) GROUP BY id, subject""")
def pattern_scores(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    e = d.select(F.col("doc_id").alias("id"), F.lit("text").alias("element"), F.replace("text", F.lit("\n"), F.lit(" ")).alias("value")).unionByName(d.select(F.col("doc_id").alias("id"), F.lit("url").alias("element"), F.col("lang").alias("value")))
    return patterns.evaluate(e, spark.createDataFrame(MODELS, "model string, subject string, element string, pattern string"))


@query("SELECT page_id, 'adverts' AS vocabulary, trim(regexp_replace(regexp_extract(html, '<[a-zA-Z0-9]+[^>]*class=\"ad\"[^>]*>([^<]*)', 1), '\\s+', ' ', 'g')) AS term FROM pages WHERE regexp_matches(html, '<[a-zA-Z0-9]+[^>]*class=\"ad\"[^>]*>[^<]*[^<\\s]')")
def class_vocabulary(spark, sf_dir):
    return patterns.class_terms(table(spark, sf_dir, "pages"), "page_id", "html", {"ad": "adverts", "missing": "none"})


#: Markup with a class before each page: quotes that hold brackets, single quotes, none, an element within, more classes than one, an empty element first.
CLASSED = [("<div title=\"a>b\" class=\"x\">deep</div>", "deep"), ("<div class=''x''>single</div>", "single"), ("<div class=\"x\"><b>inner</b> and outer</div>", "inner and outer"), ("<p class=x>bare</p><p class=\"x\">second</p>", "bare"),
    ("<div class=\"y x\"><span class=\"z\">of two</span></div>", "of two"), ("<span class=\"x\"></span><b class=\"X\">other</b><i class=\"x\">third &amp; last</i>", "third & last"), ("<b class=\"none\">no</b>", None)]


@query("SELECT page_id, 'places' AS vocabulary, CASE page_id % 7 " + " ".join(f"WHEN {k} THEN '{t}'" for k, (_, t) in enumerate(CLASSED) if t) + " END AS term FROM pages WHERE page_id % 7 < 6")
def class_places(spark, sf_dir):
    markup = F.expr("CASE page_id % 7 " + " ".join(f"WHEN {k} THEN '{m}'" for k, (m, _) in enumerate(CLASSED)) + " END")
    p = table(spark, sf_dir, "pages").select("page_id", F.concat(markup, "html").alias("html"))
    return patterns.class_terms(p, "page_id", "html", spark.createDataFrame([("x", "places"), ("nowhere", "missing")], "class string, vocabulary string"))


@query("SELECT * FROM (SELECT DISTINCT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"#][^\"]*)\"', 1)) AS target FROM pages) WHERE NOT regexp_matches(target, '^/th')")
def listed_links(spark, sf_dir):
    return patterns.links(table(spark, sf_dir, "pages"), "page_id", "html", ["^/th"])


# Namespaces of linked-data vocabularies by prefix.
NAMESPACES = sorted(jsonld.PREFIXES.items())


@query("WITH v AS (SELECT * FROM (VALUES " + ", ".join(f"('{p}', '{n}')" for p, n in NAMESPACES) + ") AS t(prefix, namespace)), q AS (SELECT DISTINCT namespace || 'term' || n_regionkey AS predicate FROM nation, v) SELECT predicate, prefix FROM q JOIN v ON starts_with(predicate, namespace)")
def predicate_vocabulary(spark, sf_dir):
    v = spark.createDataFrame(NAMESPACES, "prefix string, namespace string")
    q = table(spark, sf_dir, "nation").select("n_regionkey").distinct().join(F.broadcast(v)).select(F.concat("namespace", F.lit("term"), F.col("n_regionkey").cast("string")).alias("predicate"))
    ns = F.regexp_extract("predicate", r"^(.*[/#])[^/#]*$", 1)  # an equality join: no predicate meets all namespaces
    return q.withColumn("namespace", ns).join(v, "namespace").select("predicate", "prefix")


@query("SELECT conv_id, string_agg(DISTINCT role, ',' ORDER BY role) AS authors, count(*) AS parts, min(turn) AS first_turn, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def merge_documents(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.groupBy("conv_id").agg(F.array_join(F.array_sort(F.collect_set("role")), ",").alias("authors"), F.count(F.lit(1)).alias("parts"), F.min("turn").alias("first_turn"), F.array_join(D.in_order(F.col("text"), F.col("turn")), "\n").alias("text"))


@query(f"SELECT target, count(*) AS n, max(text) AS description FROM ({EDGES}) GROUP BY target")
def linked_pages(spark, sf_dir):
    """Link targets over all pages with how often and under which text they are named."""
    e = plan.edges(plan.index_record(html.with_html(table(spark, sf_dir, "pages")), load_time()))
    return e.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.max("text").alias("description"))


@query()
def linked_data(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    block = F.concat(F.lit('<script type="application/ld+json">{"@context":"http://schema.org","@type":"Article","@id":"http://d/'), F.col("doc_id").cast("string"), F.lit('","inLanguage":"'), F.col("lang"), F.lit('","author":{"@type":"Person","name":"x"}}</script>'))
    return jsonld.validate(d.select(F.concat(F.lit("http://d/"), "doc_id").alias("url"), block.alias("html")))


@query("SELECT event_type AS feed, event_id, user_id AS key, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS r FROM (SELECT event_type, user_id, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY event_type, user_id)) WHERE r <= 7")
def feed_history(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("feed"), F.col("user_id").alias("key"), "event_id", "value")
    return feeds.latest_items(e, "feed", "key", "event_id", most=7)


@query("SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def json_envelope(spark, sf_dir):
    answer = feeds.envelope(table(spark, sf_dir, "documents"), "lang", F.col("doc_id"))
    return answer.select("lang", F.get_json_object("answer", "$.count").cast("long").alias("n"))


@query("SELECT r_name AS subject, '<rdf:Description rdf:about=\"' || r_name || '\">' || string_agg('<has>' || n_name || '</has>', '' ORDER BY n_name) || '</rdf:Description>' AS value FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name")
def rdf_nodes(spark, sf_dir):
    t = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("subject"), F.lit("has").alias("predicate"), F.col("n_name").alias("object"))
    return sinks.rdf_nodes(t).select(F.regexp_extract("value", 'about="([^"]*)"', 1).alias("subject"), "value")


@query("SELECT doc_id, '<record><dc:title><![CDATA[' || source || ']]></dc:title><dc:creator><![CDATA[]]></dc:creator><dc:publisher><![CDATA[]]></dc:publisher><dc:subject><![CDATA[' || lang || ']]></dc:subject><dc:text><![CDATA[' || replace(text, ']]>', ']]]]><![CDATA[>') || ']]></dc:text><dc:identifier>' || doc_id || '</dc:identifier></record>' AS value FROM documents")
def dublin_core(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("title"), F.lit(None).cast("string").alias("creator"), F.lit("").alias("publisher"), F.col("lang").alias("subject"), "text", F.col("doc_id").cast("string").alias("url"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"))
    return sinks.dublin_core(d).select(F.regexp_extract("value", "<dc:identifier>([^<]*)", 1).cast("long").alias("doc_id"), "value")


@query("""SELECT 'locations' AS vocabulary, n_name AS term, lower(n_name) AS synonym FROM nation""")
def places_vocabulary(spark, sf_dir):
    from pagemill.catalog.words import gazetteer

    return lookup.places_vocabulary(gazetteer(spark, sf_dir)).drop("objectlink")


@query("SELECT 'nations' AS vocabulary, n_name || ':' || lower(n_name) || CASE WHEN n_regionkey = 1 THEN '#http://r/1' ELSE '' END AS value FROM nation WHERE n_regionkey <> 2")
def vocabulary_edit(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    v = n.select(F.lit("nations").alias("vocabulary"), F.col("n_name").alias("term"), F.lower("n_name").alias("synonym"), F.lit(None).cast("string").alias("objectlink"))
    linked = v.join(n.where("n_regionkey = 1").select(F.col("n_name").alias("term")), "term", "left_semi").select("vocabulary", "term", "synonym", F.lit("http://r/1").alias("objectlink"))
    return lookup.vocabulary_lines(lookup.delete(lookup.put(v, linked), n.where("n_regionkey = 2").select(F.col("n_name").alias("term"))))


@query("SELECT DISTINCT lower(event_type) AS key FROM events WHERE lower(event_type) IN ('click', 'view')")
def key_list(spark, sf_dir):
    keys = lookups.key_list(table(spark, sf_dir, "events").select(F.upper("event_type").alias("value")))
    return keys.join(spark.createDataFrame([("click",), ("view",)], "key string"), "key", "left_semi")


@query("SELECT doc_id, 'content-length: ' || n_chars || chr(13) || chr(10) || 'content-type: text/' || lang AS header, 'text/' || lang AS content_type FROM documents")
def header_lines(spark, sf_dir):
    h = F.create_map(F.lit("content-type"), F.concat(F.lit("text/"), F.col("lang")), F.lit("content-length"), F.col("n_chars").cast("string"))
    d = table(spark, sf_dir, "documents").select("doc_id", T.header_text(h).alias("header"))
    return d.select("doc_id", "header", F.try_element_at(T.headers_of(F.col("header")), F.lit("content-type")).alias("content_type"))


@query("SELECT source, CASE WHEN count(DISTINCT lang) = 1 THEN min(lang) WHEN bool_or(lang = 'fr') THEN 'fr' ELSE min(lang) END AS lang FROM documents GROUP BY source")
def language_pick(spark, sf_dir):
    d = table(spark, sf_dir, "documents").groupBy("source").agg(F.array_sort(F.collect_set("lang")).alias("l"))
    return d.select("source", T.picked_language(F.col("l"), F.lit("fr")).alias("lang"))


@query("SELECT event_id, event_id % 7 IN (0, 3) AS valid, event_id % 2 = 0 AS forbids, event_id % 3 = 0 AS cookies FROM events")
def response_checks(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 7 == 0, 200).when(F.col("event_id") % 7 == 3, 203).otherwise(404).alias("s"), F.when(F.col("event_id") % 2 == 0, "NoIndex").alias("x"), F.when(F.col("event_id") % 3 == 0, "a=b").otherwise("").alias("c"))
    return e.select("event_id", plan.valid_response(F.col("s"), F.col("x"), F.col("c")).alias("r")).select("event_id", "r.*")


@query("SELECT quality, count(*) AS n FROM (SELECT * FROM labels ORDER BY doc_id DESC LIMIT 50) GROUP BY quality")
def bayes_memory(spark, sf_dir):
    from pagemill.operators import bayes

    return bayes.recent(table(spark, sf_dir, "labels"), "doc_id", 50).groupBy("quality").agg(F.count(F.lit(1)).alias("n"))
