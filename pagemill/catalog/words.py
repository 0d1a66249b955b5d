"""Text queries over documents, and lookups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pagemill.functions import lines
from pagemill.functions import text as T
from pagemill.functions import times
from pagemill.operators import bayes, joins, lookup, scores
from pagemill.queries import query, table


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@query("SELECT doc_id, CASE WHEN text = '' THEN 0 ELSE length(text) - length(replace(text, ' ', '')) + 1 END::BIGINT AS wordcount_i FROM documents")
def doc_wordcount(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.word_count(F.col("text")).alias("wordcount_i"))


@query("SELECT doc_id, len(string_split(text, chr(10)))::BIGINT AS lines, string_split(text, chr(10))[-1] AS last_line FROM documents")
def doc_lines(spark, sf_dir):
    lines = F.split(F.col("text"), "\n")
    return docs(spark, sf_dir).select("doc_id", F.size(lines).cast("long").alias("lines"), F.element_at(lines, -1).alias("last_line"))


@query(r"""WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(regexp_replace(text, '[\x00- ]+', ' ', 'g'), '([.!?][^\p{L}\p{Nd}.!?])', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') AS s FROM documents)
 SELECT doc_id, len(s)::BIGINT AS sentences, s[1] AS first_sentence FROM s""")
def doc_sentences(spark, sf_dir):
    s = T.sentences(F.col("text"))
    return docs(spark, sf_dir).select("doc_id", F.size(s).cast("long").alias("sentences"), F.try_element_at(s, F.lit(1)).alias("first_sentence"))


@query(r"SELECT doc_id, trim(regexp_replace(text, '[\x00- ]+', ' ', 'g')) AS line FROM documents")
def clean_line(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.clean_line(F.col("text")).alias("line"))


@query("SELECT doc_id, replace(replace(replace(replace(replace(lower(trim(text)), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss'), ',', ' ') AS term FROM documents")
def normalize_term(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.normalized_term(F.col("text")).alias("term"))


@query("""SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(CASE WHEN contains(text, ',') THEN string_split(text, ',') WHEN contains(text, ';') THEN string_split(text, ';') ELSE string_split_regex(text, '\\s+') END, lambda x: trim(x)), lambda x: x <> ''))), '|') AS keywords FROM documents""")
def keywords_split(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.array_join(F.array_sort(T.keywords(F.col("text"))), "|").alias("keywords"))


CHARSETS = {"utf8": "UTF-8", "UTF_8": "UTF-8", "iso8859_1": "ISO-8859-1", "cp1252": "windows-1252", "x": None, "us-ascii": "US-ASCII", "latin1": "ISO-8859-1", "koi8-r": "KOI8-R"}


GIVEN = "CASE n_nationkey % 8 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(CHARSETS)) + " END"


@query(f"SELECT n_nationkey, {GIVEN} AS given, CASE n_nationkey % 8 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(CHARSETS.values()) if v) + " END AS charset FROM nation")
def charset_patch(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", F.expr(GIVEN).alias("given")).withColumn("charset", T.charset_name(F.col("given")))


@query("SELECT doc_id, CASE WHEN n_chars * 1000 > 1073741824 THEN (n_chars * 1000 // 1073741824) || ' gbyte' WHEN n_chars * 1000 > 1048576 THEN (n_chars * 1000 // 1048576) || ' mbyte' WHEN n_chars * 1000 > 1024 THEN (n_chars * 1000 // 1024) || ' kbyte' ELSE (n_chars * 1000) || ' byte' END AS size FROM documents")
def bytes_pretty(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.bytes_name(F.col("n_chars") * 1000).alias("size"))


@query()
def dates_in_content(spark, sf_dir):
    found = times.dates_in_text(dt.date(2020, 6, 1))(F.col("text"))
    return docs(spark, sf_dir).select("doc_id", found.alias("dates_in_content_dts")).withColumn("dates_in_content_count_i", F.size("dates_in_content_dts"))


ENGLISH, GERMAN = (times.MONTHS[k].title().split() for k in ("en", "de"))
#: How the day of an order is written, by its key.
WRITTEN = """CASE o_orderkey % 6 WHEN 0 THEN 'paid ' || {dd} || '.' || {mm} || '.' || {y} WHEN 1 THEN 'sent (' || {y} || '-' || {mm} || '-' || {dd} || ')' WHEN 2 THEN 'on ' || {en} || ' ' || {d} || ', ' || {y} || ' it came'
 WHEN 3 THEN 'vom ' || {d} || '. ' || {de} || ' ' || {y} || ' an' WHEN 4 THEN {d} || ' ' || {en} || ' ' || {y} ELSE 'order ' || o_orderkey || ' has none' END"""
EN, DE = ("element_at(array(" + ", ".join(f"'{m}'" for m in names) + "), month(o_orderdate))" for names in (ENGLISH, GERMAN))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 5 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END AS dates FROM orders")
def dates_written(spark, sf_dir):
    """The day of each order in words of a text, found again."""
    part = lambda form: f"date_format(o_orderdate, '{form}')"
    text = F.expr(WRITTEN.format(dd=part("dd"), mm=part("MM"), y=part("yyyy"), d=part("d"), en=EN, de=DE))
    found = times.dates_in_text(dt.date(2020, 6, 1))(text)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(F.transform(found, lambda x: x.cast("string")), ",").alias("dates"))


# Language codes of two letters that the tables use, with their names.
LANGUAGES = {"en": "English", "de": "German", "fr": "French", "es": "Spanish", "it": "Italian"}


@query("SELECT lang, CASE lang " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LANGUAGES.items()) + " END AS name, count(*) AS n FROM documents GROUP BY lang")
def language_check(spark, sf_dir):
    names = F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv])
    return docs(spark, sf_dir).groupBy("lang").agg(F.count(F.lit(1)).alias("n")).select("lang", F.try_element_at(names, F.col("lang")).alias("name"), "n")


@query(r"SELECT word, count(*) AS score FROM (SELECT unnest(string_split_regex(lower(text), '[^\p{L}]+')) AS word FROM documents) WHERE length(word) >= 5 GROUP BY word ORDER BY score DESC, word LIMIT 100")
def common_words_topk(spark, sf_dir):
    return scores.common_words(docs(spark, sf_dir), "text", 5, 100)


@query(r"SELECT word, count(*) AS score FROM (SELECT unnest(string_split_regex(lower(text), '[^\p{L}]+')) AS word FROM documents) WHERE length(word) >= 3 GROUP BY word ORDER BY score DESC, word LIMIT 200")
def frequent_words(spark, sf_dir):
    """By bounded counters and an exact second pass; few counters, so that they do not hold all words."""
    return scores.frequent_words(docs(spark, sf_dir), "text", 3, 200, capacity=20_000)


RUN = dt.date(2024, 3, 10)
#: Lines with the day of an order in ten forms, by its key.
LINES = """CASE o_orderkey % 10 WHEN 0 THEN {y} || '/' || {mm} || '/' || {dd} WHEN 1 THEN {wd} || ', ' || {d} || ' ' || {mon} || ' ' || {y} WHEN 2 THEN {wd} || ' ' || {mon} || ' ' || {d} || ' 10:20:30 ' || {y}
 WHEN 3 THEN 'paid ' || {dd} || '.' || {mm} || '.' || {y} WHEN 4 THEN 'on ' || {en} || ' ' || {d} || 'th, ' || {y} WHEN 5 THEN {y} || '-' || {mm} || '-' || {dd} WHEN 6 THEN element_at(array('today', 'gestern', 'uebermorgen'), cast(1 + o_orderkey div 10 % 3 as int))
 WHEN 7 THEN element_at(array('Silvester', 'Karfreitag', 'Easter Monday'), cast(1 + o_orderkey div 10 % 3 as int)) WHEN 8 THEN 'am ' || {d} || '. ' || {de} ELSE 'order ' || o_orderkey END"""


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 10 <= 5 THEN o_orderdate::DATE WHEN o_orderkey % 10 = 6 THEN [DATE '2024-03-10', DATE '2024-03-09', DATE '2024-03-12'][1 + o_orderkey // 10 % 3]
 WHEN o_orderkey % 10 = 7 THEN [DATE '2024-12-31', DATE '2024-03-29', DATE '2024-04-01'][1 + o_orderkey // 10 % 3] WHEN o_orderkey % 10 = 8 THEN make_date(2024, month(o_orderdate), day(o_orderdate)) END AS day FROM orders""")
def dates_of_lines(spark, sf_dir):
    part = lambda form: f"date_format(o_orderdate, '{form}')"
    text = F.expr(LINES.format(dd=part("dd"), mm=part("MM"), y=part("yyyy"), d=part("d"), wd=part("EEE"), mon=part("MMM"), en=EN, de=DE))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("line")).select("o_orderkey", lines.line_date(F.col("line"), RUN).alias("day"))


FEATURES = r"SELECT doc_id, unnest(list_distinct(list_filter(string_split_regex(regexp_replace(lower(text), '[^a-z0-9_]', ' ', 'g'), ' +'), lambda w: length(w) > 2))) AS feature FROM documents"


@query(f"WITH f AS ({FEATURES}) SELECT quality, feature, count(*) AS n FROM f JOIN labels USING (doc_id) GROUP BY quality, feature")
def bayes_train(spark, sf_dir):
    model = bayes.train(bayes.features(docs(spark, sf_dir), "doc_id", "text"), table(spark, sf_dir, "labels"), "doc_id", "quality")
    return model[0]


SCORES = f"""WITH f AS ({FEATURES}), m AS (SELECT quality, feature, count(*) AS n FROM f JOIN labels USING (doc_id) GROUP BY quality, feature),
 c AS (SELECT quality, count(*) AS docs FROM labels GROUP BY quality), t AS (SELECT feature, sum(n) AS total FROM m GROUP BY feature),
 w AS (SELECT t.feature, c.quality, ln((0.5 + total * (coalesce(n, 0) / docs)) / (1.0 + total)) AS w FROM t CROSS JOIN c LEFT JOIN m ON m.feature = t.feature AND m.quality = c.quality),
 k AS (SELECT doc_id, quality, sum(w) AS w FROM f JOIN w USING (feature) GROUP BY doc_id, quality)
 SELECT d.doc_id, c.quality, ln(c.docs / (SELECT sum(docs) FROM c)) + coalesce(k.w, 0) AS score FROM documents d CROSS JOIN c LEFT JOIN k ON k.doc_id = d.doc_id AND k.quality = c.quality"""


@query(f"SELECT doc_id, quality, round(score, 6) AS score FROM ({SCORES})")
def bayes_classify(spark, sf_dir):
    d = docs(spark, sf_dir)
    feats = bayes.features(d, "doc_id", "text")
    model = bayes.train(feats, table(spark, sf_dir, "labels"), "doc_id", "quality")
    return bayes.classify(feats, model, "doc_id", "quality", d).select("doc_id", "quality", F.round("score", 6).alias("score"))


@query(f"SELECT doc_id, quality FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, quality) AS r FROM ({SCORES})) WHERE r = 1")
def bayes_best(spark, sf_dir):
    d = docs(spark, sf_dir)
    feats = bayes.features(d, "doc_id", "text")
    model = bayes.train(feats, table(spark, sf_dir, "labels"), "doc_id", "quality")
    return bayes.best(bayes.classify(feats, model, "doc_id", "quality", d), "doc_id", "quality").select("doc_id", "quality")


#: Two classifiers that may say NONE, and one that may not and so is left out.
CONTEXTS = "SELECT doc_id, 'quality' AS context, CASE WHEN quality = 1 THEN 'good' ELSE 'NONE' END AS category FROM labels UNION ALL SELECT doc_id, 'tone', CASE WHEN toxic = 1 THEN 'toxic' ELSE 'NONE' END FROM labels UNION ALL SELECT doc_id, 'half', CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'odd' END FROM labels"


@query(f"""WITH f AS ({FEATURES}), l AS (SELECT * FROM ({CONTEXTS}) WHERE context <> 'half'), m AS (SELECT context, category, feature, count(*) AS n FROM f JOIN l USING (doc_id) GROUP BY ALL),
 c AS (SELECT context, category, count(*) AS docs FROM l GROUP BY ALL), t AS (SELECT context, feature, sum(n) AS total FROM m GROUP BY ALL),
 w AS (SELECT t.context, t.feature, c.category, ln((0.5 + total * (coalesce(n, 0) / docs)) / (1.0 + total)) AS w FROM t JOIN c USING (context) LEFT JOIN m ON m.context = t.context AND m.feature = t.feature AND m.category = c.category),
 k AS (SELECT doc_id, context, category, sum(w) AS w FROM f JOIN w USING (feature) GROUP BY ALL),
 s AS (SELECT d.doc_id, c.context, c.category, ln(c.docs / sum(c.docs) OVER (PARTITION BY d.doc_id, c.context)) + coalesce(k.w, 0) AS score FROM documents d CROSS JOIN c LEFT JOIN k ON k.doc_id = d.doc_id AND k.context = c.context AND k.category = c.category)
 SELECT doc_id, context, category, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, context ORDER BY round(score, 9) DESC, category) AS r FROM s) WHERE r = 1""")
def bayes_contexts(spark, sf_dir):
    d = docs(spark, sf_dir)
    feats = bayes.features(d, "doc_id", "text")
    parts = [("quality", F.when(F.col("quality") == 1, "good").otherwise("NONE")), ("tone", F.when(F.col("toxic") == 1, "toxic").otherwise("NONE")), ("half", F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd"))]
    labels = table(spark, sf_dir, "labels").select("doc_id", F.inline(F.array(*[F.struct(F.lit(c).alias("context"), k.alias("category")) for c, k in parts])))
    model = bayes.train_contexts(feats, labels, "doc_id")
    return bayes.best_of(feats, model, "doc_id", d).withColumn("score", F.round("score", 6))


RULE_WORDS = "SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part"


@query(f"WITH r AS (SELECT word AS name, '.*' || word || '( .*|$)' AS pattern FROM ({RULE_WORDS}) UNION ALL SELECT 'two ' || word, '[a-z]+ ' || word FROM ({RULE_WORDS}) UNION ALL SELECT 'long', '.{{30,}}') SELECT p_partkey, name FROM part JOIN r ON regexp_full_match(p_name, pattern)")
def rules_of_words(spark, sf_dir):
    """Every word of the part names as two rules, and one without any literal, against all part names."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    word = parts.select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    rules = word.select(F.inline(F.array(F.struct(F.col("word").alias("name"), F.concat(F.lit(".*"), "word", F.lit("( .*|$)")).alias("pattern")), F.struct(F.concat(F.lit("two "), "word").alias("name"), F.concat(F.lit("[a-z]+ "), "word").alias("pattern")))))
    rules = rules.unionByName(spark.createDataFrame([("long", ".{30,}")], "name string, pattern string"))
    return joins.matching_rule_rows(parts, "p_name", rules).select("p_partkey", "name")


def part_words(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.explode(F.split(F.lower("p_name"), "[^a-z0-9]+")).alias("word")).where("word <> ''").distinct()


WORDS = "SELECT DISTINCT unnest(string_split_regex(lower(p_name), '[^a-z0-9]+')) AS word FROM part"


@query(f"WITH w AS (SELECT word FROM ({WORDS}) WHERE word <> ''), q AS (SELECT DISTINCT left(word, 3) AS query FROM w WHERE length(word) >= 3) SELECT query, word FROM w JOIN q ON starts_with(word, query) AND length(word) > length(query)")
def prefix_recommend(spark, sf_dir):
    w = part_words(spark, sf_dir)
    return joins.recommend(w, w.where("length(word) >= 3").select(F.left("word", F.lit(3)).alias("query")).distinct(), "word", "query")


@query(f"WITH w AS (SELECT word FROM ({WORDS}) WHERE word <> ''), q AS (SELECT DISTINCT right(word, 3) AS query FROM w WHERE length(word) >= 3) SELECT query, word FROM w JOIN q ON ends_with(word, query) AND length(word) > length(query)")
def suffix_recommend(spark, sf_dir):
    w = part_words(spark, sf_dir)
    return joins.recommend(w, w.where("length(word) >= 3").select(F.right("word", F.lit(3)).alias("query")).distinct(), "word", "query", "end")


ALL_WORDS = r"SELECT DISTINCT unnest(string_split_regex(text, '[^\p{L}]+')) AS word FROM documents"


def letters(spark, sf_dir, end: str):
    """How many words go with each first (last) letter and two of them, whatever the case, with the least and the greatest."""
    w = docs(spark, sf_dir).select(F.explode(F.split("text", r"[^\p{L}]+")).alias("word")).where("word <> ''").distinct()
    part = F.right if end == "end" else F.left
    q = w.select(F.explode(F.array(*[F.lower(part("word", F.lit(n))) for n in (1, 2)])).alias("query")).distinct()
    found = joins.recommend(w, q, "word", "query", end, ignore_case=True, longer=False, range_words=20_000)
    return found.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("word").alias("least"), F.max("word").alias("greatest"))


LETTERS = "WITH w AS (SELECT word FROM ({words}) WHERE word <> ''), q AS (SELECT DISTINCT unnest([lower({part}(word, 1)), lower({part}(word, 2))]) AS query FROM w) SELECT query, count(*) AS n, min(word) AS least, max(word) AS greatest FROM w JOIN q ON {meets}(lower(word), query) GROUP BY query"


@query(LETTERS.format(words=ALL_WORDS, part="left", meets="starts_with"))
def first_letters(spark, sf_dir):
    return letters(spark, sf_dir, "start")


@query(LETTERS.format(words=ALL_WORDS, part="right", meets="ends_with"))
def last_letters(spark, sf_dir):
    return letters(spark, sf_dir, "end")


def gazetteer(spark, sf_dir):
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), n.alias("id"), (n * 7.0 - 80).cast("float").alias("lat"), (n * 14.0 - 170).cast("float").alias("lon"), ((n * 7919) % 20011).cast("long").alias("population"))


CODES = "SELECT n_name AS name, n_nationkey AS id, (n_nationkey * 7919 % 20011)::BIGINT AS population, upper(substring(n_name, 1, 2)) AS plate, '0' || n_nationkey AS dial, (10000 + n_nationkey)::VARCHAR AS zip FROM nation"


def coded_gazetteer(spark, sf_dir):
    return gazetteer(spark, sf_dir).select("*", F.upper(F.left("name", F.lit(2))).alias("plate"), F.concat(F.lit("0"), F.col("id").cast("string")).alias("dial"), (10000 + F.col("id")).cast("string").alias("zip"))


@query(f"""WITH a AS ({CODES}), b AS (SELECT 'New ' || name AS name, id + 100 AS id, population // 2 AS population, plate, dial, zip FROM a), g AS (SELECT 0 AS service, * FROM a UNION ALL SELECT 1, * FROM b),
 q AS (SELECT lower(left(name, 2)) AS asked FROM a UNION SELECT plate FROM a UNION SELECT dial FROM a UNION SELECT zip FROM a UNION SELECT 'n'),
 m AS (SELECT asked, service, id, name, population, min(CASE WHEN starts_with(lower(name), lower(asked)) THEN 1 WHEN plate = asked THEN 2 WHEN dial = asked THEN 3 ELSE 4 END) AS h FROM q JOIN g ON starts_with(lower(name), lower(asked)) OR plate = asked OR dial = asked OR zip = asked GROUP BY ALL)
 SELECT asked, service, id, name AS place, ['name', 'plate', 'dial', 'zip'][h] AS how, population, row_number() OVER (PARTITION BY asked ORDER BY population DESC, service, id) AS rank FROM m""")
def places_by_any_name(spark, sf_dir):
    """Two gazetteers asked by beginnings of names, plates, dialling and postal codes."""
    a = coded_gazetteer(spark, sf_dir)
    b = a.withColumns({"name": F.concat(F.lit("New "), "name"), "id": F.col("id") + 100, "population": F.expr("population div 2")})
    q = a.select(F.explode(F.array(F.lower(F.left("name", F.lit(2))), "plate", "dial", "zip", F.lit("n"))).alias("asked")).distinct()
    return lookup.find_by_any_name(q, "asked", [a, b]).select("asked", "service", "id", "place", "how", "population", "rank")


@query(f"""WITH g AS ({CODES}), q AS (SELECT DISTINCT '0' || (c_custkey % 31) || '-' || c_custkey AS number FROM customer),
 m AS (SELECT number, dial, name, id, row_number() OVER (PARTITION BY number ORDER BY length(dial) DESC) AS r FROM q JOIN g ON starts_with(replace(number, '-', ''), dial)) SELECT number, dial, name AS place, id FROM m WHERE r = 1""")
def places_by_number(spark, sf_dir):
    k = F.col("c_custkey").cast("string")
    q = table(spark, sf_dir, "customer").select(F.concat(F.lit("0"), (F.col("c_custkey") % 31).cast("string"), F.lit("-"), k).alias("number"))
    return lookup.by_number(q, "number", coded_gazetteer(spark, sf_dir))


@query("""WITH g AS (SELECT lower(n_name) AS k, n_name AS place, n_nationkey AS id, (n_nationkey * 7919 % 20011)::BIGINT AS population FROM nation), q AS (SELECT DISTINCT n_name AS name FROM nation UNION SELECT 'nowhere')
 SELECT name, place, id, population, row_number() OVER (PARTITION BY name ORDER BY population DESC, id) AS rank FROM q JOIN g ON lower(name) = k""")
def gazetteer_find(spark, sf_dir):
    asked = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name")).union(spark.createDataFrame([("nowhere",)], "name string"))
    return lookup.find_places(asked, "name", gazetteer(spark, sf_dir)).select("name", "place", "id", "population", "rank")


@query("""WITH s AS (SELECT r_regionkey AS set_id, lower(n_name) AS word FROM region JOIN nation ON n_regionkey = r_regionkey), f AS (SELECT word, min(set_id) AS set_id FROM s GROUP BY word)
 SELECT f.word AS asked, array_to_string(list_sort(list_distinct(list(s.word))), ',') AS synonyms FROM f JOIN s USING (set_id) WHERE f.word <> s.word GROUP BY f.word""")
def synonyms(spark, sf_dir):
    sets = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("set_id"), F.lower("n_name").alias("word")).distinct()
    return lookup.synonyms(sets.select(F.col("word").alias("asked")), "asked", sets).select("asked", F.array_join("synonyms", ",").alias("synonyms"))


VOCABULARY = ["# colours and kinds", "article:the,der,le", "Verbindung:and,und,et#http://v/and", "Ort=of the,in the"]


@query(r"""WITH w AS (SELECT doc_id, ' ' || array_to_string(list_filter(string_split(replace(replace(replace(replace(replace(lower(trim(regexp_replace(text, '[.!?;:()]', ' ', 'g'))), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss'), ',', ' '), ' '), lambda x: x <> ''), ' ') || ' ' AS run FROM documents),
 v(term, synonyms) AS (VALUES ('article', ['article', 'the', 'der', 'le']), ('Verbindung', ['verbindung', 'and', 'und', 'et']), ('Ort', ['ort', 'of the', 'in the']))
 SELECT doc_id, 'small' AS vocabulary, array_to_string(list_sort(list(DISTINCT term)), ',') AS terms FROM (SELECT term, unnest(synonyms) AS s FROM v) JOIN w ON contains(run, ' ' || s || ' ') GROUP BY doc_id""")
def tagging_facets(spark, sf_dir):
    lines = spark.createDataFrame([(x,) for x in VOCABULARY], "value string")
    return lookup.facets(docs(spark, sf_dir), "doc_id", "text", lookup.vocabulary(lines, F.lit("small"))).withColumn("terms", F.array_join("terms", ","))


@query("SELECT lower(regexp_extract(text, '([A-Za-z]+)', 1)) AS w, count(*) AS n FROM documents GROUP BY w")
def first_words(spark, sf_dir):
    return docs(spark, sf_dir).groupBy(F.lower(F.regexp_extract("text", "([A-Za-z]+)", 1)).alias("w")).agg(F.count(F.lit(1)).alias("n"))
