"""Joins, set operations, score maps, rankings and state over the relational tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pagemill.operators import documents as D, numbering
from pagemill.operators import joins, scores, setops
from pagemill.queries import query, table


def keyed(spark, sf_dir, name, key, value):
    return table(spark, sf_dir, name).select(F.col(key).cast("long").alias("k"), F.col(value).cast("string").alias("v"))


@query("SELECT c_custkey::BIGINT AS k, c_name || s_name AS v FROM customer JOIN supplier ON c_custkey = s_suppkey")
def map_join_concat(spark, sf_dir):
    return joins.map_join(keyed(spark, sf_dir, "customer", "c_custkey", "c_name"), keyed(spark, sf_dir, "supplier", "s_suppkey", "s_name"), "k", "v", concat=True)


@query("SELECT n_nationkey::BIGINT AS k, n_name || r_name || s_name AS v FROM nation JOIN region ON r_regionkey = n_nationkey JOIN supplier ON s_suppkey = n_nationkey")
def nway_join(spark, sf_dir):
    return joins.nway_join([keyed(spark, sf_dir, "nation", "n_nationkey", "n_name"), keyed(spark, sf_dir, "region", "r_regionkey", "r_name"), keyed(spark, sf_dir, "supplier", "s_suppkey", "s_name")], "k", "v", concat=True)


@query("SELECT c_custkey::BIGINT AS k FROM customer INTERSECT SELECT o_custkey::BIGINT FROM orders")
def set_intersect(spark, sf_dir):
    return joins.intersection(table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("k")), table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("long").alias("k")), "k")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders))")
def exclude_anti(spark, sf_dir):
    """Customers without an order above the mean."""
    o = table(spark, sf_dir, "orders")
    dear = o.join(F.broadcast(o.agg(F.avg("o_totalprice").alias("mean"))), F.col("o_totalprice") > F.col("mean"))  # of one row
    return joins.difference(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), dear.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


@query("SELECT count(*) = 0 AS included FROM (SELECT DISTINCT l_orderkey FROM lineitem) WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def inclusion_all(spark, sf_dir):
    return joins.included(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")), table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")), "k")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def inclusion_semi(spark, sf_dir):
    large = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(large, "o_orderkey", "left_semi")


@query("SELECT l_orderkey, bool_or(l_linestatus = 'O') AS any_open, bool_and(l_returnflag IN ('A', 'N', 'R')) AS all_known FROM lineitem GROUP BY l_orderkey")
def anymatch_arrays(spark, sf_dir):
    per = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_linestatus").alias("s"), F.collect_set("l_returnflag").alias("f"))
    return per.select("l_orderkey", F.arrays_overlap("s", F.array(F.lit("O"))).alias("any_open"), (F.size(F.array_except("f", F.array(*map(F.lit, "ANR")))) == 0).alias("all_known"))


@query("SELECT k, arg_min(v, s) AS v FROM (SELECT c_custkey::BIGINT AS k, c_name AS v, 0 AS s FROM customer UNION ALL SELECT s_suppkey, s_name, 1 FROM supplier) GROUP BY k")
def merge_union_first_wins(spark, sf_dir):
    return setops.merge_first_wins([keyed(spark, sf_dir, "customer", "c_custkey", "c_name"), keyed(spark, sf_dir, "supplier", "s_suppkey", "s_name")], "k", "v")


@query("SELECT c_custkey::BIGINT AS k, c_name AS v FROM customer UNION ALL SELECT s_suppkey::BIGINT, s_name FROM supplier")
def stack_union(spark, sf_dir):
    return setops.stack([keyed(spark, sf_dir, "customer", "c_custkey", "c_name"), None, keyed(spark, sf_dir, "supplier", "s_suppkey", "s_name")])


@query("SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id")
def uniq_last(spark, sf_dir):
    return setops.adjacent_unique(table(spark, sf_dir, "events").select("user_id", "event_id"), ["event_id"], "user_id")


@query("WITH s AS (SELECT n_name, row_number() OVER (ORDER BY n_name) - 1 AS n FROM nation) SELECT n_name, (r * 25 + n)::BIGINT AS position FROM s, range(0, 3) AS t(r) WHERE r * 25 + n < 60")
def rotate_limit(spark, sf_dir):
    return setops.rotate(table(spark, sf_dir, "nation").select("n_name"), [F.col("n_name")], 60)


@query("SELECT c_name FROM customer WHERE c_name <= (SELECT quantile_disc(c_name, 0.5) FROM customer) ORDER BY c_name DESC")
def reverse_scan(spark, sf_dir):
    """Names downwards from the one in the middle."""
    c = table(spark, sf_dir, "customer").select("c_name")
    middle = numbering.numbered(c, [F.col("c_name")], "n").where(F.col("n") == (c.count() + 1) // 2).first()["c_name"]
    return setops.from_key(c, "c_name", middle, up=False)


@query("WITH a AS (SELECT user_id AS key, value FROM events WHERE event_type = 'click' UNION ALL SELECT user_id, value * 10 FROM events WHERE event_type <> 'click') SELECT key, max(value) AS value FROM a WHERE value IS NOT NULL GROUP BY key")
def merge_by_function(spark, sf_dir):
    """Two tables whose values of a key are merged by a function of two values."""
    e = table(spark, sf_dir, "events").withColumnRenamed("user_id", "key")
    return setops.merge_equal([e.where("event_type = 'click'").select("key", "value"), e.where("event_type <> 'click'").select("key", (F.col("value") * 10).alias("value"))], "key", "value", max)


@query("WITH t AS (SELECT lang AS key, max_by(text, (length(text), text)) AS text FROM documents GROUP BY lang) SELECT key, text AS value FROM t")
def merge_longest_text(spark, sf_dir):
    """The longest text of each language; a key of very many rows is merged in each task first."""
    d = table(spark, sf_dir, "documents").select(F.col("lang").alias("key"), F.col("text").alias("value"))
    return setops.merge_equal([d, d.limit(0)], "key", "value", lambda a, b: max(a, b, key=lambda t: (len(t), t)))


EVENT_SCORES = "SELECT event_type AS element, count(*) AS score, min(event_id) AS arrival FROM events GROUP BY event_type"
USER_SCORES = "SELECT user_id AS element, count(*) AS score, min(event_id) AS arrival FROM events GROUP BY user_id"


def user_scores(spark, sf_dir):
    return scores.scores(table(spark, sf_dir, "events").withColumnRenamed("user_id", "element"), "element", "event_id")


@query(f"SELECT element, score, arrival, row_number() OVER (ORDER BY score DESC, arrival DESC) AS rank FROM ({EVENT_SCORES})")
def scoremap_rank(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumnRenamed("event_type", "element")
    return scores.ranked(scores.scores(e, "element", "event_id"))


@query(f"SELECT element, score, arrival, row_number() OVER (ORDER BY score DESC, arrival DESC) AS rank FROM ({USER_SCORES})")
def scoremap_rank_all(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumnRenamed("user_id", "element")
    return scores.ranked(scores.scores(e, "element", "event_id"))


@query("WITH s AS (SELECT event_id, user_id, row_number() OVER (ORDER BY user_id DESC, event_id) - 1 AS n, (SELECT count(*) FROM events) AS size FROM events) SELECT event_id, user_id, (r * size + n)::BIGINT AS position FROM s, range(0, 3) AS t(r) WHERE r * size + n < 2 * size + 77")
def rotate_all(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id")
    return setops.rotate(e, [F.col("user_id").desc(), F.col("event_id")], 2 * e.count() + 77)


@query("SELECT element, sum(score)::BIGINT AS score FROM (SELECT user_id AS element, count(*) AS score FROM events WHERE event_type = 'click' GROUP BY user_id UNION ALL SELECT user_id, count(*) FROM events WHERE event_type <> 'click' GROUP BY user_id) GROUP BY element")
def scoremap_merge(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumnRenamed("user_id", "element")
    return scores.merged([scores.scores(e.where(c), "element", "event_id") for c in ("event_type = 'click'", "event_type <> 'click'")], "element")


@query(f"WITH s AS ({USER_SCORES}) SELECT element, score, arrival FROM s WHERE score < (SELECT floor(avg(score)) FROM s)")
def lower_half(spark, sf_dir):
    return scores.lower_half(user_scores(spark, sf_dir))


@query(f"SELECT * FROM ({USER_SCORES}) WHERE score >= 12")
def shrink_min(spark, sf_dir):
    return scores.shrink_to_score(user_scores(spark, sf_dir), 12)


@query(f"WITH s AS ({USER_SCORES}), c AS (SELECT score, sum(count(*)) OVER (ORDER BY score DESC) AS n FROM s GROUP BY score) SELECT * FROM s WHERE score >= (SELECT min(score) FROM c WHERE n <= 50)")
def shrink_max(spark, sf_dir):
    return scores.shrink_to_size(user_scores(spark, sf_dir), 50)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def topk_global(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(100)


@query("SELECT o_custkey, o_orderkey, o_totalprice, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3")
def topk_per_group(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return D.top_per_group(o, "o_custkey", [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3)


@query("SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text, count(*) AS parts FROM conversations GROUP BY conv_id")
def merge_conversation(spark, sf_dir):
    return D.merge(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")


@query("SELECT o_orderkey, o_custkey, string_agg(l_partkey::VARCHAR, ',' ORDER BY l_linenumber, l_partkey::VARCHAR) AS parts FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey")
def fold_children(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_linenumber")  # noqa: E741
    return D.fold(o, l, "o_orderkey", "l_linenumber", F.col("l_partkey").cast("string"), "p").select("o_orderkey", "o_custkey", F.when(F.col("p").isNotNull(), F.array_join("p", ",")).alias("parts"))


@query("SELECT conv_id, turn, role FROM (SELECT *, max((contains(lower(text), 'the'))::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS hit FROM conversations) WHERE hit = 1")
def grep_context(spark, sf_dir):
    return D.grep(table(spark, sf_dir, "conversations"), "conv_id", "turn", F.lower("text").contains("the"), 1).select("conv_id", "turn", "role")


@query("SELECT user_id, arg_min(event_type, event_id) AS first_type FROM events GROUP BY user_id")
def first_per_group(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.min_by("event_type", "event_id").alias("first_type"))


@query("SELECT user_id, event_type AS third_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) WHERE r = 3")
def nth_value(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return e.withColumn("r", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))).where("r = 3").select("user_id", F.col("event_type").alias("third_type"))


@query("SELECT user_id, arg_max(event_type, event_id) AS status, max(event_id) AS event_id FROM events GROUP BY user_id")
def crawler_status_latest(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_type").alias("status"))
    return D.latest(e, "user_id", ["event_id"])


@query("SELECT source, sum(octet_length(encode(text)))::BIGINT AS bytes, count(*) AS n FROM documents GROUP BY source")
def bytes_by_account(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("n"))


@query("SELECT event_type, count(*) AS n, sum(value) AS total, min(value) AS least, max(value) AS most, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def grouped_aggregates(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.min("value").alias("least"), F.max("value").alias("most"), F.countDistinct("user_id").alias("users"))


@query("SELECT value % 100 AS k, count(*) AS n FROM (SELECT event_id AS value FROM events) GROUP BY k HAVING count(*) > 1")
def doubled_keys(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy((F.col("event_id") % 100).alias("k")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("SELECT c_custkey, c_name FROM customer ORDER BY lower(c_name), c_custkey")
def caseless_order(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name").orderBy(F.lower("c_name"), "c_custkey")


@query("SELECT user_id, array_to_string(list_sort(list(event_id))[-5:], ',') AS last_five FROM events GROUP BY user_id")
def bounded_history(spark, sf_dir):
    last = D.top_per_group(table(spark, sf_dir, "events").select("user_id", "event_id"), "user_id", [F.col("event_id").desc()], 5)
    return last.groupBy("user_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("event_id")), lambda x: x.cast("string")), ",").alias("last_five"))
