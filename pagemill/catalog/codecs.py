"""Codecs, times, points and structured values."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.functions import codec as C
from pagemill.functions import geo, phonetic, times
from pagemill.queries import load_time, query, table


@query("SELECT o_orderkey, (epoch_ms(o_orderdate) // 86400000 % 262144)::BIGINT AS days, (epoch_ms(o_orderdate) // 3600000 % 262144)::BIGINT AS hours FROM orders")
def microdate(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", times.microdate_days(F.col("o_orderdate")).cast("long").alias("days"), times.microdate_hours(F.col("o_orderdate")).cast("long").alias("hours"))


@query("SELECT event_id, date_trunc('second', ts) AS parsed FROM events")
def http_dates(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss 'GMT'").alias("s"))
    return e.select("event_id", times.http_date(F.col("s")).alias("parsed"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS text, date_trunc('second', ts) AS parsed, date_trunc('day', ts)::TIMESTAMP AS day FROM events")
def iso8601(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", times.iso8601_text(F.col("ts")).alias("text"), F.date_format("ts", "yyyy-MM-dd").alias("d"))
    return e.select("event_id", "text", times.iso8601(F.col("text")).alias("parsed"), times.iso8601(F.col("d")).alias("day"))


@query("SELECT event_id, epoch_ms(epoch_ms(TIMESTAMP '2024-01-01') + greatest(0, epoch_ms(TIMESTAMP '2024-01-01') - epoch_ms(ts)) // 2) AS fresh FROM events")
def fresh_date(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", times.fresh_until(load_time(), F.col("ts")).alias("fresh"))


B64 = "rtrim(translate(base64(encode(c_name)), '+/', '-_'), '=')"


@query(f"SELECT c_custkey, {B64} AS encoded, c_name AS decoded FROM customer")
def b64_codec(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", C.b64_encode(F.col("c_name")).alias("encoded"))
    return c.select("c_custkey", "encoded", C.b64_decode(F.col("encoded")).cast("string").alias("decoded"))


DIGITS = " + ".join(f"(instr('{C.URL_SAFE}', substring(h, {i}, 1)) - 1)::HUGEINT * {64 ** (10 - i)}" for i in range(1, 11))
HASHED = f"SELECT c_custkey, rpad(left(translate(base64(unhex(md5(c_name))), '+/', '-_'), 12), 12, 'A') AS h FROM customer"


@query(f"SELECT c_custkey, left(h, 12) AS h, ((({DIGITS}) * 8) + 7)::BIGINT AS cardinal, left(h, 10) AS back FROM ({HASHED})")
def b64_cardinal(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.left(C.b64_encode(F.unhex(F.md5("c_name"))), F.lit(12)).alias("h"))
    n = C.b64_cardinal(F.col("h"))
    return c.select("c_custkey", "h", n.alias("cardinal"), C.b64_uncardinal(n).alias("back"))


@query(f"SELECT c_custkey, (card >> 59)::BIGINT AS part, (CASE WHEN card >= 1000 THEN card - 1000 ELSE 9223372036854775807 - 1000 + card + 1 END)::BIGINT AS distance FROM (SELECT c_custkey, ((({DIGITS}) * 8) + 7)::BIGINT AS card FROM ({HASHED}))")
def dht_partition(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", C.b64_cardinal(C.b64_encode(F.unhex(F.md5("c_name")))).alias("n"))
    return c.select("c_custkey", C.vertical_partition(F.col("n"), 4).cast("long").alias("part"), C.ring_distance(F.lit(1000).cast("long"), F.col("n")).alias("distance"))


@query("SELECT c_custkey, (c_custkey | 16)::BIGINT AS with_bit, (c_custkey & 4) <> 0 AS bit2, (CASE WHEN c_custkey > 0 THEN floor(log2(c_custkey)) ELSE 0 END)::BIGINT AS log2 FROM customer")
def bitfield(spark, sf_dir):
    k = F.col("c_custkey").cast("long")
    return table(spark, sf_dir, "customer").select("c_custkey", C.bit_set(k, 4).alias("with_bit"), C.bit_get(k, 2).alias("bit2"), C.bit_length(k).cast("long").alias("log2"))


@query("SELECT c_custkey, lpad(hex(c_custkey), 16, '0') AS bytes FROM customer")
def big_endian(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", F.hex(C.big_endian(F.col("c_custkey"))).alias("bytes"))


@query("""SELECT custkey, array_to_string(list_transform(list_filter(list_zip(range(0, len(l)), l), lambda x: x[2] <> 'http'), lambda x: lpad(x[1]::VARCHAR, 3, '0') || '-' || x[2]), ',') AS indexed, array_to_string(l, ',') AS back
 FROM (SELECT o_custkey AS custkey, list(CASE WHEN o_orderkey % 3 = 0 THEN 'https' WHEN o_orderkey % 3 = 1 THEN 'http' ELSE 'ftp' END ORDER BY o_orderkey) AS l FROM orders GROUP BY o_custkey)""")
def protocol_list(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("custkey")).agg(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda k: F.when(k % 3 == 0, "https").when(k % 3 == 1, "http").otherwise("ftp")).alias("l"))
    i = C.protocol_list(F.col("l"))
    return o.select("custkey", F.array_join(i, ",").alias("indexed"), F.array_join(C.protocols_of(i, F.size("l")), ",").alias("back"))


STEP = "(360.0::DOUBLE / 2147483648)"


@query(f"SELECT n_nationkey, ((floor((n_nationkey * 7.0::DOUBLE - 80 + 90.0) / {STEP})::BIGINT << 32) | floor((n_nationkey * 14.0::DOUBLE - 170 + 180.0) / {STEP})::BIGINT)::BIGINT AS packed, n_nationkey * 7 - 80 AS lat FROM nation")
def geo_pack(spark, sf_dir):
    n = F.col("n_nationkey")
    p = table(spark, sf_dir, "nation").select("n_nationkey", geo.pack(n * F.lit(7.0) - 80, n * F.lit(14.0) - 170).alias("packed"))
    return p.select("n_nationkey", "packed", F.round(geo.latitude(F.col("packed"))).cast("int").alias("lat"))


@query()
def phonetic_codes(spark, sf_dir):
    w = table(spark, sf_dir, "part").select(F.explode(F.split("p_name", "[^A-Za-z]+")).alias("word")).where("word <> ''").distinct()
    w = w.withColumn("p", phonetic.codes("word"))
    return w.select("word", phonetic.soundex(F.col("word")).alias("soundex"), "p.*")


@query("SELECT event_id, json_extract_string(props, '$.' || json_keys(props)[1]) AS first_value, len(json_keys(props))::BIGINT AS keys FROM events")
def json_props(spark, sf_dir):
    keys = F.json_object_keys("props")
    m = F.from_json("props", "map<string,string>")
    return table(spark, sf_dir, "events").select("event_id", F.try_element_at(m, F.try_element_at(keys, F.lit(1))).alias("first_value"), F.size(keys).cast("long").alias("keys"))
