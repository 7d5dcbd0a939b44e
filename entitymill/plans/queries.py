"""Named queries on the supplied tables, each with the SQL that it equals where SQL can say it.

The tables hold no Japanese company data; where an operator needs such text, rows of the table pick
one of a list of examples by their key, so that every row of the table goes through the operator.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymill.functions import contact, names
from entitymill.operators import dedupe, fuzzy, mapping, merge, pages, periods, quality, reshape, resolve, upsert
from entitymill.plans import medallion
from entitymill.plans.registry import ORACLES, QUERIES, pick, query, sql_pick, table
from entitymill.scratch import new_folder as scratch
from entitymill.sources import readers, writers
from entitymill.streaming import jobs

#: A customer's segment with gaps: blank for some, null for others.
SQL_GAPS = "CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END"


def gaps() -> Column:
    return F.expr(SQL_GAPS)


# ---------------------------------------------------------------- scans, projection, dedupe


@query("SELECT user_id, event_id, ts, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1")
def latest_per_key(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return dedupe.latest(rows, ["user_id"], "ts", "event_id")


@query("SELECT e.user_id, e.event_id, e.ts, e.event_type FROM events e JOIN (SELECT user_id, max(ts) AS m FROM events GROUP BY user_id) x ON e.user_id = x.user_id AND e.ts = x.m")
def latest_max_joinback(spark, sf):
    return dedupe.latest_join_back(table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type"), "user_id", "ts")


@query(f"""SELECT c.c_custkey, o.o_orderkey, coalesce(nullif({SQL_GAPS}, ''), c.c_name) AS context
FROM customer c JOIN (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) o ON c.c_custkey = o.o_custkey""")
def latest_lookup_context(spark, sf):
    last = dedupe.latest(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], "o_orderdate", "o_orderkey")
    rows = table(spark, sf, "customer").join(last, F.col("c_custkey") == F.col("o_custkey"))
    return rows.select("c_custkey", "o_orderkey", merge.first_present(gaps(), F.col("c_name")).alias("context"))


@query("SELECT event_type, user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) = 1")
def first_seen_per_key(spark, sf):
    return dedupe.first_seen(table(spark, sf, "events").select("event_type", "user_id", "event_id"), ["event_type", "user_id"], "event_id")


@query("SELECT o_custkey, o_orderkey, o_totalprice, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3")
def topn_per_key(spark, sf):
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return dedupe.top_n(rows, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


@query("SELECT regexp_replace(split_part(url, '?', 1), '/+$', '') AS url_key, arg_min(url, page_id) AS url, min(page_id) AS page_id FROM pages GROUP BY 1")
def url_dedupe(spark, sf):
    """The first url of each that differs in query and last slashes only."""
    rows = table(spark, sf, "pages").select(dedupe.url_key(F.col("url")).alias("url_key"), "url", "page_id")
    return dedupe.first_seen(rows, ["url_key"], "page_id")


@query("""WITH s AS (SELECT event_id, event_id % 40 AS a, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 2 END AS n FROM events)
SELECT CAST(min(event_id) AS BIGINT) AS event_id, 0 AS part FROM s WHERE n = 1 GROUP BY a UNION ALL SELECT event_id, 1 FROM s WHERE n = 2""")
def snippet_dedupe(spark, sf):
    phone = F.col("event_id") % 40
    rows = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.array(phone)).otherwise(F.array(phone, phone + 1)).alias("phones"))
    return dedupe.snippets(rows, "phones", "event_id").select("event_id", "part")


@query("""WITH c AS (SELECT event_id AS pos, CASE WHEN event_id % 3 = 0 THEN 'phone' WHEN event_id % 3 = 1 THEN 'email' ELSE 'person' END AS kind,
 CASE WHEN event_id % 3 = 0 THEN (CASE WHEN user_id % 5 = 0 THEN NULL ELSE concat('03', lpad(CAST(user_id AS VARCHAR), 8, '0')) END)
 WHEN event_id % 3 = 1 THEN concat('u', CAST(user_id AS VARCHAR), '@x.jp') ELSE concat('n', CAST(user_id AS VARCHAR), '_None') END AS k FROM events)
SELECT kind, k AS contact, CAST(min(pos) AS BIGINT) AS pos FROM c WHERE k IS NOT NULL GROUP BY kind, k""")
def contact_merge(spark, sf):
    u = F.col("user_id").cast("string")
    kind = F.when(F.col("event_id") % 3 == 0, "phone").when(F.col("event_id") % 3 == 1, "email").otherwise("person")
    raw = F.when(kind == "phone", F.when(F.col("user_id") % 5 == 0, "12-34").otherwise(F.concat(F.lit("03-"), F.lpad(u, 8, "0")))).when(kind == "email", F.concat(F.lit("U"), u, F.lit("@X.jp"))).otherwise(F.concat(F.lit("n"), u))
    value = F.when(kind == "phone", contact.phone_digits(raw)).when(kind == "email", F.lower(raw)).otherwise(F.concat_ws("_", raw, F.lit("None")))
    rows = table(spark, sf, "events").select("event_id", "user_id")
    return dedupe.contact_results(rows, kind, value, "event_id").select(F.col("_kind").alias("kind"), F.col("_key").alias("contact"), F.col("event_id").alias("pos"))


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 100")
def ordered_limit(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name").orderBy("c_custkey").limit(100)


# ---------------------------------------------------------------- merge


@query("""WITH o AS (SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY o_custkey)
SELECT c.c_custkey, coalesce(nullif(CASE WHEN c.c_custkey % 7 = 0 THEN '' WHEN c.c_custkey % 11 = 0 THEN NULL ELSE c.c_mktsegment END, ''), nullif(s.s_name, ''), n.n_name) AS segment, n.n_name AS nation, o.priorities
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN supplier s ON s.s_suppkey = c.c_custkey LEFT JOIN o ON o.o_custkey = c.c_custkey""")
def source_priority_merge(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey", gaps().alias("own"))
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("c_custkey"), "s_name")
    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(merge.distinct_list(F.col("o_orderpriority")).alias("priorities"))
    rows = customers.join(nations, "c_nationkey", "left").join(suppliers, "c_custkey", "left").join(orders, "c_custkey", "left")
    return rows.select("c_custkey", merge.first_present(F.col("own"), F.col("s_name"), F.col("nation")).alias("segment"), "nation", "priorities")


@query("SELECT o_custkey, string_agg(DISTINCT o_orderstatus, ', ' ORDER BY o_orderstatus) AS statuses FROM orders GROUP BY o_custkey")
def email_style_listagg(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(merge.distinct_list(F.col("o_orderstatus")).alias("statuses"))


_MEDIA = ("alpha", "beta", "gamma")


@query("""WITH v AS (SELECT user_id AS entity, ['alpha', 'beta', 'gamma'][CAST(event_id % 3 + 1 AS INTEGER)] AS media, event_type AS canonical, CASE WHEN event_id % 5 = 0 THEN '-' WHEN event_id % 7 = 0 THEN ' ' ELSE CAST(event_id AS VARCHAR) END AS value, event_id AS media_pos FROM events),
p AS (SELECT * FROM (VALUES ('click', 'beta', 0), ('click', 'alpha', 1), ('view', 'gamma', 0)) t(canonical, media, priority))
SELECT v.entity, v.canonical, v.value, v.media FROM v LEFT JOIN p ON v.canonical = p.canonical AND v.media = p.media WHERE trim(v.value) NOT IN ('', '-', 'null', 'なし')
QUALIFY row_number() OVER (PARTITION BY v.entity, v.canonical ORDER BY coalesce(p.priority, 1000 + v.media_pos), v.media_pos) = 1""")
def media_priority_merge(spark, sf):
    value = F.when(F.col("event_id") % 5 == 0, "-").when(F.col("event_id") % 7 == 0, " ").otherwise(F.col("event_id").cast("string"))
    rows = table(spark, sf, "events").select(F.col("user_id").alias("entity"), pick(list(_MEDIA), "event_id").alias("media"), F.col("event_type").alias("canonical"), value.alias("value"), F.col("event_id").alias("media_pos"))
    priority = spark.createDataFrame([("click", "beta", 0), ("click", "alpha", 1), ("view", "gamma", 0)], "canonical string, media string, priority int")
    return merge.media_priority(rows, priority)


@query(f"SELECT c_custkey, coalesce(nullif({SQL_GAPS}, ''), c_name, {SQL_GAPS}) AS segment FROM customer")
def fill_missing_only(spark, sf):
    old = table(spark, sf, "customer").select("c_custkey", gaps().alias("segment"))
    new = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("segment"))
    return merge.fill_missing(old, new, "c_custkey", ["segment"])


@query("""SELECT a, b, CAST('scraping' AS VARCHAR) AS source, CAST(NULL AS TIMESTAMP) AS confirmed_at FROM (
SELECT o_orderkey AS a, o_custkey AS b FROM orders WHERE o_orderkey % 2 = 0 UNION SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 3 = 0)""")
def relation_union_distinct(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("a"), F.col("o_custkey").alias("b"))
    pairs = merge.edges(rows.where("a % 2 = 0"), rows.where("a % 3 = 0"), "a", "b")
    return pairs.select("a", "b", F.lit("scraping").alias("source"), F.lit(None).cast("timestamp").alias("confirmed_at"))


# ---------------------------------------------------------------- resolve


@query("""WITH d AS (SELECT c_custkey AS id, lower(c_name) AS k FROM customer), q AS (SELECT DISTINCT CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE concat(c_name, CASE WHEN c_custkey % 3 = 0 THEN ' x' ELSE '' END) END AS name FROM customer)
SELECT q.name, d.id FROM q LEFT JOIN d ON lower(q.name) = d.k""")
def resolve_exact_then_norm(spark, sf):
    c = table(spark, sf, "customer")
    dim = c.select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 5 == 0, F.lower("c_name")).otherwise(F.col("c_name")).alias("name_normalized"))
    asked = c.select(F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise(F.concat("c_name", F.when(F.col("c_custkey") % 3 == 0, " x").otherwise(""))).alias("name")).distinct()
    return resolve.cascade(asked, dim, F.lower)


@query("""WITH d AS (SELECT p_name AS k, min(p_partkey) AS id FROM part GROUP BY p_name), q AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS name FROM part)
SELECT q.name, arg_min(d.id, (d.k, d.id)) AS id FROM q LEFT JOIN d ON starts_with(d.k, q.name) GROUP BY q.name""")
def resolve_prefix(spark, sf):
    parts = table(spark, sf, "part")
    dim = parts.groupBy(F.col("p_name").alias("name_normalized")).agg(F.min("p_partkey").alias("id"))
    return resolve.by_prefix(parts.select(F.substring_index("p_name", " ", 1).alias("name")).distinct(), dim)


@query("""WITH d AS (SELECT p_name AS k, min(p_partkey) AS id FROM part GROUP BY p_name), q AS (SELECT DISTINCT right(p_name, 5) AS name FROM part)
SELECT q.name, min(d.id) AS id FROM q JOIN d ON contains(d.k, q.name) GROUP BY q.name""")
def resolve_contains(spark, sf):
    parts = table(spark, sf, "part")
    dim = parts.groupBy(F.col("p_name").alias("name_normalized")).agg(F.min("p_partkey").alias("id"))
    return resolve.containing(parts.select(F.right("p_name", F.lit(5)).alias("name")).distinct(), dim)


@query("""WITH d AS (SELECT c_custkey AS id, c_name AS k FROM customer), q AS (SELECT DISTINCT CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 THEN right(c_name, 5) ELSE upper(c_name) END AS name FROM customer)
SELECT q.name, coalesce(e.id, i.id, n.id) AS id FROM q LEFT JOIN d e ON e.k = q.name
LEFT JOIN (SELECT q.name, min(d.id) AS id FROM q JOIN d ON contains(d.k, q.name) GROUP BY q.name) i ON i.name = q.name LEFT JOIN (SELECT lower(k) AS k, max(id) AS id FROM d GROUP BY 1) n ON n.k = lower(q.name)""")
def resolve_three_stages(spark, sf):
    c = table(spark, sf, "customer")
    asked = c.select(F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).when(F.col("c_custkey") % 3 == 1, F.right("c_name", F.lit(5))).otherwise(F.upper("c_name")).alias("name")).distinct()
    return resolve.three_stages(asked, c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name_normalized")), F.lower)


@query("""WITH x AS (SELECT p_partkey, p_partkey + 1 AS a, p_partkey + 2 AS b FROM part)
SELECT x.p_partkey, concat('n', x.a) AS rival1, concat('n', x.b) AS rival2, pa.p_partkey AS rival1_id, pb.p_partkey AS rival2_id FROM x LEFT JOIN part pa ON pa.p_partkey = x.a LEFT JOIN part pb ON pb.p_partkey = x.b""")
def competitor_ids(spark, sf):
    p = table(spark, sf, "part").select("p_partkey")
    name = lambda c: F.concat(F.lit("n"), c.cast("string"))
    rows = p.select("p_partkey", name(F.col("p_partkey") + 1).alias("rival1"), name(F.col("p_partkey") + 2).alias("rival2"))
    return reshape.names_to_ids(rows, "p_partkey", ["rival1", "rival2"], p.select(name(F.col("p_partkey")).alias("name"), F.col("p_partkey").alias("id")))


# ---------------------------------------------------------------- sets, reshaping


@query("""SELECT service, user_id, event_id FROM (SELECT CAST('a' AS VARCHAR) AS service, * FROM events WHERE event_type = 'click' UNION ALL SELECT 'b', * FROM events WHERE event_type = 'view')
JOIN customer ON user_id = c_custkey QUALIFY row_number() OVER (PARTITION BY service, user_id ORDER BY ts DESC, event_id DESC) = 1""")
def union_services(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    rows = reshape.union_services({"a": e.where("event_type = 'click'"), "b": e.where("event_type = 'view'")})
    rows = dedupe.latest(rows, ["service", "user_id"], "ts", "event_id")
    return rows.join(table(spark, sf, "customer"), F.col("user_id") == F.col("c_custkey"), "left_semi").select("service", "user_id", "event_id")


@query("SELECT event_id, 'k' AS name, json_extract_string(props, '$.k') AS value FROM events")
def json_expand(spark, sf):
    return reshape.json_long(table(spark, sf, "events"), "event_id", "props")


@query("""SELECT user_id, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) FILTER (event_type = 'click') AS BIGINT) AS click, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) FILTER (event_type = 'view') AS BIGINT) AS "view" FROM events WHERE event_type IN ('click', 'view') GROUP BY user_id""")
def json_expand_pivot(spark, sf):
    e = table(spark, sf, "events").where(F.col("event_type").isin("click", "view"))
    long = e.select("user_id", F.col("event_type").alias("name"), F.from_json("props", "map<string,string>")["k"].cast("long").alias("value"))
    return long.groupBy("user_id").pivot("name", ["click", "view"]).agg(F.sum("value"))


_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("SELECT user_id, " + ", ".join(f"""CAST(max(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END) AS INTEGER) AS "{t}\"""" for t in _TYPES) + " FROM events GROUP BY user_id")
def presence_matrix(spark, sf):
    return reshape.presence(table(spark, sf, "events"), "user_id", "event_type", _TYPES)


@query("SELECT p_partkey, split_part(p_name, ' ', 1) AS level1, split_part(p_name, ' ', 2) AS level2, split_part(p_name, ' ', 3) AS level3, split_part(p_name, ' ', 4) AS level4, split_part(p_name, ' ', 5) AS level5 FROM part")
def level_columns(spark, sf):
    return table(spark, sf, "part").select("p_partkey", *reshape.levels(F.split("p_name", " "), 5))


@query("SELECT DISTINCT o_custkey AS k FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0")
def key_difference(spark, sf):
    keys = table(spark, sf, "orders").select(F.col("o_custkey").alias("k")).distinct()
    return keys.join(table(spark, sf, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k")), "k", "left_anti")


@query("""SELECT n_name, r_name, page_id FROM nation CROSS JOIN region LEFT JOIN (
SELECT CAST(regexp_extract(url, '/([0-9]+)', 1) AS BIGINT) % 125 AS slot, min(page_id) AS page_id FROM pages GROUP BY 1) p ON p.slot = n_nationkey * 5 + r_regionkey""")
def search_grid_first_match(spark, sf):
    regions = [r.r_regionkey for r in table(spark, sf, "region").collect()]  # 5 rows
    grid = reshape.grid(table(spark, sf, "nation"), "r_regionkey", regions).join(table(spark, sf, "region"), "r_regionkey")
    slot = F.regexp_extract("url", "/([0-9]+)", 1).cast("long") % 125
    first = table(spark, sf, "pages").groupBy(slot.alias("slot")).agg(F.min("page_id").alias("page_id"))
    return grid.withColumn("slot", F.col("n_nationkey") * 5 + F.col("r_regionkey")).join(first, "slot", "left").select("n_name", "r_name", "page_id")


# ---------------------------------------------------------------- upserts and validation


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_custkey, upper(c_name) FROM customer WHERE c_custkey % 3 = 0")
def upsert_overwrite(spark, sf):
    old = table(spark, sf, "customer").select("c_custkey", "c_name")
    return upsert.overwrite_rows(old, old.where("c_custkey % 3 = 0").withColumn("c_name", F.upper("c_name")), "c_custkey")


@query("""WITH m AS (SELECT concat('n', n_nationkey) AS name, CASE WHEN n_nationkey % 2 = 0 THEN '' ELSE concat('s', n_nationkey) END AS stock_code FROM nation),
r AS (SELECT concat('n', o_custkey % 60) AS name, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE concat('c', o_orderkey) END AS code, o_orderkey AS pos FROM orders), n AS (SELECT name, arg_min(code, pos) FILTER (code IS NOT NULL) AS code FROM r GROUP BY name)
SELECT coalesce(m.name, n.name) AS name, coalesce(nullif(m.stock_code, ''), n.code) AS stock_code FROM m FULL JOIN n ON m.name = n.name""")
def company_upsert(spark, sf):
    key = F.col("n_nationkey").cast("string")
    master = table(spark, sf, "nation").select(F.concat(F.lit("n"), key).alias("name"), F.when(F.col("n_nationkey") % 2 == 0, "").otherwise(F.concat(F.lit("s"), key)).alias("stock_code"))
    rows = table(spark, sf, "orders").select(F.concat(F.lit("n"), (F.col("o_custkey") % 60).cast("string")).alias("name"), F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("c"), F.col("o_orderkey").cast("string"))).alias("stock_code"), F.col("o_orderkey").alias("pos"))
    return upsert.company_upsert(master, rows)


@query("""WITH s AS (SELECT DISTINCT user_id AS company, 0 AS number, CASE WHEN user_id % 2 = 0 THEN '該当' ELSE '未確認' END AS status, -1 AS pos FROM events),
r AS (SELECT user_id AS company, CAST(event_id % 4 AS INTEGER) AS number, CASE event_type WHEN 'click' THEN '該当' WHEN 'view' THEN 'AI対応' WHEN 'error' THEN '?' ELSE '未確認' END AS status, event_id AS pos FROM events),
a AS (SELECT * FROM s UNION ALL SELECT company, number, CASE WHEN status = '?' THEN '未確認' ELSE status END, pos FROM r)
SELECT company, number, coalesce(arg_min(status, pos) FILTER (status <> '未確認'), '未確認') AS status FROM a GROUP BY company, number""")
def phone_status_transition(spark, sf):
    e = table(spark, sf, "events")
    stored = e.select(F.col("user_id").alias("company"), F.lit(0).alias("number")).distinct().withColumn("status", F.when(F.col("company") % 2 == 0, "該当").otherwise(upsert.UNKNOWN))
    status = F.when(F.col("event_type") == "click", "該当").when(F.col("event_type") == "view", "AI対応").when(F.col("event_type") == "error", "?").otherwise(upsert.UNKNOWN)
    rows = e.select(F.col("user_id").alias("company"), (F.col("event_id") % 4).cast("int").alias("number"), status.alias("status"), F.col("event_id").alias("pos"))
    return upsert.phone_upsert(stored, rows)


@query("SELECT user_id, arg_max(event_type, event_id) FILTER (event_type <> 'view') AS status, arg_max(CAST(event_id AS VARCHAR), event_id) FILTER (event_type = 'click') AS status_detail, CAST(count(*) AS BIGINT) AS n_calls FROM events GROUP BY user_id")
def call_effects_last_write(spark, sf):
    status = F.when(F.col("event_type") == "view", upsert.UNKNOWN).otherwise(F.col("event_type"))
    rows = table(spark, sf, "events").select("user_id", status.alias("status"), F.when(F.col("event_type") == "click", F.col("event_id").cast("string")).otherwise("").alias("memo"), "event_id")
    return upsert.call_effects(rows, ["user_id"], "event_id")


@query("""WITH c AS (SELECT user_id AS company, event_id AS pos, CASE WHEN event_id % 3 = 0 THEN concat('a', event_id % 7) ELSE '' END AS a, CASE WHEN event_id % 5 = 0 THEN concat('a', event_id % 7) WHEN event_id % 5 = 1 THEN concat('b', event_id % 7) END AS b FROM events),
p AS (SELECT company, pos, 0 AS i, a AS name, '中途・新卒採用担当' AS role FROM c WHERE a <> '' AND a = b UNION ALL
 SELECT company, pos, 0, a, '中途採用担当' FROM c WHERE a <> '' AND (b IS NULL OR a <> b) UNION ALL SELECT company, pos, 1, b, '新卒採用担当' FROM c WHERE b IS NOT NULL AND (a = '' OR a <> b))
SELECT company, name, arg_max(role, (pos, i)) AS role FROM p GROUP BY company, name""")
def person_roles(spark, sf):
    k = (F.col("event_id") % 7).cast("string")
    rows = table(spark, sf, "events").select(
        F.col("user_id").alias("company"), F.col("event_id").alias("pos"), F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("a"), k)).otherwise("").alias("discovered_person_chuto"),
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("a"), k)).when(F.col("event_id") % 5 == 1, F.concat(F.lit("b"), k)).alias("discovered_person_shinsotsu"),
    )
    return upsert.person_roles(rows, "pos")


@query("""WITH r AS (SELECT p_name, nullif(p_brand, 'Brand#13') AS brand, min(p_partkey) AS pos FROM part GROUP BY 1, 2)
SELECT r.p_name, r.brand, r.pos FROM r WHERE NOT EXISTS (SELECT 1 FROM part s WHERE s.p_partkey % 2 = 0 AND s.p_name IS NOT DISTINCT FROM r.p_name AND nullif(s.p_brand, 'Brand#13') IS NOT DISTINCT FROM r.brand)""")
def insert_if_absent(spark, sf):
    rows = table(spark, sf, "part").select("p_name", F.nullif("p_brand", F.lit("Brand#13")).alias("brand"), F.col("p_partkey").alias("pos"))
    return upsert.insert_absent(rows.where("pos % 2 = 0"), rows, ["p_name", "brand"], "pos")


_TIMES = ["2025-01-15 14:30", "2025/1/5 4:03", "2025-01-15 14:30:09", "2025/01/15 14:30:09", "2025-01-15", "2025/1/5", "15.01.2025", ""]


@query(f"SELECT o_orderkey, try_strptime(nullif({sql_pick(_TIMES, 'o_orderkey')}, ''), ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d %H:%M', '%Y/%m/%d %H:%M:%S', '%Y/%m/%d %H:%M', '%Y-%m-%d', '%Y/%m/%d']) AS called_at FROM orders")
def call_times(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", upsert.call_time(pick(_TIMES, "o_orderkey")).alias("called_at"))


@query(f"""WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN ' ' ELSE 'c' END AS company_name, {sql_pick(_TIMES, 'o_orderkey')} AS t, {sql_pick(['該当', '?', 'AI対応'], 'o_orderkey')} AS s, {sql_pick(['アポ', '', '?', None], 'o_orderkey')} AS res FROM orders)
SELECT o_orderkey, CASE WHEN trim(company_name) = '' THEN '必須列 ''company_name'' が空です' WHEN trim(t) = '' THEN '必須列 ''called_at'' が空です' WHEN t = '15.01.2025' THEN 'called_at の日時形式が不正です: ''15.01.2025'' (例: 2025-01-15 14:30)'
WHEN s = '?' THEN 'phone_status が不正です: ''?'' (許容値: {', '.join(upsert.PHONE_STATUS[1:])})' WHEN res = '?' THEN 'call_result が不正です: ''?'' (許容値: {', '.join(upsert.CALL_RESULT)})' END AS error FROM r""")
def validate_rows(spark, sf):
    o = table(spark, sf, "orders")
    rows = o.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 9 == 0, " ").otherwise("c").alias("company_name"), F.lit("r").alias("sales_rep_name"), pick(_TIMES, "o_orderkey").alias("called_at"), F.lit("03").alias("phone_number"),
        pick(["該当", "?", "AI対応"], "o_orderkey").alias("phone_status"), pick(["アポ", "", "?", None], "o_orderkey").alias("call_result"),
    )
    return upsert.validate_calls(rows).select("o_orderkey", "error")


@query("SELECT CASE WHEN o_orderkey % 9 = 0 THEN 'error' WHEN o_custkey % 2 = 0 THEN 'updated' ELSE 'inserted' END AS outcome, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1")
def import_outcomes(spark, sf):
    return upsert.outcomes(table(spark, sf, "orders"), F.when(F.col("o_orderkey") % 9 == 0, "error").when(F.col("o_custkey") % 2 == 0, "updated").otherwise("inserted"))


# ---------------------------------------------------------------- aggregates and quality

_RATE = "CAST(round_even(CAST(filled_count AS DOUBLE) / total_count, 4) AS DOUBLE)"


@query(f"""WITH c AS (SELECT *, {SQL_GAPS} AS segment FROM customer), n AS (SELECT CAST(count(*) AS BIGINT) AS t, CAST(count(*) FILTER (segment <> '') AS BIGINT) AS a, CAST(count(*) FILTER (c_name <> '') AS BIGINT) AS b FROM c),
u AS (SELECT 'segment' AS field_name, a AS filled_count, t AS total_count FROM n UNION ALL SELECT 'c_name', b, t FROM n)
SELECT 'customer' AS table_name, field_name, filled_count, total_count, {_RATE} AS fill_rate FROM u""")
def fill_rate(spark, sf):
    return quality.fill_rates(table(spark, sf, "customer").select("c_name", gaps().alias("segment")), "customer")


@query(f"SELECT c_custkey, CAST((c_name <> '')::INTEGER + coalesce(({SQL_GAPS} <> '')::INTEGER, 0) AS BIGINT) AS filled_fields, CAST(round_even(((c_name <> '')::INTEGER + coalesce(({SQL_GAPS} <> '')::INTEGER, 0)) / 2.0, 4) AS DOUBLE) AS fill_rate FROM customer")
def coverage_by_entity(spark, sf):
    return quality.coverage_by_entity(table(spark, sf, "customer").select("c_custkey", "c_name", gaps().alias("segment")), "c_custkey", ["c_name", "segment"])


@query(f"""WITH c AS (SELECT c_nationkey, max(coalesce(({SQL_GAPS} <> '')::INTEGER, 0)) AS s FROM customer GROUP BY 1)
SELECT 'segment' AS field, CAST(sum(s) AS BIGINT) AS filled_entities, CAST(round_even(CAST(sum(s) AS DOUBLE) / count(*), 4) AS DOUBLE) AS fill_rate FROM c""")
def coverage_by_field(spark, sf):
    return quality.coverage_by_field(table(spark, sf, "customer").select("c_nationkey", gaps().alias("segment")), "c_nationkey", ["segment"])


@query("SELECT o_orderstatus AS status, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1")
def status_counts(spark, sf):
    return table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))


@query("SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT o_custkey) AS BIGINT) AS customers, max(o_orderdate) AS newest FROM orders")
def distinct_counts(spark, sf):
    return table(spark, sf, "orders").agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("customers"), F.max("o_orderdate").alias("newest"))


@query("SELECT event_type, CAST(count(*) FILTER (value > 10) AS BIGINT) AS found, CAST(count(*) AS BIGINT) AS total, CAST(round_even(CAST(count(*) FILTER (value > 10) AS DOUBLE) / count(*), 4) AS DOUBLE) AS rate FROM events GROUP BY 1")
def media_rates(spark, sf):
    found = F.count_if(F.col("value") > 10)
    return table(spark, sf, "events").groupBy("event_type").agg(found.alias("found"), F.count("*").alias("total"), F.bround(found / F.count("*"), 4).alias("rate"))


@query("""WITH u AS (SELECT user_id, max((event_type = 'click')::INTEGER) AS a, max((event_type = 'error')::INTEGER) AS b, max((event_type = 'signup')::INTEGER) AS c FROM events GROUP BY 1)
SELECT CAST(sum(a) AS BIGINT) AS with_phone, CAST(sum(c) AS BIGINT) AS with_person, CAST(sum(b) AS BIGINT) AS with_email, CAST(count(*) FILTER (a = 1 OR b = 1 OR c = 1) AS BIGINT) AS with_any FROM u""")
def contact_summary(spark, sf):
    e = table(spark, sf, "events")
    phones, people, mails = (e.where(F.col("event_type") == t) for t in ("click", "signup", "error"))
    return quality.contact_summary(phones, people, mails, "user_id")


@query("SELECT o_custkey, CAST(count(*) AS INTEGER) AS n, string_agg(concat(o_orderkey, ':', o_orderstatus), '; ' ORDER BY o_orderkey) AS listed FROM orders GROUP BY 1")
def array_measures(spark, sf):
    rows = table(spark, sf, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus"))).alias("a"))
    return rows.select("o_custkey", F.size("a").alias("n"), F.array_join(F.transform("a", lambda x: F.concat_ws(":", x["o_orderkey"].cast("string"), x["o_orderstatus"])), "; ").alias("listed"))


@query("""WITH m AS (SELECT l_returnflag, date_trunc('month', l_shipdate) AS period, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2), g AS (SELECT l_returnflag, period, q, lag(q) OVER (PARTITION BY l_returnflag ORDER BY period) AS b FROM m)
SELECT l_returnflag, period, round((q - b) / abs(b) * 100, 6) AS growth_pct FROM g WHERE b IS NOT NULL AND b <> 0""")
def growth_pct(spark, sf):
    m = table(spark, sf, "lineitem").groupBy("l_returnflag", F.date_trunc("month", "l_shipdate").alias("period")).agg(F.sum("l_quantity").alias("q"))
    return periods.growth(m, ["l_returnflag"], "period", "q").withColumn("growth_pct", F.round("growth_pct", 6))


@query("""WITH e AS (SELECT user_id, CAST(event_id / 50 AS BIGINT) + 0 AS page FROM (SELECT user_id, event_id - event_id % 50 AS event_id FROM events)), f AS (SELECT user_id, min(page) AS m FROM e GROUP BY 1)
SELECT CAST(floor((page - 1) / 20.0) AS BIGINT) AS block, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (page = m) AS BIGINT) AS n_new FROM e JOIN f USING (user_id) GROUP BY 1""")
def new_rate_blocks(spark, sf):
    return periods.new_rate(table(spark, sf, "events").select("user_id", F.floor(F.col("event_id") / 50).alias("page")), "user_id", "page")


@query("""WITH s AS (SELECT event_type, event_id // 500 AS page, list_sort(list_distinct(list(user_id % 3))) AS l FROM events GROUP BY 1, 2)
SELECT event_type, page, coalesce(l = lag(l) OVER (PARTITION BY event_type ORDER BY page), false) AS repeats FROM s""")
def repeated_page_sets(spark, sf):
    rows = table(spark, sf, "events").select("event_type", F.floor(F.col("event_id") / 500).alias("page"), (F.col("user_id") % 3).alias("u"))
    return periods.repeated_pages(rows, ["event_type"], "page", "u")


@query("SELECT CAST(user_id AS BIGINT) AS user_id, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS snippet_id FROM events")
def running_ids(spark, sf):
    return periods.running_id(table(spark, sf, "events").select("user_id", "event_id", "ts"), ["user_id"], "ts", "event_id").drop("ts")


# ---------------------------------------------------------------- exports


@query("""SELECT o.o_orderkey AS deal_id, c.c_name AS company_name, n.n_name AS nation, o.o_orderstatus AS status, CASE WHEN o.o_custkey % 5 = 0 THEN '' ELSE CAST(o.o_custkey % 5 AS VARCHAR) END AS priority, strftime(o.o_orderdate, '%Y-%m-%d %H:%M') AS created_at
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def export_deals(spark, sf):
    c = table(spark, sf, "customer").join(F.broadcast(table(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey"), "left")  # 25 nations
    rows = table(spark, sf, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("deal_id"), F.col("c_name").alias("company_name"), F.col("n_name").alias("nation"), F.col("o_orderstatus").alias("status"), (F.col("o_custkey") % 5).alias("priority"), F.to_timestamp("o_orderdate").alias("created_at"))
    return writers.shown(rows, ["company_name", "nation", "status", "priority", "created_at"], keep=["deal_id"])


@query("""SELECT l.l_orderkey, c.c_name AS company_name, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(p.p_partkey) AS BIGINT) AS n_parts, CAST(count(s.s_suppkey) AS BIGINT) AS n_suppliers
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN part p ON p.p_partkey = l.l_partkey AND p.p_size > 10 LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey AND s.s_acctbal > 0 GROUP BY 1, 2""")
def export_call_logs(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    orders = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_name").alias("company_name"))
    p = table(spark, sf, "part").where("p_size > 10").select("p_partkey")
    s = table(spark, sf, "supplier").where("s_acctbal > 0").select("s_suppkey")
    rows = lines.join(p, F.col("l_partkey") == F.col("p_partkey"), "left").join(s, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    counts = rows.groupBy("l_orderkey").agg(F.count("*").alias("n_lines"), F.count("p_partkey").alias("n_parts"), F.count("s_suppkey").alias("n_suppliers"))
    return counts.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "company_name", "n_lines", "n_parts", "n_suppliers")


@query("SELECT c_custkey, regexp_replace(concat(lpad(CAST(c_nationkey AS VARCHAR), 2, '0'), ':', c_mktsegment), '^[0-9]{2}:', '') AS region FROM customer")
def region_code_strip(spark, sf):
    coded = F.concat(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit(":"), F.col("c_mktsegment"))
    return table(spark, sf, "customer").select("c_custkey", names.without_region_code(coded).alias("region"))


# ---------------------------------------------------------------- contacts and pages


@query(r"""WITH d AS (SELECT doc_id, list_transform(regexp_extract_all(text, '[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}'), lambda x: lower(x)) AS l FROM documents), e AS (SELECT DISTINCT doc_id, unnest(l) AS address FROM d)
SELECT doc_id, address, CASE WHEN regexp_matches(split_part(address, '@', 1), 'recruit|saiyou|saiyo') THEN 'recruit' WHEN regexp_matches(split_part(address, '@', 1), 'hr|jinji|career') THEN 'hr' WHEN regexp_matches(split_part(address, '@', 1), 'info|contact|inquiry') THEN 'info' ELSE 'other' END AS keyword_hint FROM e""")
def extract_emails(spark, sf):
    docs = table(spark, sf, "documents").where(F.contains("text", F.lit("@")))
    return docs.select("doc_id", F.explode(contact.emails(F.col("text"))).alias("e")).select("doc_id", "e.address", "e.keyword_hint")


@query("SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title FROM pages")
def page_titles(spark, sf):
    return pages.titles(table(spark, sf, "pages"))


@query("""WITH p AS (SELECT page_id, regexp_extract_all(html, '(?i)<a\\s[^>]*href="([^"]*)"', 1) AS l FROM pages)
SELECT page_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS href FROM p""")
def page_links(spark, sf):
    return pages.links(table(spark, sf, "pages"))


@query("SELECT id FROM (SELECT DISTINCT unnest(regexp_extract_all(url, '/(\\d+)', 1)) AS id FROM pages) ORDER BY CAST(id AS BIGINT)")
def url_ids(spark, sf):
    return readers.sitemap_ids(table(spark, sf, "pages"), "url", r"/(\d+)")


@query()
def fuzzy_clusters(spark, sf):
    return fuzzy.clusters(fuzzy.similar_pairs(table(spark, sf, "part").select(F.col("p_name").alias("name"))))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS company, CAST(row_number() OVER (PARTITION BY c_custkey ORDER BY q, r) - 1 AS INTEGER) AS snippet_id, concat(c_name, ' ', repeat('s', CAST(r * 4 AS INTEGER))) AS text
FROM customer, (SELECT unnest([1, 2]) AS q), (SELECT unnest([0, 1, 2]) AS r) WHERE length(concat(c_name, ' ', repeat('s', CAST(r * 4 AS INTEGER)))) - CASE WHEN r = 0 THEN 1 ELSE 0 END >= 20""")
def search_snippets(spark, sf):
    ranks = F.explode(F.sequence(F.lit(0), F.lit(2)))
    rows = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("company"), F.col("c_name").alias("title"), F.explode(F.array(F.lit(1), F.lit(2))).alias("query_no")).withColumn("rank", ranks)
    rows = rows.withColumn("snippet", F.expr("repeat('s', rank * 4)")).withColumn("link", F.lit(""))
    return readers.search_snippets(rows).select("company", "snippet_id", "text")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS name, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 4 AS INTEGER) END AS priority FROM events")
def stored_answers(spark, sf):
    key = F.col("event_id").cast("string")
    fenced = F.concat(F.lit('```json\n{"name": "'), key, F.lit('", "priority": '), (F.col("event_id") % 4).cast("string"), F.lit("}\n```"))
    rows = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, "no json").otherwise(fenced).alias("answer"))
    return readers.extracted(rows, "answer", "name string, priority int").select("event_id", "answer.name", "answer.priority")


@query("""WITH m AS (SELECT user_id AS entity, 'm' AS media, event_type AS canonical, CAST(max(event_id) AS VARCHAR) AS value FROM events WHERE event_type <> 'view' GROUP BY 1, 3),
s AS (SELECT DISTINCT user_id AS entity, 'm' AS media, t AS canonical, 's' AS value FROM events, (SELECT unnest(['click', 'view', 'zzz']) AS t))
SELECT * FROM m UNION ALL SELECT * FROM s WHERE canonical IN ('click', 'view') AND NOT EXISTS (SELECT 1 FROM m WHERE m.entity = s.entity AND m.canonical = s.canonical)""")
def accepted_suggestions(spark, sf):
    e = table(spark, sf, "events")
    mapped = e.where("event_type <> 'view'").groupBy(F.col("user_id").alias("entity"), F.lit("m").alias("media"), F.col("event_type").alias("canonical")).agg(F.max("event_id").cast("string").alias("value"))
    suggested = e.select(F.col("user_id").alias("entity")).distinct().select("entity", F.lit("m").alias("media"), F.explode(F.array(*map(F.lit, ("click", "view", "zzz")))).alias("canonical"), F.lit("s").alias("value"))
    return mapping.accept_suggestions(mapped, suggested, spark.createDataFrame([("click",), ("view",)], "canonical string"))


@query("SELECT event_id, CASE event_id % 5 WHEN 1 THEN '採用/人事直通' WHEN 2 THEN '採用部署代表' WHEN 3 THEN '会社代表' ELSE 'その他' END AS label FROM events")
def priority_labels(spark, sf):
    return table(spark, sf, "events").select("event_id", contact.priority_label(F.col("event_id") % 5).alias("label"))


@query("SELECT o_orderkey, date_trunc('minute', o_orderdate) - INTERVAL 9 HOUR AS at_utc FROM orders")
def local_times(spark, sf):
    at = F.to_utc_timestamp(F.date_trunc("minute", "o_orderdate"), "Asia/Tokyo")
    return table(spark, sf, "orders").select("o_orderkey", at.cast("timestamp_ntz").alias("at_utc"))


# ---------------------------------------------------------------- files and pipelines


@query("SELECT c_custkey, c_name, CAST(c_custkey + 2 AS BIGINT) AS row_no FROM customer")
def csv_round_trip(spark, sf):
    path = scratch(spark) + "/customer.csv"
    rows = table(spark, sf, "customer").select("c_custkey", "c_name").orderBy("c_custkey")
    writers.csv_with_mark(rows, path)
    return readers.csv_file(spark, path).select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", "row_no")


def demo_bronze(spark: SparkSession, sf: str, folder: str) -> None:
    """A small raw layer made of customers and events, with gaps, variants and ties."""
    c = table(spark, sf, "customer")
    key = F.col("c_custkey").cast("string")
    name = F.concat(F.lit("会社"), key)
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("c_custkey") % 3)
    put = lambda df, n: df.write.parquet(f"{folder}/{n}.parquet")
    put(c.select(key.alias("id"), F.concat(F.lit("株式会社"), name).alias("name"), name.alias("name_normalized"), F.when(F.col("c_custkey") % 4 == 0, key).alias("stock_code")), "companies")
    info = c.select(key.alias("id"), key.alias("original_id"), name.alias("企業名"), F.lit("東京都").alias("本社都道府県"), F.lit(None).cast("string").alias("代表者名"), pick(["1,042名", "", None], "c_custkey").alias("従業員数"), F.lit("大").alias("企業規模"), gaps().alias("業種"), F.lit("詳").alias("業種詳細"), F.lit("(03)1234-5678").alias("代表電話番号"), at.alias("scraped_at"))
    put(info.unionByName(info.withColumn("id", F.concat("id", F.lit("b"))).withColumn("企業規模", F.lit("小"))), "company_info")
    put(c.where("c_custkey % 2 = 0").select(key.alias("id"), key.alias("original_id"), F.lit("2012年7月").alias("設立"), F.lit("5億9,414万円").alias("資本金"), at.alias("scraped_at")), "ra_company")
    put(c.select(key.alias("id"), key.alias("original_id"), F.lit("1億円").alias("資本金"), F.lit("277名（連結480名）").alias("従業員数"), at.alias("scraped_at")), "rikunabi_company")
    put(c.select(key.alias("id"), key.alias("original_id"), F.concat(F.lit('{"売上高_2024年": "1,000", "ROE_2024年": "3.5%"'), F.lit("}")).alias("financial_data"), at.alias("scraped_at")), "minkabu")
    put(c.select(key.alias("id"), key.alias("original_id"), F.lit("人事").alias("事業部"), F.concat(F.lit("Hr"), key, F.lit("@x.jp")).alias("メールアドレス"), at.alias("scraped_at")), "emails")
    put(c.select(key.alias("id"), F.lit(None).cast("string").alias("original_id"), F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.concat(F.lit("㈱"), name)).alias("企業名_掲載名"), F.lit("2024年5月").alias("掲載日"), at.alias("scraped_at")), "hr_labbase")


@query(f"""SELECT CAST(c_custkey AS VARCHAR) AS original_id, concat('会社', c_custkey) AS "企業名", CASE WHEN c_custkey % 4 = 0 THEN CAST(c_custkey AS VARCHAR) END AS "証券コード", CASE WHEN c_custkey % 2 = 0 THEN '2012-07' END AS "設立",
CASE WHEN c_custkey % 2 = 0 THEN '594140000' ELSE '100000000' END AS "資本金", '277' AS "従業員数", '小' AS "企業規模", nullif({SQL_GAPS}, '') AS "業種_csv", '詳' AS "業種詳細", '03-1234-5678' AS "代表電話番号", '東京都' AS "本社都道府県", '3.5' AS "ROE_2024年", '1000000000' AS "売上高_2024年", concat('hr', c_custkey, '@x.jp') AS "企業メールアドレス" FROM customer""")
def medallion_company_info(spark, sf):
    folder = scratch(spark)
    demo_bronze(spark, sf, folder)
    info = medallion.gold(spark, folder, dt.datetime(2025, 1, 1))["company_info"]
    flat = medallion.flat_company_info(info)
    return flat.select("original_id", "企業名", "証券コード", "設立", "資本金", "従業員数", "企業規模", "業種_csv", "業種詳細", "代表電話番号", "本社都道府県", "ROE_2024年", "売上高_2024年", "企業メールアドレス")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS original_id, 'labbase' AS service_name, concat('㈱会社', c_custkey) AS "企業名_掲載名", '2024-05' AS "掲載日" FROM customer WHERE c_custkey % 5 <> 0""")
def medallion_hr_services(spark, sf):
    folder = scratch(spark)
    demo_bronze(spark, sf, folder)
    return medallion.gold(spark, folder, dt.datetime(2025, 1, 1))["hr_services"].select("original_id", "service_name", "企業名_掲載名", "掲載日")


# ---------------------------------------------------------------- streams


@query("SELECT user_id, event_id, ts, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def stream_latest(spark, sf):
    folder = scratch(spark)
    stream = jobs.source(spark, f"{sf}/events.parquet").select("user_id", "event_id", "ts", "event_type")
    return jobs.keep_latest(stream, ["user_id"], "ts", "event_id", f"{folder}/table", f"{folder}/checkpoint")


@query("SELECT CAST(ts AS DATE) AS day, event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_daily(spark, sf):
    folder = scratch(spark)
    out = jobs.daily(jobs.source(spark, f"{sf}/events.parquet", ("ts",)), "ts", "event_type", "value", f"{folder}/table", f"{folder}/checkpoint")
    return out.withColumn("total", F.round("total", 4))


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_first_seen(spark, sf):
    folder = scratch(spark)
    stream = jobs.source(spark, f"{sf}/events.parquet", ("ts",)).select("user_id", "event_type", "ts")
    return jobs.first_seen(stream, ["user_id", "event_type"], "ts", f"{folder}/table", f"{folder}/checkpoint").select("user_id", "event_type")

