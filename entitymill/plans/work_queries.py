"""Queries on imports, exports, files and reports, on tables made of the supplied ones: customers are
companies, nations representatives, regions products, orders calls."""

from __future__ import annotations

from pyspark.sql import functions as F

from entitymill.operators import answers, calls, fuzzy, merge, periods, quality, reshape, upsert
from entitymill.plans import call_import
from entitymill.plans.registry import query, table
from entitymill.scratch import new_folder
from entitymill.sources import commits, exports, readers, scans, writers
from entitymill.streaming import jobs

# ---------------------------------------------------------------- call import and exports

#: Expressions of orders that Spark and DuckDB read alike.
_PHONE = "concat('03-', lpad(CAST(o_orderkey % 7 AS STRING), 4, '0'))"
_CALL = {
    "pos": "o_orderkey", "company_name": "CASE WHEN o_orderkey % 11 = 0 THEN 'nobody' ELSE concat('会社', o_custkey, '社') END", "sales_rep_name": "concat('rep', o_orderkey % 30)",
    "product_name": "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE concat('product', o_orderkey % 6) END", "called_at": "'2025-01-15 14:30'", "phone_number": _PHONE,
    "phone_status": "CASE o_orderkey % 3 WHEN 0 THEN '未確認' WHEN 1 THEN '該当' ELSE 'AI対応' END", "phone_status_memo": "CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE concat('memo', o_orderkey) END",
    "discovered_number": "CASE WHEN o_orderkey % 5 = 0 THEN concat('06-', o_orderkey % 9) END", "discovered_number_memo": "''", "call_result": "'不在'", "spoke_with": "NULL",
    "discovered_person_chuto": "CASE WHEN o_orderkey % 6 = 0 THEN concat('人', o_orderkey % 4) END", "discovered_person_shinsotsu": "CASE WHEN o_orderkey % 9 = 0 THEN concat('人', o_orderkey % 4) WHEN o_orderkey % 10 = 0 THEN '別人' END", "notes": "''",
}
_CALLS_SQL = "c AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in _CALL.items()) + ", CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_custkey AS STRING) END AS company_id FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer) OR o_orderkey % 11 = 0)"


def _stored(spark, sf) -> dict:
    """The tables before an import."""
    customer, nation, region = (table(spark, sf, n) for n in ("customer", "nation", "region"))
    key = F.col("c_custkey").cast("string")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("c_custkey") * 60)
    return {
        "companies": customer.select(key.alias("id"), F.concat(F.lit("会社"), key, F.lit("社")).alias("name_normalized"), F.when(F.col("c_custkey") % 3 == 0, key).alias("stock_code"), at.alias("created_at")),
        "reps": nation.select(F.concat(F.lit("r"), F.col("n_nationkey").cast("string")).alias("id"), F.concat(F.lit("rep"), F.col("n_nationkey").cast("string")).alias("name")),
        "products": region.select(F.col("r_regionkey").cast("int").alias("id"), F.concat(F.lit("product"), F.col("r_regionkey").cast("string")).alias("name")),
        "phones": customer.where("c_custkey % 2 = 0").select(F.concat(F.lit("p"), key).alias("id"), key.alias("company_id"), F.lit("03-0001").alias("number"), F.lit("別会社・別拠点・別事業部").alias("status"), F.lit("old").alias("status_detail"), F.lit("架電前").alias("source")),
        "persons": customer.where("c_custkey % 5 = 0").select(F.concat(F.lit("h"), key).alias("id"), key.alias("company_id"), F.lit("人0").alias("name"), F.lit("社長").alias("role"), F.lit("名刺").alias("source")),
    }


def _imported(spark, sf) -> tuple[dict, calls.Imported]:
    stored = _stored(spark, sf)
    known = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    orders = table(spark, sf, "orders")
    orders = orders.where("o_orderkey % 11 = 0").unionByName(orders.where("o_orderkey % 11 <> 0").join(known, "o_custkey", "left_semi"))
    return stored, calls.import_calls(orders.select(*[F.expr(e).alias(n) for n, e in _CALL.items()]), **stored)


@query(f"WITH {_CALLS_SQL} SELECT CAST(count(company_id) AS BIGINT) AS success, CAST(count(*) - count(company_id) AS BIGINT) AS skipped FROM c")
def import_counts(spark, sf):
    return _imported(spark, sf)[1].counts


_NUMBERS_SQL = f"""{_CALLS_SQL},
s AS (SELECT company_id, phone_number AS number, pos * 2 AS o, '架電' AS source FROM c WHERE company_id IS NOT NULL UNION ALL SELECT company_id, discovered_number, pos * 2 + 1, '架電判明' FROM c WHERE company_id IS NOT NULL AND discovered_number IS NOT NULL
 UNION ALL SELECT CAST(c_custkey AS STRING), '03-0001', -1, '架電前' FROM customer WHERE c_custkey % 2 = 0),
f AS (SELECT company_id, number, arg_min(source, o) AS source FROM s GROUP BY 1, 2),
t AS (SELECT company_id, phone_number AS number, arg_max(phone_status, pos) AS st, arg_max(phone_status_memo, pos) FILTER (phone_status_memo <> '') AS dt FROM c WHERE company_id IS NOT NULL AND phone_status <> '未確認' GROUP BY 1, 2)"""


@query(f"""WITH {_NUMBERS_SQL}
SELECT f.company_id, f.number, f.source, coalesce(t.st, CASE WHEN f.source = '架電前' THEN '別会社・別拠点・別事業部' ELSE '未確認' END) AS status, coalesce(t.dt, CASE WHEN f.source = '架電前' THEN 'old' END) AS status_detail FROM f LEFT JOIN t USING (company_id, number)""")
def import_phones(spark, sf):
    return _imported(spark, sf)[1].phones.select("company_id", "number", "source", "status", "status_detail")


@query(f"""WITH {_CALLS_SQL},
p AS (SELECT company_id, discovered_person_chuto AS name, CASE WHEN discovered_person_chuto = discovered_person_shinsotsu THEN '中途・新卒採用担当' ELSE '中途採用担当' END AS role, pos * 2 AS o FROM c WHERE company_id IS NOT NULL AND discovered_person_chuto IS NOT NULL
 UNION ALL SELECT company_id, discovered_person_shinsotsu, '新卒採用担当', pos * 2 + 1 FROM c WHERE company_id IS NOT NULL AND discovered_person_shinsotsu IS NOT NULL AND discovered_person_chuto IS DISTINCT FROM discovered_person_shinsotsu
 UNION ALL SELECT CAST(c_custkey AS STRING), '人0', '社長', -1 FROM customer WHERE c_custkey % 5 = 0)
SELECT company_id, name, arg_max(role, o) AS role, CASE WHEN min(o) = -1 THEN '名刺' ELSE '架電判明' END AS source FROM p GROUP BY 1, 2""")
def import_persons(spark, sf):
    return _imported(spark, sf)[1].persons.select("company_id", "name", "role", "source")


@query(f"""WITH {_CALLS_SQL} SELECT pos, company_id, sales_rep_name, phone_number, CASE WHEN product_name IN (SELECT concat('product', r_regionkey) FROM region) THEN product_name END AS product_name, TIMESTAMP '2025-01-15 05:30:00' AS called_at, phone_status FROM c WHERE company_id IS NOT NULL""")
def import_logs(spark, sf):
    stored, done = _imported(spark, sf)
    rows = done.logs.join(done.phones.select(F.col("id").alias("phone_number_id"), F.col("number").alias("phone_number")), "phone_number_id")
    rows = rows.join(done.reps.select(F.col("id").alias("sales_rep_id"), F.col("name").alias("sales_rep_name")), "sales_rep_id").join(stored["products"].select(F.col("id").alias("product_id"), F.col("name").alias("product_name")), "product_id", "left")
    return rows.select("pos", "company_id", "sales_rep_name", "phone_number", "product_name", F.col("called_at").cast("timestamp_ntz").alias("called_at"), "phone_status")


_COMPANY = "concat('会社', {0}, '社')"


@query(f"""WITH {_CALLS_SQL} SELECT {_COMPANY.format('company_id')} AS company_name, sales_rep_name, CASE WHEN product_name IN (SELECT concat('product', r_regionkey) FROM region) THEN product_name ELSE '' END AS product_name, '2025-01-15 05:30' AS called_at, phone_number, phone_status, phone_status_memo,
coalesce(discovered_number, '') AS discovered_number, discovered_number_memo, call_result, '' AS spoke_with, coalesce(discovered_person_chuto, '') AS discovered_person_chuto, coalesce(discovered_person_shinsotsu, '') AS discovered_person_shinsotsu, notes FROM c WHERE company_id IS NOT NULL""")
def export_imported_calls(spark, sf):
    stored, done = _imported(spark, sf)
    return exports.call_logs(done.logs, stored["companies"], done.reps, done.phones, stored["products"]).drop("call_id")


@query(f"""WITH {_NUMBERS_SQL}
SELECT {_COMPANY.format('f.company_id')} AS company_name, f.number AS phone_number, '' AS label, f.source, coalesce(t.st, CASE WHEN f.source = '架電前' THEN '別会社・別拠点・別事業部' ELSE '未確認' END) AS status, coalesce(t.dt, CASE WHEN f.source = '架電前' THEN 'old' ELSE '' END) AS status_detail, '' AS created_at FROM f LEFT JOIN t USING (company_id, number)""")
def export_phone_numbers(spark, sf):
    stored, done = _imported(spark, sf)
    return exports.phone_numbers(done.phones, stored["companies"]).drop("phone_id")


@query(f"""SELECT concat('h', c_custkey) AS person_id, {_COMPANY.format('c_custkey')} AS company_name, '人0' AS person_name, '' AS department, '社長' AS role, '' AS email, 'FALSE' AS is_decision_maker, '' AS notes, '名刺' AS source, '' AS created_at FROM customer WHERE c_custkey % 5 = 0""")
def export_persons(spark, sf):
    stored = _stored(spark, sf)
    return exports.persons(stored["persons"], stored["companies"])


@query(f"""SELECT CAST(c_custkey AS STRING) AS company_id, {_COMPANY.format('c_custkey')} AS "企業名", CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS STRING) ELSE '' END AS "証券コード", c_mktsegment AS "業種", CASE WHEN c_custkey % 2 = 0 THEN '4.5' ELSE '' END AS en_total_score,
strftime(make_timestamp((1700000000 + c_custkey * 60) * 1000000), '%Y-%m-%d %H:%M') AS "登録日時" FROM customer""")
def export_companies(spark, sf):
    customer, at = table(spark, sf, "customer"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("n"))
    key, times = F.col("c_custkey").cast("string"), F.explode(F.array(F.lit(0), F.lit(9)))
    info = customer.withColumn("n", times).select(F.concat(key, F.col("n").cast("string")).alias("id"), key.alias("original_id"), F.when(F.col("n") == 9, F.col("c_mktsegment")).otherwise("old").alias("業種"), at.alias("scraped_at"))
    reviews = customer.where("c_custkey % 2 = 0").withColumn("n", F.lit(1)).select(key.alias("id"), key.alias("original_id"), F.lit("4.5").alias("total_score"), at.alias("scraped_at"))
    return exports.companies(_stored(spark, sf)["companies"], info, reviews).select("company_id", "企業名", "証券コード", "業種", "en_total_score", "登録日時")


@query(f"""SELECT CAST(o_orderkey AS STRING) AS deal_id, {_COMPANY.format('o_custkey')} AS company_name, coalesce('product' || r_regionkey, '') AS product_name, coalesce('rep' || n_nationkey, '') AS assigned_rep, o_orderstatus AS status,
CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE CAST(o_orderkey % 4 AS STRING) END AS priority, '' AS expected_revenue, '' AS notes, strftime(o_orderdate, '%Y-%m-%d %H:%M') AS created_at
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN region ON r_regionkey = o_orderkey % 6 LEFT JOIN nation ON n_nationkey = o_orderkey % 30""")
def export_all_deals(spark, sf):
    stored = _stored(spark, sf)
    key = lambda c: F.col(c).cast("string")
    deals = table(spark, sf, "orders").select(
        key("o_orderkey").alias("id"), key("o_custkey").alias("company_id"), (F.col("o_orderkey") % 6).cast("int").alias("product_id"), F.concat(F.lit("r"), (F.col("o_orderkey") % 30).cast("string")).alias("assigned_rep_id"),
        F.col("o_orderstatus").alias("status"), (F.col("o_orderkey") % 4).alias("priority"), F.lit(0).alias("expected_revenue"), F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )
    return exports.deals(deals, stored["companies"], stored["reps"], stored["products"])


@query("SELECT CAST(c_custkey AS STRING) AS id, CAST(c_custkey AS STRING) AS code FROM customer WHERE c_custkey % 3 = 0")
def stock_code_map(spark, sf):
    companies = _stored(spark, sf)["companies"]
    rows = companies.select("id", F.col("name_normalized").alias("企業名"))
    return merge.stock_codes(rows, companies, "企業名", "code").select("id", "code")


# ---------------------------------------------------------------- files


@query("SELECT o_orderkey, concat('a\"', o_orderstatus, chr(10), 'b') AS note, CAST(row_number() OVER (ORDER BY o_orderkey) + 1 AS BIGINT) AS row_no FROM orders WHERE o_orderkey % 3 <> 0")
def checked_csv_rows(spark, sf):
    """Rows of a CSV file that pass, numbered as in the file; the others are errors."""
    folder = new_folder(spark)
    rows = table(spark, sf, "orders").where("o_orderkey % 3 <> 0").select("o_orderkey", F.concat(F.lit('a"'), "o_orderstatus", F.lit("\nb")).alias("note")).orderBy("o_orderkey")
    writers.csv_with_mark(rows, f"{folder}/orders.csv")
    good, _ = readers.checked_csv(spark, f"{folder}/orders.csv", ("o_orderkey", "note"))
    return good.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "note", "row_no")


@query("SELECT 0 AS row, '必須列がありません: 企業名, 電話番号' AS message")
def csv_errors(spark, sf):
    folder = new_folder(spark)
    writers.csv_with_mark(table(spark, sf, "region").select("r_name"), f"{folder}/bad.csv")
    return readers.checked_csv(spark, f"{folder}/bad.csv", ("r_name", "電話番号", "企業名"))[1].select(F.col("row").cast("int").alias("row"), "message")


@query("""WITH o AS (SELECT CAST(row_number() OVER (ORDER BY o_orderkey) + 1 AS BIGINT) AS row, o_orderkey % 5 AS k, o_orderkey AS id FROM orders)
SELECT row, CASE k WHEN 0 THEN 'phone_status が不正です: ''謎'' (許容値: 該当, 使われてない, AI対応, 別会社・別拠点・別事業部)' WHEN 1 THEN concat('called_at の日時形式が不正です: ''', id, ''' (例: 2025-01-15 14:30)') ELSE '必須列 ''company_name'' が空です' END AS message FROM o WHERE k < 3""")
def call_file_errors(spark, sf):
    """The error file of a call import, written and read again: a message for each row that fails."""
    folder, k = new_folder(spark), F.col("o_orderkey") % 5
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.when(k != 2, "会社").otherwise(" ").alias("company_name"), F.lit("rep").alias("sales_rep_name"),
        F.when(k == 1, F.col("o_orderkey").cast("string")).otherwise("2025/1/15").alias("called_at"), F.lit("03-1").alias("phone_number"), F.when(k == 0, "謎").otherwise("該当").alias("phone_status"), F.lit("a\nb").alias("notes"),
    )
    writers.csv_with_mark(rows.orderBy("o_orderkey"), f"{folder}/calls.csv", rows.columns[1:])
    writers.csv_with_mark(call_import.read_calls(spark, f"{folder}/calls.csv")[1].orderBy("row"), f"{folder}/errors.csv")
    return readers.csv_file(spark, f"{folder}/errors.csv").select(F.col("row").cast("long").alias("row"), "message")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_nationkey = 3")
def database_scan(spark, sf):
    """A table that lies in several databases, in parts of equal size by a text key, some columns and rows
    of it. The databases are files in the shared folder, in place of servers: each is made by one task
    and read in place by every executor."""
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    files = scans.sqlite_files(rows, new_folder(spark), "customer", "c_name")
    return scans.dbapi_scan(spark, scans.open_sqlite, files, "customer", "c_name", 8, rows.select("c_custkey", "c_name", "c_acctbal").schema, "c_nationkey = 3")


@query("""SELECT c_custkey AS pos, concat('人', c_custkey) AS name, CASE WHEN c_custkey % 2 = 0 THEN '社長' END AS role, concat('03-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')) AS number FROM customer WHERE c_custkey % 3 <> 0""")
def person_files(spark, sf):
    """Persons and their numbers, each from a file of its own, joined by company; a file lacks a column."""
    folder, c = new_folder(spark), table(spark, sf, "customer")
    key = F.col("c_custkey").cast("string")
    persons = c.select(key.alias("company_id"), F.concat(F.lit("人"), key).alias("name"), F.when(F.col("c_custkey") % 2 == 0, "社長").alias("role"), F.lit("a\nb").alias("notes"))
    phones = c.where("c_custkey % 3 <> 0").select(key.alias("company_id"), F.concat(F.lit("03-"), F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0")).alias("number"))
    writers.csv_with_mark(persons, f"{folder}/persons.csv")
    writers.csv_with_mark(phones, f"{folder}/phones.csv")
    a = readers.optional_csv(spark, f"{folder}/persons.csv", ("company_id", "name", "role", "department"))
    b = readers.optional_csv(spark, f"{folder}/phones.csv", ("company_id", "number", "label"))
    return a.join(b, "company_id").select(F.col("company_id").cast("long").alias("pos"), "name", "role", "number")


@query("""SELECT o_custkey AS key, CASE WHEN o_custkey % 7 <> 0 THEN concat('n', o_custkey) END AS name, CASE WHEN o_custkey % 7 = 0 THEN 'ValueError: refused' END AS error, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_custkey""")
def answered_prompts(spark, sf):
    """Prompts asked once each, some only at the second attempt and some never, by a function in place of
    a model; a second run asks nothing."""
    folder = new_folder(spark)
    prompts = table(spark, sf, "orders").select(F.col("o_custkey").alias("key"), F.concat(F.lit("who is "), F.col("o_custkey").cast("string")).alias("prompt"))

    def ask(asked, attempt):
        numbers = [int(p.split()[-1]) for p in asked]
        if any(n % 7 == 0 or (n % 5 == 0 and attempt == 1) for n in numbers):
            raise ValueError("refused")
        return [f'```json\n{{"name": "n{n}"}}\n```' for n in numbers]

    for _ in range(2):
        rows = answers.answer(spark, prompts, ask, f"{folder}/calls", "stand-in", attempts=2)
    parsed = readers.extracted(rows, "answer", "struct<name: string>")
    return parsed.groupBy("key", F.col("answer.name").alias("name"), "error").agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'labbase' ELSE 'bizreach' END AS service, c_name AS \"企業名\" FROM customer WHERE c_nationkey < 10")
def service_csv_union(spark, sf):
    """Files of the services that have one; the third has none."""
    folder, c = new_folder(spark), table(spark, sf, "customer").where("c_nationkey < 10")
    for n, rest in (("labbase", 0), ("bizreach", 1)):
        rows = c.where(f"c_nationkey % 2 = {rest}").select(F.col("c_name").alias("企業名"), F.lit("").alias("タイトル"), F.lit("2024-05").alias("掲載日"))
        writers.csv_with_mark(rows, f"{folder}/{n}.csv")
    return readers.services(spark, folder, ["labbase", "bizreach", "caritasu"]).select("service", "企業名")


@query("SELECT c_name, CASE WHEN c_custkey % 2 = 0 THEN 'found' END AS status, CAST(NULL AS STRING) AS url FROM customer WHERE c_custkey % 2 = 0")
def found_csv_rows(spark, sf):
    """Rows with status found, of a file that lacks a column, and of one that is absent."""
    folder = new_folder(spark)
    writers.csv_with_mark(table(spark, sf, "customer").select("c_name", F.when(F.col("c_custkey") % 2 == 0, "found").otherwise("error").alias("status")), f"{folder}/urls.csv")
    columns = ("c_name", "status", "url")
    both = [readers.optional_csv(spark, f"{folder}/{n}.csv", columns) for n in ("urls", "absent")]
    return readers.found_rows(both[0].unionByName(both[1]))


@query("""SELECT c_mktsegment AS name, CAST(min(c_custkey) AS BIGINT) AS c_custkey FROM customer GROUP BY 1""")
def raw_and_unique_files(spark, sf):
    folder = new_folder(spark)
    rows = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("name"), "c_custkey", F.col("c_custkey").alias("pos"))
    writers.service_files(rows, folder, "labbase", "name", "pos")
    return readers.csv_file(spark, f"{folder}/labbase.csv").select("name", F.col("c_custkey").cast("long").alias("c_custkey"))


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1 UNION ALL SELECT event_type, CAST(count(*) AS BIGINT) FROM events GROUP BY 1")
def appended_table(spark, sf):
    """A table that is overwritten once, then appended to; appending nothing changes nothing."""
    path = f"{new_folder(spark)}/counts"
    counts = table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    writers.overwrite(counts.limit(1), path)
    writers.overwrite(counts, path)
    writers.append(counts, path)
    writers.append(counts.limit(0), path)
    return spark.read.parquet(path)


_HALF = "CAST(count(*) AS BIGINT) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events"


@query(f"""SELECT 'now' AS seen, {_HALF} UNION ALL SELECT 'first', {_HALF} WHERE event_id % 2 = 0 UNION ALL SELECT 'rolled back', {_HALF} WHERE event_id % 2 = 0""")
def committed_table(spark, sf):
    """A run that is applied twice, a writer that stages and dies, and a rollback: what readers see."""
    t, rows = commits.Table(spark, f"{new_folder(spark)}/events"), table(spark, sf, "events").select("event_id", "event_type")
    t.append(rows.where("event_id % 2 = 0"), "even")
    for _ in range(2):
        t.append(rows.where("event_id % 2 <> 0"), "odd")
    t.stage(rows)
    count = lambda df, name: df.agg(F.count("*").alias("n"), F.sum("event_id").alias("ids")).select(F.lit(name).alias("seen"), "n", "ids")
    out = count(t.read(), "now").unionByName(count(t.read(1), "first"))
    t.rollback(1)
    return out.unionByName(count(t.read(), "rolled back"))


@query("SELECT c_custkey, c_name, 'late' AS source FROM customer WHERE c_custkey % 3 = 1")
def emptied_under_marker(spark, sf):
    """Raw rows go once the run that read them is marked; rows that came meanwhile stay."""
    folder = new_folder(spark)
    raw, rows = f"{folder}/raw", table(spark, sf, "customer").select("c_custkey", "c_name")
    rows.where("c_custkey % 3 <> 1").withColumn("source", F.lit("early")).write.parquet(raw)
    seen = commits.listed(spark, raw)
    read = spark.read.parquet(raw)
    commits.commit_run(spark, f"{folder}/gold", "r1", {"customers": ("append", read)})
    rows.where("c_custkey % 3 = 1").withColumn("source", F.lit("late")).write.mode("append").parquet(raw)
    if commits.marked(spark, f"{folder}/gold", "r1"):
        commits.empty_read_files(spark, raw, seen)
    return spark.read.parquet(raw)


@query("SELECT * FROM (VALUES ('a', 0), ('b', 25)) t(name, n)")
def truncated_tables(spark, sf):
    """One table is emptied and keeps its columns; the other stays."""
    folder, rows = new_folder(spark), table(spark, sf, "nation").select("n_name")
    for n in "ab":
        writers.overwrite(rows, f"{folder}/{n}")
    writers.truncate(spark, [f"{folder}/a", f"{folder}/absent"])
    counted = [spark.read.parquet(f"{folder}/{n}").agg(F.count("n_name").cast("int").alias("n")).select(F.lit(n).alias("name"), "n") for n in "ab"]
    return counted[0].unionByName(counted[1])


@query("SELECT * FROM (VALUES ('a', 'would be dropped', 'dropped'), ('call_logs', 'kept', 'kept'), ('absent', 'absent', 'absent')) t(name, dry, wet)")
def dropped_tables(spark, sf):
    folder = new_folder(spark)
    for n in ("a", "call_logs"):
        writers.overwrite(table(spark, sf, "region"), f"{folder}/{n}")
    paths = [f"{folder}/{n}" for n in ("a", "call_logs", "absent")]
    dry, wet = writers.drop_tables(spark, paths), writers.drop_tables(spark, paths, dry_run=False)
    return spark.createDataFrame([(p.rsplit("/", 1)[1], dry[p], wet[p]) for p in paths], "name string, dry string, wet string")


_SLUGS = ["https://b.example.jp/co{}", "https://b.example.jp/co{}/stories/1", "https://b.example.jp/stories/{}", "https://b.example.jp/_x{}", "https://other.jp/co{}", "https://b.example.jp/a b{}"]


@query("""SELECT DISTINCT CASE c_custkey % 6 WHEN 5 THEN concat('a%20b', c_custkey) ELSE concat('co', c_custkey) END AS slug FROM customer WHERE c_custkey % 6 IN (0, 1, 5)""")
def url_slugs(spark, sf):
    made = F.element_at(F.array(*map(F.lit, _SLUGS)), (F.col("c_custkey") % 6 + 1).cast("int"))
    urls = table(spark, sf, "customer").select(F.replace(made, F.lit("{}"), F.col("c_custkey").cast("string")).alias("url"))
    return readers.sitemap_slugs(urls, "url", "https://b.example.jp")


@query("""SELECT CAST(k AS BIGINT) AS cluster, name FROM (SELECT dense_rank() OVER (ORDER BY p_partkey // 3) AS k, lpad(CAST(p_partkey AS STRING), 9, '0') AS name FROM part
 WHERE p_partkey // 3 IN (SELECT p_partkey // 3 FROM part GROUP BY 1 HAVING count(*) = 3))""")
def cluster_review_file(spark, sf):
    """Chains of three names as clusters, written for review and read again."""
    folder, p = new_folder(spark), table(spark, sf, "part").select("p_partkey", F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("name"))
    whole = p.groupBy(F.floor(F.col("p_partkey") / 3).alias("g")).agg(F.array_sort(F.collect_list("name")).alias("n")).where(F.size("n") == 3)
    pairs = whole.select(F.explode(F.array(*[F.struct(F.get("n", F.lit(i)).alias("a"), F.get("n", F.lit(i + 1)).alias("b")) for i in (0, 1)])).alias("x")).select("x.a", "x.b")
    writers.review_file(fuzzy.clusters(pairs), f"{folder}/review.csv")
    back = readers.csv_file(spark, f"{folder}/review.csv")
    return back.select(F.col("クラスタID").cast("long").alias("cluster"), F.col("企業名").alias("name"))


@query("SELECT * FROM (VALUES ('things', 'id', 'bigint'), ('things', 'name', 'string'), ('days', 'day', 'date')) t(table_name, column_name, kind)")
def created_tables(spark, sf):
    folder, schemas = new_folder(spark), {"things": "id BIGINT, name STRING", "days": "day DATE"}
    suffix = folder.rsplit("/", 1)[1]
    named = {f"{n}_{suffix}": c for n, c in schemas.items()}
    writers.create_tables(spark, named, folder)
    found = [(n.removesuffix(f"_{suffix}"), f.name, f.dataType.simpleString()) for n in named for f in spark.table(n).schema]
    writers.drop_all(spark, list(named))
    return spark.createDataFrame(found, "table_name string, column_name string, kind string")


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'new' ELSE c_name END AS c_name FROM customer WHERE c_custkey % 4 = 0 OR c_custkey % 2 = 0")
def accumulated_output(spark, sf):
    """The output of a run before is read again, and the new rows replace theirs or are added."""
    path, rows = f"{new_folder(spark)}/out", table(spark, sf, "customer").select("c_custkey", "c_name")
    writers.overwrite(rows.where("c_custkey % 2 = 0"), path)
    return upsert.overwrite_rows(spark.read.parquet(path), rows.where("c_custkey % 4 = 0").withColumn("c_name", F.lit("new")), "c_custkey")


@query("SELECT CAST(count(*) AS BIGINT) AS calls, CAST(sum(length(event_type)) AS BIGINT) AS tokens FROM events")
def usage_counters(spark, sf):
    """Counters that come with the writing of a table."""
    rows, seen = quality.counted(table(spark, sf, "events"), "usage", calls=F.count("*"), tokens=F.sum(F.length("event_type")))
    writers.overwrite(rows, f"{new_folder(spark)}/events")
    return spark.createDataFrame([(seen.get["calls"], seen.get["tokens"])], "calls long, tokens long")


# ---------------------------------------------------------------- answers, prompts, reports


@query("""SELECT o_orderkey AS snippet_id, 0 AS pos, concat('n', o_custkey) AS name FROM orders WHERE o_orderkey % 3 < 2 UNION ALL SELECT o_orderkey, 1, 'second' FROM orders WHERE o_orderkey % 3 = 1""")
def listed_answers(spark, sf):
    """One object, a fenced list of two, and no JSON; the model's own ids are replaced."""
    one = F.concat(F.lit('{"snippet_id": 7, "name": "n'), F.col("o_custkey").cast("string"), F.lit('"}'))
    answer = F.when(F.col("o_orderkey") % 3 == 0, one).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("```json\n["), one, F.lit(', {"name": "second"}]\n```'))).otherwise("sorry")
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("snippet_id"), answer.alias("answer"))
    return readers.answer_items(rows, "snippet_id", "answer", "snippet_id: bigint, name: string")


@query("""WITH r AS (SELECT user_id, event_type, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS n FROM events)
SELECT user_id, CAST(floor(n / 5) AS BIGINT) AS batch, CAST(count(*) AS INTEGER) AS n_snippets, concat('Read these.', chr(10), chr(10), string_agg(concat('[', n, ']', chr(10), 'text: ', left(event_type, 4)), concat(chr(10), chr(10)) ORDER BY n)) AS prompt FROM r GROUP BY 1, 2""")
def batched_prompts(spark, sf):
    rows = periods.running_id(table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type"), ["user_id"], "ts", "event_id")
    return merge.prompts(rows, ["user_id"], "snippet_id", {"text": "event_type"}, size=5, limit=4, head="Read these.")


_BLANKS = "CASE WHEN c_custkey % 7 = 0 THEN ' ' WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END"


@query(f"""WITH u AS (SELECT 'segment' AS field, count(*) FILTER (trim({_BLANKS}) <> '') AS f, count(*) AS t FROM customer UNION ALL SELECT 'name', count(*), count(*) FROM customer)
SELECT field, CAST(f AS BIGINT) AS filled, CAST(t AS BIGINT) AS total, CAST(f AS DOUBLE) / t AS rate FROM u""")
def stripped_fill_rates(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", F.expr(_BLANKS).alias("segment"), F.col("c_name").alias("name"))
    return quality.stripped_rates(rows, "c_custkey")


@query(f"""WITH u AS (SELECT 'segment' AS field, count(*) FILTER (trim({_BLANKS}) <> '') AS f, count(*) AS t FROM customer UNION ALL SELECT 'name', count(*), count(*) FROM customer)
SELECT field, concat(rpad(field, 24, ' '), lpad(printf('%.1f%%', f * 100.0 / t), 7, ' '), ' ', repeat('#', CAST(round(f * 20.0 / t) AS INTEGER)), repeat('.', 20 - CAST(round(f * 20.0 / t) AS INTEGER)), ' ', f, '/', t) AS line FROM u""")
def report_lines(spark, sf):
    return quality.report(stripped_fill_rates(spark, sf))


@query("SELECT table_name, field_name, CAST(fill_rate AS DOUBLE) AS fill_rate FROM (VALUES ('customer', 'low', 0.2)) t(table_name, field_name, fill_rate) WHERE (SELECT round(avg(CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END), 4) FROM customer) = 0.2")
def low_fill_fields(spark, sf):
    rows = table(spark, sf, "customer").select("c_name", F.when(F.col("c_custkey") % 5 == 0, "x").alias("low"))
    return quality.low_fields(quality.fill_rates(rows, "customer")).select("table_name", "field_name", "fill_rate")


@query("""SELECT user_id, coalesce(max(CAST(event_id AS STRING)) FILTER (event_type = 'view'), '') AS "view", coalesce(max(CAST(event_id AS STRING)) FILTER (event_type = 'absent'), '') AS absent, coalesce(max(CAST(event_id AS STRING)) FILTER (event_type = 'click'), '') AS click,
coalesce(max(CAST(event_id AS STRING)) FILTER (event_type = 'signup'), '') AS signup FROM events WHERE event_type IN ('view', 'click', 'signup') GROUP BY 1""")
def field_matrix(spark, sf):
    long = table(spark, sf, "events").where("event_type IN ('view', 'click', 'signup')").select("user_id", F.col("event_type").alias("name"), F.col("event_id").cast("string").alias("value"))
    return reshape.matrix(long, "user_id", ["view", "absent"])


@query("""WITH e AS (SELECT event_id // 50 + 1 AS page, user_id FROM events), f AS (SELECT user_id, min(page) AS m FROM e GROUP BY 1), w AS (SELECT (page + 19) // 20 * 20 AS block, count(*) AS n, count(DISTINCT page) AS p FROM e GROUP BY 1),
n AS (SELECT (m + 19) // 20 * 20 AS block, count(*) AS k FROM f GROUP BY 1), r AS (SELECT w.block, w.n, coalesce(n.k, 0) AS n_new FROM w LEFT JOIN n USING (block) WHERE w.p = 20)
SELECT CAST(block AS BIGINT) AS block, CAST(n AS BIGINT) AS n, CAST(n_new AS BIGINT) AS n_new, CAST(n_new AS DOUBLE) / n AS rate, coalesce(block = (SELECT min(block) FROM r WHERE block >= 50 AND n_new * 20 < n), false) AS stop FROM r""")
def new_rate_stop(spark, sf):
    rows = table(spark, sf, "events").select("user_id", (F.floor(F.col("event_id") / 50) + 1).alias("page"))
    return periods.block_rates(rows, "user_id", "page")


# ---------------------------------------------------------------- late data


_LAST = "(SELECT epoch_us(max(ts)) - 7200000000 FROM events)"  # where the watermark is behind the only batch


@query(f"""WITH e AS (SELECT event_type, unnest([0, 1]) AS k, epoch_us(ts) // 1800000000 * 1800000000 AS w FROM events), s AS (SELECT event_type, w - k * 1800000000 AS s FROM e)
SELECT make_timestamp(s) AS "start", make_timestamp(s + 3600000000) AS "end", event_type, CAST(count(*) AS BIGINT) AS n FROM s WHERE s + 3600000000 <= {_LAST} GROUP BY s, event_type""")
def stream_windows(spark, sf):
    folder = new_folder(spark)
    rows = jobs.windows(jobs.source(spark, f"{sf}/events.parquet", ("ts",)), "ts", "event_type", f"{folder}/table", f"{folder}/checkpoint")
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@query(f"""WITH e AS (SELECT user_id, epoch_us(ts) AS t, lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events),
g AS (SELECT user_id, t, sum(CASE WHEN p IS NULL OR t - p > 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t) AS g FROM e)
SELECT make_timestamp(min(t)) AS "start", make_timestamp(max(t) + 1800000000) AS "end", user_id, CAST(count(*) AS BIGINT) AS n FROM g GROUP BY user_id, g HAVING max(t) + 1800000000 <= {_LAST}""")
def stream_sessions(spark, sf):
    folder = new_folder(spark)
    rows = jobs.sessions(jobs.source(spark, f"{sf}/events.parquet", ("ts",)), "ts", "user_id", f"{folder}/table", f"{folder}/checkpoint")
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


_KEPT = "SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS event_type, user_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"


@query(f"""WITH k AS ({_KEPT}), u AS (SELECT 'event_type' AS field, count(event_type) AS f, count(*) AS t FROM k UNION ALL SELECT 'user_id', count(*), count(*) FROM k)
SELECT field, CAST(f AS BIGINT) AS filled, CAST(t AS BIGINT) AS total FROM u""")
def stream_coverage(spark, sf):
    """Coverage over the latest row of each user, from totals that every batch changes."""
    folder, rows = new_folder(spark), table(spark, sf, "events").select("user_id", "event_id", "ts", F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("event_type"))
    for rest in (1, 0):  # the second half is not newer than the first
        rows.where(F.col("event_id") % 2 == rest).write.mode("append").parquet(f"{folder}/in")
        out = jobs.coverage(jobs.source(spark, f"{folder}/in"), ["user_id"], "ts", "event_id", ["event_type", "user_id"], folder, f"{folder}/checkpoint")
    return out.select("field", "filled", "total")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_recent(spark, sf):
    folder = new_folder(spark)
    stream = jobs.source(spark, f"{sf}/events.parquet", ("ts",)).select("user_id", "event_type", "ts")
    return jobs.recent(stream, ["user_id", "event_type"], "ts", f"{folder}/table", f"{folder}/checkpoint").select("user_id", "event_type")


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def stream_resumed(spark, sf):
    """The job runs, more files arrive, and it goes on from its checkpoint."""
    folder, rows = new_folder(spark), table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    for rest in (0, 1):
        rows.where(F.col("event_id") % 2 == rest).write.mode("append").parquet(f"{folder}/in")
        out = jobs.keep_latest(jobs.source(spark, f"{folder}/in"), ["user_id"], "ts", "event_id", f"{folder}/table", f"{folder}/checkpoint")
    return out.select("user_id", "event_id", "event_type")
