"""Edge cases that the query tables do not have: nulls, ties, empty tables, order of rows."""

import datetime as dt

from entitymill.operators import dedupe, fuzzy, mapping, merge, quality, reshape, resolve, upsert
from entitymill.plans import medallion
from entitymill.sources import commits, readers, writers
from pyspark.sql import functions as F


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_latest_nulls_and_ties(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 2, 2), ("a", None, 3), ("a", 5, 4), ("a", 5, 5)], "k string, t int, id int")
    assert rows(dedupe.latest(df, ["k"], "t", "id")) == [("a", 5, 5), (None, 2, 2)]
    assert dedupe.latest(df.limit(0), ["k"], "t", "id").count() == 0


def test_not_stored_is_null_safe(spark):
    a = spark.createDataFrame([("x", None), ("x", "d")], "n string, d string")
    assert rows(dedupe.not_stored(a, a.where("d is null"), ["n", "d"])) == [("x", "d")]


def test_resolve(spark):
    dim = spark.createDataFrame([("1", "アルファ"), ("2", "beta one"), ("3", "beta two")], "id string, name_normalized string")
    names = spark.createDataFrame([("アルファ",), ("BETA ONE",), ("beta",), ("a%",), ("",), ("wo",)], "name string")
    low = lambda c: F.lower(c)
    assert dict(rows(resolve.cascade(names, dim, low))) == {"アルファ": "1", "BETA ONE": "2", "beta": None, "a%": None, "": None, "wo": None}
    assert dict(rows(resolve.by_prefix(names, dim)))["beta"] == "2"
    assert dict(rows(resolve.three_stages(names, dim, low))) == {"アルファ": "1", "BETA ONE": "2", "beta": "2", "a%": None, "": None, "wo": "3"}


def test_merge(spark):
    assert merge.or_blank(spark.range(1), "no") is not None
    v = spark.createDataFrame([("c", "b", "設立", " - ", 0), ("c", "a", "設立", "2012", 1), ("c", "b", "資本金", "なし", 0)], "entity string, media string, canonical string, value string, media_pos int")
    p = spark.createDataFrame([("設立", "b", 0)], "canonical string, media string, priority int")
    assert rows(merge.media_priority(v, p)) == [("c", "設立", "2012", "a")]


def test_labels(spark):
    aliases = spark.createDataFrame([("本社（MAP）", "本社所在地", 0), ("従業員数", "従業員数", 1), ("連結従業員数", "連結", 2)], "alias string, canonical string, pos int")
    labels = spark.createDataFrame([("本社(ＭＡＰ)",), ("従業員数※単体",), ("連結従業員数計",), ("員",), ("",), ("zz",)], "label string")
    assert dict(rows(mapping.map_labels(labels, aliases))) == {"本社(ＭＡＰ)": "本社所在地", "従業員数※単体": "従業員数", "連結従業員数計": "連結", "員": "連結", "": None, "zz": None}


def test_phone_upsert(spark):
    stored = spark.createDataFrame([("c", "1", "該当"), ("c", "2", "未確認")], "company string, number string, status string")
    new = spark.createDataFrame([("c", "1", "AI対応", 1), ("c", "2", "bad", 1), ("c", "2", "AI対応", 2), ("c", "2", "該当", 3), ("c", "3", "bad", 4)], "company string, number string, status string, pos int")
    assert rows(upsert.phone_upsert(stored, new)) == [("c", "1", "該当"), ("c", "2", "AI対応"), ("c", "3", "未確認")]


def test_fuzzy(spark):
    names = spark.createDataFrame([("アルファ商事",), ("アルファ商社",), ("アルファ商事株",), ("べつ",), (None,)], "name string")
    got = fuzzy.clusters(fuzzy.similar_pairs(names, 0.8))
    assert {r.name for r in got.collect()} == {"アルファ商事", "アルファ商社", "アルファ商事株"} and {r.cluster_id for r in got.collect()} == {1}


def test_fill_rates_empty(spark):
    empty = spark.createDataFrame([], "a string, scraped_at timestamp")
    assert quality.fill_rates(empty, "t").count() == 0
    df = spark.createDataFrame([("",), (None,), ("x",)], "a string")
    assert rows(quality.fill_rates(df, "t")) == [("t", "a", 1, 3, 0.3333)]


def test_metrics(spark):
    df = spark.createDataFrame([("1", '{"minkabu_ROE_2024": "3.5%", "売上高_2024": "1,000"}'), ("2", "[1]"), ("3", None)], "k string, j string")
    assert rows(reshape.clean_metrics(reshape.json_long(df, "k", "j"))) == [("1", "ROE_2024", "3.5"), ("1", "売上高_2024", "1000000000")]


def test_csv(spark, tmp_path):
    path = f"file://{tmp_path}/calls.csv"
    local = tmp_path / "calls.csv"
    local.write_bytes("﻿company_name,sales_rep_name,called_at,phone_number,phone_status,call_result\n甲,乙,2025/1/5 4:03,03,該当,\n,乙,2025-01-15,03,該当,\n甲,\"a\nb\",bad,03,該当,\n甲,乙,2025-01-15,03,?,\n".encode())
    good, errors = readers.checked_csv(spark, path, upsert.REQUIRED, upsert.validate_calls)
    assert [r.row_no for r in good.collect()] == [2]
    messages = dict(rows(errors))
    assert messages[3] == "必須列 'company_name' が空です" and list(messages) == [3, 4, 5]
    assert messages[4].startswith("called_at の日時形式が不正です: '") and messages[5].startswith("phone_status が不正です: '")
    local.write_text("a,b\n1,2\n")
    assert rows(readers.checked_csv(spark, path, ("c",))[1]) == [(0, "必須列がありません: c")]
    writers.csv_with_mark(spark.createDataFrame([], "a string, b string"), f"file://{tmp_path}/out.csv")
    assert (tmp_path / "out.csv").read_bytes().startswith(b"\xef\xbb\xbfa,b")


def test_services_and_append(spark, tmp_path):
    (tmp_path / "x.csv").write_text("企業名,タイトル,掲載日\n甲,,\n")
    assert rows(readers.services(spark, f"file://{tmp_path}", ["x", "y"]).select("service", "企業名")) == [("x", "甲")]
    assert not writers.append(spark.range(0), f"file://{tmp_path}/t") and writers.append(spark.range(2), f"file://{tmp_path}/t")
    assert writers.truncate(spark, [f"file://{tmp_path}/t"]) == {} and spark.read.parquet(f"file://{tmp_path}/t").count() == 0


def test_medallion_run(spark, tmp_path):
    from entitymill.plans.queries import demo_bronze

    bronze, out, now = f"file://{tmp_path}/bronze", f"file://{tmp_path}/gold", dt.datetime(2025, 1, 1)
    demo_bronze(spark, "/root/testdata/sf0.001", bronze)
    counts = medallion.run(spark, bronze, out, now, csv=True)
    assert counts["company_info"] == counts["company_master"] == 150
    assert counts["hr_services"] == 120
    info = commits.Table(spark, f"{out}/company_info").read()
    assert info.where("`企業規模` = '小'").count() == 150
    assert info.select("financial").first()[0] == {"売上高_2024年": "1000000000", "ROE_2024年": "3.5"}
    log = commits.Table(spark, f"{out}/logs").read()
    assert log.where("fill_rate < 0 OR fill_rate > 1").count() == 0 and log.count() > 100
    assert (tmp_path / "gold/csv/company_info.csv").exists() and not (tmp_path / "gold/csv/hr_services.csv").exists()


def test_jdbc(spark):
    """A database table, whole and with columns and filters pushed down, in the database that Spark ships."""
    url = "jdbc:derby:memory:entitymill;create=true"
    df = spark.createDataFrame([(i, f"n{i}", i % 3) for i in range(30)], "id int, name string, kind int")
    how = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df.write.format("jdbc").options(url=url, dbtable="things", createTableColumnTypes="name varchar(20)", **how).mode("overwrite").save()
    table = readers.jdbc_table(spark, url, "things", **how)
    assert rows(table) == rows(df)
    some = table.where("kind = 1").select("id")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert rows(some) == rows(df.where("kind = 1").select("id")) and "PushedFilters" in plan and "name" not in plan.split("ReadSchema")[-1]
