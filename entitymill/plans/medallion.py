"""From raw tables to gold tables: select and clean, keep the latest, resolve names, merge sources.

Every step is a lazy plan. An absent source is an empty frame of its columns, so schemas do not
depend on the data.

    python -m entitymill.plans.medallion --bronze DIR --out DIR [--csv-export] [--truncate]
"""

from __future__ import annotations

import argparse
import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymill.functions import text
from entitymill.functions.names import master_name
from entitymill.operators import dedupe, merge, quality, reshape, resolve
from entitymill.plans.config import COMPETITOR_SLOTS, MANY, PRIORITY, SERVICES, SILVER
from entitymill.sources import commits, readers, writers


def bronze(spark: SparkSession, folder: str, name: str, more: str = "id string, original_id string, scraped_at timestamp") -> DataFrame:
    path = f"{folder}/{name}.parquet"
    if readers.exists(spark, path):
        return spark.read.parquet(path)
    columns = ", ".join(f"`{c}` string" for c in SILVER.get(name, {}))
    return spark.createDataFrame([], f"{more}, {columns}" if columns else more)


def clean(df: DataFrame, config: dict[str, str], extra: tuple[str, ...] = ()) -> DataFrame:
    """original_id, the extra columns, those of the config through their cleaners, scraped_at."""
    cleaned = [text.CLEANERS[f](F.col(c) if c in df.columns else F.lit(None)).alias(c) for c, f in config.items()]
    return df.select("original_id", *extra, *cleaned, *(["scraped_at"] if "scraped_at" in df.columns else []))


def silver(spark: SparkSession, folder: str, dim: DataFrame) -> dict[str, DataFrame]:
    out = {}
    for name, config in SILVER.items():
        if name == "hr":
            continue
        raw = bronze(spark, folder, name)
        rows = clean(raw if name in MANY else dedupe.latest(raw, ["original_id"], "scraped_at", "id"), config, ("id",) if name in ("phones", "persons") else ())
        if name == "rikunabi_employ":
            for column, parse in (("女性管理職比率", text.female_ratio), ("育児休業取得者数", text.childcare_leave), ("過去3年間採用実績", text.retention)):
                source = dedupe.latest(raw, ["original_id"], "scraped_at", "id")
                if column in source.columns:
                    parsed = source.select("original_id", parse(F.col(column)).alias("_p")).select("original_id", "_p.*")
                    rows = rows.join(parsed, "original_id", "left")
        out[name] = rows
    financial = dedupe.latest(bronze(spark, folder, "minkabu", "id string, original_id string, scraped_at timestamp, financial_data string"), ["original_id"], "scraped_at", "id")
    out["minkabu"] = reshape.clean_metrics(reshape.json_long(financial, "original_id", "financial_data"))
    hr = reshape.union_services({s: bronze(spark, folder, f"hr_{s}", "id string, original_id string, `企業名_掲載名` string, `掲載日` string, scraped_at timestamp") for s in SERVICES}, "service_name")
    # within a service the latest row of each normal name, all blank names being one
    hr = dedupe.latest(hr.withColumn("_norm", master_name(F.col("企業名_掲載名"))), ["service_name", "_norm"], "scraped_at", "id")
    found = resolve.cascade(hr.select(F.col("_norm").alias("name")).distinct(), dim, master_name)
    hr = resolve.fill_ids(hr, found, "_norm").where(merge.present(F.col("original_id")))
    out["hr_services"] = clean(hr, SILVER["hr"], ("service_name",))
    calls = out["call_logs"]
    found = resolve.cascade(calls.select(F.col("company_name").alias("name")).where(merge.present(F.col("name"))).distinct(), dim, master_name)
    out["call_logs"] = resolve.fill_ids(calls, found, "company_name")
    return out


def company_info(master: DataFrame, s: dict[str, DataFrame], now: dt.datetime) -> DataFrame:
    sources = {n: s[n] for n in ("company_info", "ra_company", "ra_kyujin", "mynavi", "rikunabi_company", "rikunabi_employ", "caritasu", "prtimes", "en_hyouban")}
    mails = s["emails"].where(merge.present(F.col("メールアドレス"))).groupBy("original_id").agg(merge.distinct_list(F.col("メールアドレス")).alias("企業メールアドレス"))
    # a metric that came under two spellings of its name has its first value that is there, by text
    known = s["minkabu"].where(reduce(or_, [F.col("name").startswith(k) for k in reshape.METRIC_KEYS]))
    one = known.groupBy("original_id", "name").agg(F.coalesce(F.min(F.nullif("value", F.lit(""))), F.lit("")).alias("value"))
    metrics = one.groupBy("original_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias("financial"))
    joined = merge.join_sources(master.select("original_id", "name", "name_normalized", "stock_code"), sources).join(mails, "original_id", "left").join(metrics, "original_id", "left")
    fields = []
    for field, choices in PRIORITY.items():
        there = [F.col(f"`{c}`") for c in choices if c in joined.columns]
        fields.append((merge.first_present(*there) if there else F.lit(None).cast("string")).alias(field))
    return joined.select("original_id", F.col("name_normalized").alias("企業名"), F.nullif("stock_code", F.lit("")).alias("証券コード"), *fields, "企業メールアドレス", "financial", F.lit(now).alias("scraped_at"))


def flat_company_info(info: DataFrame) -> DataFrame:
    """company_info with a column for each metric and period that occurs, in the order of their names,
    in place of the map. Their names are few: metrics by periods."""
    names = reshape.column_names(info.select(F.explode(F.map_keys("financial"))), "metrics")
    at = info.columns.index("financial")
    flat = [F.try_element_at("financial", F.lit(n)).alias(n) for n in names]
    return info.select(*info.columns[:at], *flat, *info.columns[at + 1 :])


def phone_person(s: dict[str, DataFrame]) -> DataFrame:
    a = s["phones"].select(F.col("id").alias("phone_id"), F.col("担当者名リレーションキー").alias("person_id"))
    b = s["persons"].select(F.col("電話番号リレーションキー").alias("phone_id"), F.col("id").alias("person_id"))
    pairs = merge.edges(a, b, "phone_id", "person_id")
    return pairs.select("phone_id", "person_id", F.lit("scraping").alias("source"), F.lit(None).cast("timestamp").alias("confirmed_at"), F.lit(None).cast("string").alias("call_log_id"))


def competitors(s: dict[str, DataFrame], dim: DataFrame) -> DataFrame:
    rows = s["competitors"]
    names = rows.select(F.explode(F.array(*COMPETITOR_SLOTS)).alias("name")).where(merge.present(F.col("name"))).distinct()
    return reshape.names_to_ids(rows, "original_id", COMPETITOR_SLOTS, resolve.cascade(names, dim, master_name).where("id IS NOT NULL"))


def gold(spark: SparkSession, folder: str, now: dt.datetime) -> dict[str, DataFrame]:
    raw = bronze(spark, folder, "companies", "id string, name string, name_normalized string, stock_code string")
    dim = raw.select("id", "name_normalized")
    master = raw.select(F.col("id").alias("original_id"), *[F.coalesce(c, F.lit("")).alias(c) for c in ("name", "name_normalized", "stock_code")])
    s = silver(spark, folder, dim)
    return {
        "company_master": master, "company_info": company_info(master, s, now), "phones": s["phones"].drop("id"), "persons": s["persons"].drop("id"), "emails": s["emails"],
        "phone_person_relation": phone_person(s), "competitors": competitors(s, dim), "hr_services": s["hr_services"], "call_logs": s["call_logs"],
    }


def fill_rate_log(tables: dict[str, DataFrame], run_id: str, now: dt.datetime) -> DataFrame:
    parts = [quality.fill_rates(df, name) for name, df in tables.items()]
    log = parts[0]
    for p in parts[1:]:
        log = log.unionByName(p)
    return log.select(F.lit(run_id).alias("run_id"), F.lit(now).alias("run_at"), "*")


def raw_tables() -> list[str]:
    return [*(n for n in SILVER if n not in ("company_info", "hr")), "minkabu", *(f"hr_{s}" for s in SERVICES)]


def run(spark: SparkSession, folder: str, out: str, now: dt.datetime, csv: bool = False, empty: bool = False) -> dict[str, int]:
    """Commits all gold tables (master replaced, the rest appended) and the log as one run, then, if
    asked, writes CSV files and empties raw tables of what the run has read. Returns the rows of each
    table. A run that died goes on when it runs again with its `now`; one that is done changes nothing."""
    run_id = now.strftime("%Y%m%d%H%M%S")
    seen = {n: commits.listed(spark, f"{folder}/{n}.parquet") for n in raw_tables()} if empty else {}
    if commits.marked(spark, out, run_id) is None:
        frames = {}
        for name, df in gold(spark, folder, now).items():
            # computed once: the commit, the log and the counts read what is staged here
            path = f"{out}/_staged/{run_id}/{name}"
            if not readers.exists(spark, f"{path}/_SUCCESS"):
                df.write.mode("overwrite").parquet(path)
            frames[name] = spark.read.schema(df.schema).parquet(path)
        log = fill_rate_log(frames, run_id, now)
        how = {n: ("overwrite" if n == "company_master" else "append", df) for n, df in frames.items()}
        commits.commit_run(spark, out, run_id, how | {"logs": ("append", log)})
        commits.Files(spark, out).delete(f"{out}/_staged/{run_id}")
    made = commits.marked(spark, out, run_id)
    written = {n: changed_by(spark, f"{out}/{n}", v) for n, v in made.items()}
    counts = {n: df.count() for n, df in written.items() if n != "logs"}
    if csv:
        for name, df in written.items():
            if name not in ("hr_services", "logs") and counts[name]:
                writers.csv_with_mark(flat_company_info(df) if "financial" in df.columns else df, f"{out}/csv/{name}.csv")
        writers.csv_with_mark(written["logs"], f"{out}/csv/logs.csv")
    for name, files in seen.items():
        commits.empty_read_files(spark, f"{folder}/{name}.parquet", files)
    return counts


def changed_by(spark: SparkSession, path: str, version: int) -> DataFrame:
    """The rows that a version of a table added."""
    t = commits.Table(spark, path)
    found, before = t.manifest(version), t.manifest(version - 1) if version - 1 in t.versions() else None
    new = [f for f in found.folders if not before or f not in before.folders]
    return spark.read.schema(t.read(version).schema).parquet(*(f"{path}/data/{f}" for f in new))


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--bronze", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--csv-export", action="store_true")
    p.add_argument("--truncate", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("entitymill").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    for name, n in run(spark, a.bronze, a.out, dt.datetime.now(dt.timezone.utc), a.csv_export, a.truncate).items():
        print(f"{name}: {n}")


if __name__ == "__main__":
    main()
