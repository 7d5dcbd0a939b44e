"""The five sales exports, as frames in their columns and order; write them with writers.csv_with_mark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitymill.operators.dedupe import latest
from entitymill.sources.writers import shown

#: Columns of the exports.
PROFILE = ("本社都道府県", "代表者名", "従業員数", "企業規模", "業種", "業種詳細", "代表電話番号")
REVIEWS = (
    "total_score", "review_count", "avg_salary", "avg_age", "score_growth", "score_advantage", "score_meritocracy", "score_culture",
    "score_youth", "score_contribution", "score_innovation", "score_leadership", "reviews_text",
)
PHONES = ("phone_id", "company_name", "phone_number", "label", "status", "status_detail", "source", "created_at")
PERSONS = ("person_id", "company_name", "person_name", "department", "role", "email", "is_decision_maker", "notes", "source", "created_at")
CALLS = (
    "call_id", "company_name", "sales_rep_name", "product_name", "called_at", "phone_number", "phone_status", "phone_status_memo", "discovered_number",
    "discovered_number_memo", "call_result", "spoke_with", "discovered_person_chuto", "discovered_person_shinsotsu", "notes",
)
DEALS = ("deal_id", "company_name", "product_name", "assigned_rep", "status", "priority", "expected_revenue", "notes", "created_at")


def _names(df: DataFrame, key: str, name: str, source: str = "name") -> DataFrame:
    return df.select(F.col("id").alias(key), F.col(source).alias(name))


def _shown(df: DataFrame, columns: tuple[str, ...], *order) -> DataFrame:
    """The columns as shown, in an order that is set on the stored values."""
    missing = {c: F.lit(None).cast("string") for c in columns if c not in df.columns}
    return shown(df.withColumns(missing).orderBy(*order), list(columns))


def companies(companies: DataFrame, info: DataFrame, reviews: DataFrame) -> DataFrame:
    """The master with the latest profile and the latest review figures of each company."""
    last = lambda df: latest(df, ["original_id"], "scraped_at", "id").withColumnRenamed("original_id", "company_id")
    rows = companies.select(F.col("id").alias("company_id"), F.col("name_normalized").alias("企業名"), F.col("stock_code").alias("証券コード"), F.col("created_at").alias("登録日時"))
    rows = rows.join(last(info).select("company_id", *[c for c in PROFILE if c in info.columns]), "company_id", "left")
    rows = rows.join(last(reviews).select("company_id", *[F.col(c).alias(f"en_{c}") for c in REVIEWS if c in reviews.columns]), "company_id", "left")
    return _shown(rows, ("company_id", "企業名", "証券コード", *PROFILE, *(f"en_{c}" for c in REVIEWS), "登録日時"), "企業名", "company_id")


def phone_numbers(phones: DataFrame, companies: DataFrame) -> DataFrame:
    rows = phones.withColumnsRenamed({"id": "phone_id", "number": "phone_number"}).join(_names(companies, "company_id", "company_name", "name_normalized"), "company_id")
    return _shown(rows, PHONES, "company_name", "phone_number", "phone_id")


def persons(persons: DataFrame, companies: DataFrame) -> DataFrame:
    rows = persons.withColumnsRenamed({"id": "person_id", "name": "person_name"}).join(_names(companies, "company_id", "company_name", "name_normalized"), "company_id")
    flag = F.coalesce(F.col("is_decision_maker"), F.lit(False)) if "is_decision_maker" in persons.columns else F.lit(False)
    return _shown(rows.withColumn("is_decision_maker", flag), PERSONS, "company_name", "person_name", "person_id")


def call_logs(logs: DataFrame, companies: DataFrame, reps: DataFrame, phones: DataFrame, products: DataFrame) -> DataFrame:
    rows = logs.withColumnRenamed("id", "call_id").join(_names(companies, "company_id", "company_name", "name_normalized"), "company_id").join(_names(reps, "sales_rep_id", "sales_rep_name"), "sales_rep_id")
    rows = rows.join(_names(phones, "phone_number_id", "phone_number", "number"), "phone_number_id", "left").join(_names(products, "product_id", "product_name"), "product_id", "left")
    return _shown(rows, CALLS, F.desc("called_at"), "call_id")


def deals(deals: DataFrame, companies: DataFrame, reps: DataFrame, products: DataFrame) -> DataFrame:
    rows = deals.withColumnRenamed("id", "deal_id").join(_names(companies, "company_id", "company_name", "name_normalized"), "company_id")
    rows = rows.join(_names(reps, "assigned_rep_id", "assigned_rep"), "assigned_rep_id", "left").join(_names(products, "product_id", "product_name"), "product_id", "left")
    return _shown(rows, DEALS, "status", "company_name", "deal_id")
