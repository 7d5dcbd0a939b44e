"""Import of a call log: what a file of calls adds and changes, as set operations.

Companies are resolved once for each distinct name. Whoever is missing (representatives, numbers,
persons) is added with an id made from its key, so that an import that runs again makes the same ids.
Of several calls to a number the last one decides; rows are ordered by `pos`, their place in the file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymill.operators import resolve
from entitymill.operators.merge import present
from entitymill.operators.upsert import UNKNOWN, call_time, person_roles
from entitymill.scratch import written

#: Sources of numbers and persons that an import adds.
CALLED, FOUND_BY_CALL = "架電", "架電判明"
LOG_COLUMNS = (
    "phone_status", "phone_status_memo", "discovered_number", "discovered_number_memo", "call_result", "spoke_with",
    "discovered_person_chuto", "discovered_person_shinsotsu", "notes",
)


@dataclass
class Imported:
    """Tables after an import (representatives, numbers, persons), its log, and its counts."""

    reps: DataFrame
    phones: DataFrame
    persons: DataFrame
    logs: DataFrame
    counts: DataFrame


def made_id(kind: str, *key: str) -> Column:
    return F.md5(F.to_json(F.array(F.lit(kind), *(F.col(k).cast("string") for k in key))))


def _with_missing(stored: DataFrame, new: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """stored (id, keys and more), and the rows of new whose keys it lacks."""
    fresh = new.join(stored.select(*keys), keys, "left_anti").withColumn("id", made_id(kind, *keys))
    return stored.unionByName(fresh, allowMissingColumns=True)


def import_calls(calls: DataFrame, companies: DataFrame, reps: DataFrame, products: DataFrame, phones: DataFrame, persons: DataFrame, zone: str = "Asia/Tokyo") -> Imported:
    """calls: pos, company_name, sales_rep_name, product_name, called_at (text), phone_number and
    LOG_COLUMNS. companies: id, name_normalized. reps, products: id, name. phones: id, company_id,
    number, status, status_detail, source. persons: id, company_id, name, role, source.

    Calls of unknown companies are counted as skipped. Times are read as those of `zone`."""
    found = resolve.by_prefix(calls.select(F.col("company_name").alias("name")).where(present(F.col("name"))).distinct(), companies)
    # read by each of the branches below
    rows = written(calls.join(found.select(F.col("name").alias("company_name"), F.col("id").alias("company_id")), "company_name", "left"))
    counts = rows.agg(F.count("company_id").alias("success"), F.count_if(F.col("company_id").isNull()).alias("skipped"))
    rows = rows.where("company_id IS NOT NULL")

    reps_after = written(_with_missing(reps, rows.select(F.col("sales_rep_name").alias("name")).distinct(), ["name"], "rep"))

    # numbers: called ones and, behind each, the one that the call found; the first sight names the source
    called = rows.select("company_id", F.col("phone_number").alias("number"), F.struct("pos", F.lit(0).alias("i")).alias("at"), F.lit(CALLED).alias("source"))
    heard = rows.where(present(F.col("discovered_number"))).select("company_id", F.col("discovered_number").alias("number"), F.struct("pos", F.lit(1).alias("i")).alias("at"), F.lit(FOUND_BY_CALL).alias("source"))
    sighted = called.unionByName(heard).groupBy("company_id", "number").agg(F.min_by("source", "at").alias("source")).withColumn("status", F.lit(UNKNOWN))
    known = _with_missing(phones, sighted, ["company_id", "number"], "phone")
    told = F.when(F.col("phone_status") != UNKNOWN, F.col("pos"))
    noted = F.when(present(F.col("phone_status_memo")), told)
    last = rows.groupBy("company_id", F.col("phone_number").alias("number")).agg(F.max_by("phone_status", told).alias("_s"), F.max_by("phone_status_memo", noted).alias("_d"))
    phones_after = written(known.join(last, ["company_id", "number"], "left").withColumns({"status": F.coalesce("_s", "status"), "status_detail": F.coalesce("_d", "status_detail")}).drop("_s", "_d"))

    roles = person_roles(rows.withColumnRenamed("company_id", "company"), "pos").select(F.col("company").alias("company_id"), "name", F.col("role").alias("_role"))
    people = _with_missing(persons, roles.select("company_id", "name", F.lit(FOUND_BY_CALL).alias("source")), ["company_id", "name"], "person")
    persons_after = people.join(roles, ["company_id", "name"], "left").withColumn("role", F.coalesce("_role", "role")).drop("_role")

    logs = (
        rows.join(phones_after.select("company_id", F.col("number").alias("phone_number"), F.col("id").alias("phone_number_id")), ["company_id", "phone_number"])
        .join(reps_after.select(F.col("name").alias("sales_rep_name"), F.col("id").alias("sales_rep_id")), "sales_rep_name")
        .join(products.select(F.col("name").alias("product_name"), F.col("id").alias("product_id")), "product_name", "left")
        .select("pos", "company_id", "phone_number_id", "sales_rep_id", "product_id", F.to_utc_timestamp(call_time(F.col("called_at")), zone).alias("called_at"), *LOG_COLUMNS)
    )
    return Imported(reps_after, phones_after.select(*phones.columns), persons_after.select(*persons.columns), logs.withColumn("id", made_id("call", "company_id", "pos")), counts)
