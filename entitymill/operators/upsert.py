"""Row-by-row imports as set operations: the effect of all rows of a file, in their order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Status that a number has until a call tells more; the others that it can get.
UNKNOWN = "未確認"
PHONE_STATUS = (UNKNOWN, "該当", "使われてない", "AI対応", "別会社・別拠点・別事業部")
CALL_RESULT = ("不在", "受付ブロック", "着電NG", "獲得見込み", "資料請求", "アポ", "架電NG")
REQUIRED = ("company_name", "sales_rep_name", "called_at", "phone_number", "phone_status")


def overwrite_rows(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows replace old ones of the same key entirely."""
    return old.join(new, key, "left_anti").unionByName(new)


def company_upsert(master: DataFrame, rows: DataFrame) -> DataFrame:
    """master: name, stock_code. rows: name, stock_code, pos. New names come in; a code is filled
    only where none is."""
    code = F.nullif(F.col("stock_code"), F.lit(""))
    new = rows.where(F.col("name") != "").groupBy("name").agg(F.min_by(code, F.when(code.isNotNull(), F.col("pos"))).alias("_code"))
    joined = master.join(new, "name", "full_outer")
    return joined.select("name", F.coalesce(F.nullif("stock_code", F.lit("")), F.col("_code")).alias("stock_code"))


def phone_upsert(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """stored: company, number, status. rows: company, number, status, pos. A known status stays; an
    unknown one takes the first known that the rows give. An invalid status is unknown."""
    status = F.when(F.col("status").isin(*PHONE_STATUS), F.col("status")).otherwise(F.lit(UNKNOWN))
    every = stored.select("company", "number", status.alias("status"), F.lit(-1).cast("long").alias("pos")).unionByName(rows.select("company", "number", status.alias("status"), F.col("pos").cast("long").alias("pos")))
    known = F.when(F.col("status") != UNKNOWN, F.col("pos"))
    return every.groupBy("company", "number").agg(F.coalesce(F.min_by("status", known), F.lit(UNKNOWN)).alias("status"))


def call_effects(calls: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """Per phone: the last status that tells something, the last memo beside such a status that is not
    blank, and the number of calls. A phone of which nothing was told has no status."""
    told = F.when(F.col("status") != UNKNOWN, F.col(pos))
    noted = F.when((F.col("memo").isNotNull()) & (F.col("memo") != ""), told)
    return calls.groupBy(*keys).agg(F.max_by("status", told).alias("status"), F.max_by("memo", noted).alias("status_detail"), F.count("*").alias("n_calls"))


def person_roles(calls: DataFrame, pos: str) -> DataFrame:
    """Persons that calls found, by company and name. One name in both roles of a call has the joint
    role; otherwise the last role of the last row stands."""
    a, b = F.col("discovered_person_chuto"), F.col("discovered_person_shinsotsu")
    some = lambda c: c.isNotNull() & (c != "")
    one = lambda c, role, i: F.when(some(c), F.struct(c.alias("name"), F.lit(role).alias("role"), F.lit(i).alias("i")))
    both = F.array(one(a, "中途・新卒採用担当", 0))
    each = F.array(one(a, "中途採用担当", 0), one(b, "新卒採用担当", 1))
    rows = calls.withColumn("_p", F.explode(F.array_compact(F.when(some(a) & (a == b), both).otherwise(each))))
    return rows.groupBy("company", F.col("_p.name").alias("name")).agg(F.max_by(F.col("_p.role"), F.struct(F.col(pos), F.col("_p.i"))).alias("role"))


def insert_absent(stored: DataFrame, rows: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """Rows to insert: the first of each key that is not stored; null equals null."""
    from entitymill.operators.dedupe import first_seen, not_stored

    return not_stored(first_seen(rows, keys, pos), stored.select(*keys), keys)


def validate(rows: DataFrame, checks: list[tuple[Column, Column | str]]) -> DataFrame:
    """rows with `error`: the message of the first check that fails, else null."""
    return rows.withColumn("error", F.coalesce(*(F.when(bad, message if isinstance(message, Column) else F.lit(message)) for bad, message in checks), F.lit(None).cast("string")))


def validate_calls(rows: DataFrame) -> DataFrame:
    """Rows of a call file with `error`: missing fields in the order of REQUIRED, then the time, then
    the two closed lists."""
    bare = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    checks = [(bare(c).isNull(), f"必須列 '{c}' が空です") for c in REQUIRED]
    said = lambda c, what, hint: F.concat(F.lit(f"{c} {what}: '"), F.coalesce(c if c == "called_at" else bare(c), F.lit("")), F.lit(f"' ({hint})"))
    checks.append((call_time(bare("called_at")).isNull(), said("called_at", "の日時形式が不正です", "例: 2025-01-15 14:30")))
    checks += [(~bare(c).isin(*allowed), said(c, "が不正です", f"許容値: {', '.join(allowed)}")) for c, allowed in (("phone_status", PHONE_STATUS[1:]), ("call_result", CALL_RESULT))]
    return validate(rows, checks)


def call_time(c: Column) -> Column:
    """A time in one of the six forms of the import file, else null; as given, without a zone."""
    forms = [f"{day} {time}" for day in ("yyyy-M-d", "yyyy/M/d") for time in ("H:m:s", "H:m")] + ["yyyy-M-d", "yyyy/M/d"]
    return F.coalesce(*(F.try_to_timestamp(c, F.lit(f)) for f in forms))


def outcomes(rows: DataFrame, outcome: Column) -> DataFrame:
    """Rows by outcome of an import."""
    return rows.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))
