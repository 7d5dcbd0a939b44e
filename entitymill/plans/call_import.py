"""A call file into the committed tables.

    python -m entitymill.plans.call_import --csv FILE --tables DIR [--dry-run] [--error-out FILE]

DIR holds the tables companies, sales_reps, products, phone_numbers, persons and call_logs. All that a
file changes is committed as one run named after the file's content, so a file that is imported again,
or after an import that died, changes nothing twice.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymill.operators import calls, upsert
from entitymill.scratch import written
from entitymill.sources import commits, readers, writers

#: Columns of the stored tables.
TABLES = {
    "companies": "id string, name_normalized string, stock_code string, created_at timestamp",
    "sales_reps": "id string, name string",
    "products": "id int, name string",
    "phone_numbers": "id string, company_id string, number string, status string, status_detail string, source string",
    "persons": "id string, company_id string, name string, role string, source string",
    "call_logs": "id string, pos long, company_id string, phone_number_id string, sales_rep_id string, product_id int, called_at timestamp, " + ", ".join(f"{c} string" for c in calls.LOG_COLUMNS),
}
COLUMNS = (*upsert.REQUIRED[:4], "product_name", *calls.LOG_COLUMNS)


@dataclass
class Outcome:
    """Rows that passed and that did not, and, unless it was a dry run, calls stored and skipped."""

    valid: int
    errors: int
    success: int | None = None
    skipped: int | None = None


def read_calls(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(calls, errors as row and message) of a file: fields without blanks around them, blank ones null."""
    whole = lambda df: df.withColumns({c: F.lit(None).cast("string") for c in COLUMNS if c not in df.columns})
    good, errors = readers.checked_csv(spark, path, upsert.REQUIRED, lambda df: upsert.validate_calls(whole(df)))
    bare = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    columns = dict.fromkeys(COLUMNS)
    if not set(upsert.REQUIRED) <= set(good.columns):
        return spark.createDataFrame([], "pos long, " + ", ".join(f"{c} string" for c in columns)), errors
    return good.select(F.col("row_no").alias("pos"), *(bare(c).alias(c) for c in columns)), errors


def stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    empty = spark.createDataFrame([], TABLES[name])
    return commits.Table(spark, f"{folder}/{name}").read(schema=empty.schema)


def run_id_of(spark: SparkSession, path: str) -> str:
    """A name for the file's content."""
    rows = spark.read.text(path).select(F.xxhash64("value").alias("h"))
    n, total, mixed = rows.agg(F.count("*"), F.sum(F.col("h").cast("decimal(38,0)")), F.bit_xor("h")).first()
    return f"calls-{n}-{total}-{mixed}"


def run(spark: SparkSession, path: str, folder: str, dry_run: bool = False, error_out: str | None = None) -> Outcome:
    rows, errors = read_calls(spark, path)
    rows, errors = written(rows), written(errors)
    done = Outcome(rows.count(), errors.count())
    if error_out and done.errors:
        writers.csv_with_mark(errors.orderBy("row"), error_out)
    if dry_run or not done.valid:
        return done
    run_id = run_id_of(spark, path)
    if commits.marked(spark, folder, run_id) is None:
        before = {n: stored(spark, folder, n) for n in TABLES}
        # where a run died between two tables, those that it has changed are taken as they were before
        for n in ("sales_reps", "phone_numbers", "persons"):
            t = commits.Table(spark, f"{folder}/{n}")
            if (version := t.run_version(run_id)) is not None:
                before[n] = t.read(version - 1, schema=before[n].schema) if version > 1 else spark.createDataFrame([], TABLES[n])
        made = calls.import_calls(rows, before["companies"].select("id", "name_normalized"), before["sales_reps"], before["products"], before["phone_numbers"], before["persons"])
        counts = made.counts.first()
        logs = made.logs.select(*before["call_logs"].columns)
        frames = {"sales_reps": ("overwrite", made.reps), "phone_numbers": ("overwrite", made.phones), "persons": ("overwrite", made.persons), "call_logs": ("append", logs)}
        commits.commit_run(spark, folder, run_id, frames)
        done.success, done.skipped = counts["success"], counts["skipped"]
    else:
        done.success = done.skipped = 0
    return done


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--csv", required=True)
    p.add_argument("--tables", required=True)
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--error-out")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("entitymill").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if not readers.exists(spark, a.csv):
        raise SystemExit(f"no such file: {a.csv}")
    print(run(spark, a.csv, a.tables, a.dry_run, a.error_out))


if __name__ == "__main__":
    main()
