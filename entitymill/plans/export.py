"""The committed tables as CSV files for people.

    python -m entitymill.plans.export --tables-dir DIR --output-dir DIR [--tables companies phones ...]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from entitymill.plans import call_import
from entitymill.sources import commits, exports, writers

#: Columns of stored tables that only exports read.
MORE = {
    "deals": "id string, company_id string, product_id int, assigned_rep_id string, status string, priority long, expected_revenue long, notes string, created_at timestamp",
    "company_info": "id string, original_id string, scraped_at timestamp",
    "company_reviews": "id string, original_id string, scraped_at timestamp, total_score string",
}


def tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    out = {n: call_import.stored(spark, folder, n) for n in call_import.TABLES}
    for n, columns in MORE.items():
        out[n] = commits.Table(spark, f"{folder}/{n}").read(schema=spark.createDataFrame([], columns).schema)
    return out


#: File names by what they hold.
FILES = {"companies": "companies_export.csv", "phones": "phone_numbers_export.csv", "persons": "persons_export.csv", "call_logs": "call_logs_export.csv", "deals": "deals_export.csv"}


def frame(t: dict[str, DataFrame], name: str) -> DataFrame:
    if name == "companies":
        return exports.companies(t["companies"], t["company_info"], t["company_reviews"])
    if name == "phones":
        return exports.phone_numbers(t["phone_numbers"], t["companies"])
    if name == "persons":
        return exports.persons(t["persons"], t["companies"])
    if name == "call_logs":
        return exports.call_logs(t["call_logs"].drop("pos"), t["companies"], t["sales_reps"], t["phone_numbers"], t["products"])
    return exports.deals(t["deals"], t["companies"], t["sales_reps"], t["products"])


def run(spark: SparkSession, folder: str, out: str, names: list[str] | None = None) -> list[str]:
    """Writes the files asked for (all, if none are named); returns their paths."""
    t, paths = tables(spark, folder), []
    for name in names or FILES:
        paths.append(f"{out}/{FILES[name]}")
        writers.csv_with_mark(frame(t, name), paths[-1])
    return paths


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--tables-dir", required=True)
    p.add_argument("--output-dir", required=True)
    p.add_argument("--tables", nargs="*", choices=list(FILES), default=list(FILES))
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("entitymill").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    for path in run(spark, a.tables_dir, a.output_dir, a.tables):
        print(path)


if __name__ == "__main__":
    main()
