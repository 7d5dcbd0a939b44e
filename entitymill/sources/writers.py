"""Results to files: warehouse tables, CSV with a byte order mark, exports in fixed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitymill.sources import csv_split
from entitymill.sources.readers import exists


def append(df: DataFrame, path: str, partition: list[str] | None = None) -> bool:
    """Appends unless df is empty; returns whether it did."""
    if df.isEmpty():
        return False
    writer = df.write.mode("append")
    (writer.partitionBy(*partition) if partition else writer).parquet(path)
    return True


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def truncate(spark, paths: list[str]) -> dict[str, str]:
    """Empties tables, keeping their columns; a table that fails is reported and the rest go on."""
    failed = {}
    for path in paths:
        try:
            if exists(spark, path):
                schema = spark.read.parquet(path).schema
                spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
        except Exception as e:  # noqa: BLE001
            failed[path] = str(e).splitlines()[0]
    return failed


def csv_with_mark(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """One CSV file that opens with a byte order mark, header also without rows; nulls are blank."""
    csv_split.write_one_csv(df, path, columns)


def shown_time(column: str) -> F.Column:
    return F.coalesce(F.date_format(column, "yyyy-MM-dd HH:mm"), F.lit(""))


def shown(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Columns as an export shows them: missing, zero and false are blank but for flags. Those to
    keep stay as they are."""
    out = [F.col(c) for c in keep or ()]
    for c in columns:
        kind = df.schema[c].dataType.simpleString()
        if kind == "timestamp":
            out.append(shown_time(c).alias(c))
        elif kind == "boolean":
            out.append(F.when(F.col(c), "TRUE").otherwise("FALSE").alias(c))
        elif kind in ("int", "bigint"):
            out.append(F.when(F.col(c) != 0, F.col(c).cast("string")).otherwise("").alias(c))
        else:
            out.append(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c))
    return df.select(*out)


def service_files(rows: DataFrame, folder: str, service: str, name: str, pos: str) -> DataFrame:
    """Two files of a listing: <service>_raw.csv with every row, <service>.csv with the first row of
    each name, in the order of pos. Returns the second's rows."""
    from entitymill.operators.dedupe import first_seen

    columns = [c for c in rows.columns if c != pos]
    csv_with_mark(rows.orderBy(pos), f"{folder}/{service}_raw.csv", columns)
    unique = first_seen(rows.withColumn(name, F.coalesce(name, F.lit(""))), [name], pos)
    csv_with_mark(unique.orderBy(pos), f"{folder}/{service}.csv", columns)
    return unique


def drop_tables(spark, paths: list[str], dry_run: bool = True, guarded: tuple[str, ...] = ("call_logs",), also_guarded: bool = False) -> dict[str, str]:
    """What becomes of each table: dropped, would be dropped (dry run), absent, or kept since its
    name is guarded."""
    out = {}
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if p.getName().split(".")[0] in guarded and not also_guarded:
            out[path] = "kept"
        elif not fs.exists(p):
            out[path] = "absent"
        else:
            out[path] = "would be dropped" if dry_run else "dropped"
            if not dry_run:
                fs.delete(p, True)
    return out


#: Columns of the file in which people choose names for clusters.
REVIEW_COLUMNS = ("クラスタID", "企業名", "採用名（空欄=要判断）")


def review_file(clusters: DataFrame, path: str) -> None:
    """Clusters (cluster_id, name) as a CSV file in their order, with a blank column for the choice."""
    rows = clusters.orderBy("cluster_id", "name").select("cluster_id", "name", F.lit("").alias("choice"))
    csv_with_mark(rows.toDF(*REVIEW_COLUMNS), path)


def create_tables(spark, schemas: dict[str, str], folder: str) -> None:
    """Tables of the session's catalog over files below a folder, unless they are there."""
    for name, columns in schemas.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}) USING parquet LOCATION '{folder}/{name}'")


def drop_all(spark, names: list[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
