"""Tables from files: validated CSV, unions of files by service, sitemaps, search results, JDBC."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymill.sources import csv_split

COMPANY_COLUMNS = ("企業名", "本社都道府県", "代表者名", "従業員数", "企業規模", "業種", "業種詳細", "代表電話番号")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in any file system that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def csv_file(spark: SparkSession, path: str, sep: str = ",", header: bool = True, columns: tuple[str, ...] = (), encoding: str = "UTF-8") -> DataFrame:
    """All columns as text, and row_no: the record's number in its file, from 2 with a header, else 1.
    A record may span lines; a byte order mark is dropped. A file in UTF-8 is read by a task for each of
    its splits; in another encoding by one task, so that numbers are those of its records in order."""
    if encoding.upper().replace("-", "") == "UTF8":
        return csv_split.split_csv_file(spark, path, sep, header, columns)
    return whole_csv_file(spark, path, sep, header, columns, encoding)


def whole_csv_file(spark: SparkSession, path: str, sep: str = ",", header: bool = True, columns: tuple[str, ...] = (), encoding: str = "UTF-8") -> DataFrame:
    """The same by Spark's own reader of records that span lines: a file is one partition."""
    reader = spark.read.option("sep", sep).option("multiLine", True).option("encoding", encoding).option("escape", '"').option("header", header)
    df = reader.schema(", ".join(f"`{c}` string" for c in columns)).csv(path) if columns and not header else reader.csv(path)
    first = 2 if header else 1
    return df.withColumn("row_no", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + first)


def checked_csv(spark: SparkSession, path: str, required: tuple[str, ...], validate=None, **how) -> tuple[DataFrame, DataFrame]:
    """(valid rows, errors as row and message). A missing column is the only error, at row 0."""
    df = csv_file(spark, path, **how)
    missing = sorted(set(required) - set(df.columns))
    if missing:
        return df.limit(0), spark.createDataFrame([(0, f"必須列がありません: {', '.join(missing)}")], "row long, message string")
    rows = validate(df) if validate else df.withColumn("error", F.lit(None).cast("string"))
    return rows.where("error IS NULL").drop("error"), rows.where("error IS NOT NULL").select(F.col("row_no").alias("row"), F.col("error").alias("message"))


def companies(spark: SparkSession, path: str, sep: str = "|", header: bool = True) -> DataFrame:
    return csv_file(spark, path, sep, header, COMPANY_COLUMNS)


def found_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("status") == "found")


def services(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """The listings of those services that have a file, with their service."""
    there = [n for n in names if exists(spark, f"{folder}/{n}.csv")]
    schema = "service string, `企業名` string, `タイトル` string, `掲載日` string"
    frames = [csv_file(spark, f"{folder}/{n}.csv").select(F.lit(n).alias("service"), "企業名", "タイトル", "掲載日") for n in there]
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)


def sitemap_ids(lines: DataFrame, column: str = "value", pattern: str = r"/companies/(\d+)") -> DataFrame:
    """Distinct numbers in a sitemap's text, in numeric order. spark.read.text opens gzip by itself."""
    ids = lines.select(F.explode(F.regexp_extract_all(column, F.lit(pattern), F.lit(1))).alias("id")).distinct()
    return ids.orderBy(F.col("id").cast("decimal(38,0)"))


def search_snippets(results: DataFrame) -> DataFrame:
    """company, query_no, rank, title, snippet, link to numbered snippets of at least 20 characters."""
    from entitymill.operators.periods import running_id

    text = F.trim(F.concat_ws(" ", "title", "snippet"))
    rows = results.withColumn("text", text).where(F.length("text") >= 20)
    return running_id(rows, ["company"], "query_no", "rank").select("company", "snippet_id", "text", F.col("link").alias("source_url"))


def jdbc_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A table of a database; filters and columns are pushed down by Spark."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def extracted(rows: DataFrame, column: str, schema: str) -> DataFrame:
    """Answers of a language model that were stored as text: code fences go, bad JSON is null."""
    bare = F.regexp_replace(F.col(column), r"(?s)^\s*```(?:json)?\s*|\s*```\s*$", "")
    return rows.withColumn(column, F.from_json(bare, schema))


def optional_csv(spark: SparkSession, path: str, columns: tuple[str, ...], sep: str = ",") -> DataFrame:
    """The columns of a CSV file, null where it lacks one; no rows if there is no file."""
    if not exists(spark, path):
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
    df = csv_file(spark, path, sep)
    return df.select(*[(F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string")).alias(c) for c in columns])


#: First parts of paths that are no company's.
NAVIGATION = (
    "stories", "knowhows", "companies", "feature", "categories", "recommended_stories", "privacy", "terms", "about", "contact", "law", "inquiry", "faq", "sitemap", "search",
)


def sitemap_slugs(urls: DataFrame, column: str, site: str) -> DataFrame:
    """Distinct first parts of the paths below a site, encoded, but for navigation and those that
    open with an underscore, in order."""
    slug = F.regexp_extract(F.trim(column), "^" + site.replace(".", "\\.") + "/([^/]+)", 1)
    rows = urls.select(slug.alias("slug")).where((F.col("slug") != "") & ~F.col("slug").startswith("_") & ~F.col("slug").isin(*NAVIGATION))
    return rows.select(F.replace(F.url_encode("slug"), F.lit("+"), F.lit("%20")).alias("slug")).distinct().orderBy("slug")


def answer_items(rows: DataFrame, key: str, column: str, item: str) -> DataFrame:
    """key, pos and the fields of each item of answers that were stored as text: a JSON list, or one
    object for a list of one. Bad JSON has no items. A field of an item with the key's name is
    replaced by the row's key."""
    bare = F.trim(F.regexp_replace(F.col(column), r"(?s)^\s*```(?:json)?\s*|\s*```\s*$", ""))
    listed = F.when(bare.startswith("["), bare).otherwise(F.concat(F.lit("["), bare, F.lit("]")))
    found = rows.select(F.col(key).alias("_key"), F.posexplode(F.from_json(listed, f"array<struct<{item}>>")).alias("pos", "item")).where("item IS NOT NULL")
    names = [f.name for f in found.schema["item"].dataType.fields if f.name != key]
    return found.select(F.col("_key").alias(key), "pos", *[F.col(f"item.`{n}`").alias(n) for n in names]).where(" OR ".join(f"`{n}` IS NOT NULL" for n in names))
