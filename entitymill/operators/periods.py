"""Order-dependent measures: growth, blocks of pages, repeated pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def growth(df: DataFrame, keys: list[str], period: str, value: str) -> DataFrame:
    """Percent change on the period before; none without one, or if it was zero."""
    before = F.lag(value).over(W.partitionBy(*keys).orderBy(period))
    rows = df.withColumn("_before", before).where(F.col("_before").isNotNull() & (F.col("_before") != 0))
    return rows.select(*keys, period, ((F.col(value) - F.col("_before")) / F.abs("_before") * 100).alias("growth_pct"))


def new_rate(df: DataFrame, key: str, page: str, block: int = 20) -> DataFrame:
    """Share of keys per block of pages that no page before showed."""
    seen = df.groupBy(key).agg(F.min(page).alias("_first"))
    rows = df.select(key, page).join(seen, key)
    return rows.groupBy(F.floor((F.col(page) - 1) / block).alias("block")).agg(F.count("*").alias("n"), F.count_if(F.col(page) == F.col("_first")).alias("n_new"))


def repeated_pages(df: DataFrame, group: list[str], page: str, name: str) -> DataFrame:
    """Pages that show the same set of names as the page before."""
    sets = df.groupBy(*group, page).agg(F.array_sort(F.collect_set(name)).alias("names"))
    before = F.lag("names").over(W.partitionBy(*group).orderBy(page))
    return sets.withColumn("repeats", F.coalesce(F.col("names") == before, F.lit(False))).select(*group, page, "repeats")


def running_id(df: DataFrame, group: list[str], *order: str) -> DataFrame:
    return df.withColumn("snippet_id", F.row_number().over(W.partitionBy(*group).orderBy(*order)) - 1)


def block_rates(df: DataFrame, key: str, page: str, block: int = 20, first_check: int = 50, least: float = 0.05) -> DataFrame:
    """block (its last page), n, n_new, rate and stop of each whole block of pages: a scan ends at the
    first block from page `first_check` on whose share of new keys is below `least`. A key is new at
    its first row of a page that no page before had."""
    first = df.groupBy(key).agg(F.min(page).alias("_first"))
    news = first.groupBy((F.ceil(F.col("_first") / block) * block).alias("_b")).agg(F.count("*").alias("n_new"))
    every = df.groupBy((F.ceil(F.col(page) / block) * block).alias("block")).agg(F.count("*").alias("n"), F.countDistinct(page).alias("_pages"))
    rows = every.where(F.col("_pages") == block).join(news, F.col("block") == F.col("_b"), "left").select("block", "n", F.coalesce("n_new", F.lit(0)).alias("n_new"))
    rows = rows.withColumn("rate", F.col("n_new") / F.col("n"))
    low = F.when((F.col("block") >= first_check) & (F.col("rate") < least), F.col("block"))
    # one row for a block of pages: the only window without a key stands on these
    return rows.withColumn("stop", F.coalesce(F.col("block") == F.min(low).over(W.partitionBy()), F.lit(False)))
