"""Several sources into one row: by priority of source, by media, by what is still missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts that a media source gives where it has nothing.
EMPTY = ("", "-", "null", "なし")


def present(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def or_blank(df: DataFrame, name: str) -> Column:
    """A column of df, "" where it is null or absent."""
    return F.coalesce(F.col(name), F.lit("")) if name in df.columns else F.lit("")


def first_present(*sources: Column) -> Column:
    """The first source that is neither null nor blank."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in sources))


def prefixed(df: DataFrame, prefix: str, key: str = "original_id") -> DataFrame:
    """df with its columns named by source, so that no later join depends on the order of sources."""
    return df.select(F.col(key), *[F.col(c).alias(f"{prefix}.{c}") for c in df.columns if c not in (key, "scraped_at")])


def join_sources(master: DataFrame, sources: dict[str, DataFrame], key: str = "original_id") -> DataFrame:
    """Left joins of all sources on the key. An empty source is a typed empty frame: its columns exist."""
    out = master
    for prefix, df in sources.items():
        out = out.join(prefixed(df, prefix, key), key, "left")
    return out


def media_priority(values: DataFrame, priority: DataFrame) -> DataFrame:
    """values: entity, media, canonical, value, media_pos. priority: canonical, media, priority.
    One value for each entity and canonical: by the canonical's priority of media, then by the media's
    place. The aggregate needs no sort, and combines before the shuffle."""
    usable = values.where(F.col("value").isNotNull() & ~F.trim("value").isin(*EMPTY))
    rank = F.coalesce(F.col("priority"), F.lit(1000) + F.col("media_pos"))
    ranked = usable.join(priority, ["canonical", "media"], "left").withColumn("_rank", F.struct(rank, F.col("media_pos")))
    best = ranked.groupBy("entity", "canonical").agg(F.min_by(F.struct("value", "media"), "_rank").alias("b"))
    return best.select("entity", "canonical", "b.value", "b.media")


def fill_missing(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """old, with blank columns taken from new."""
    other = new.select(F.col(key), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = old.join(other, key, "left")
    return joined.select(*[F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"_new_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in old.columns])


def distinct_list(c: Column) -> Column:
    """Aggregate: distinct texts in code point order, joined."""
    return F.array_join(F.array_sort(F.collect_set(c)), ", ")


def edges(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """Both directions of a relation as one distinct set of (a, b)."""
    return left.select(a, b).unionByName(right.select(a, b)).where(present(F.col(a).cast("string")) & present(F.col(b).cast("string"))).distinct()


def stock_codes(rows: DataFrame, companies: DataFrame, name: str, code: str = "証券コード") -> DataFrame:
    """Rows of companies that have a stock code, with it."""
    known = companies.where(present(F.col("stock_code"))).groupBy(F.col("name_normalized").alias(name)).agg(F.max("stock_code").alias(code))
    return rows.join(known, name)


def prompts(snippets: DataFrame, group: list[str], number: str, parts: dict[str, str], size: int = 5, limit: int = 800, head: str = "", tail: str = "") -> DataFrame:
    """One text for each batch of `size` snippets of a group: head, then each snippet as a block of
    `label: text` lines with its text cut to `limit`, then tail. parts: label to column."""
    lines = [F.concat(F.lit(f"{label}: "), F.coalesce(F.left(F.col(c).cast("string"), F.lit(limit)), F.lit(""))) for label, c in parts.items()]
    block = F.concat_ws("\n", F.concat(F.lit("["), F.col(number).cast("string"), F.lit("]")), *lines)
    rows = snippets.withColumn("batch", F.floor(F.col(number) / size)).groupBy(*group, "batch").agg(F.array_sort(F.collect_list(F.struct(F.col(number).alias("n"), block.alias("b")))).alias("x"))
    text = F.concat_ws("\n\n", *([F.lit(head)] if head else []), F.array_join(F.transform("x", lambda r: r["b"]), "\n\n"), *([F.lit(tail)] if tail else []))
    return rows.select(*group, "batch", F.size("x").alias("n_snippets"), text.alias("prompt"))
