"""One row for each key, in a defined order.

`latest` is an aggregate with map-side combine (max_by over a struct), so a hot key is reduced before
the shuffle. Since its buffer holds structs and text, Spark runs it as a sort aggregate: rows are
sorted by key before and after the shuffle, but what crosses it is a row for each key and task. Windows
remain where several rows of a key survive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def _best(df: DataFrame, keys: list[str], order: Column, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(pick(F.struct(*rest), order).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest]).select(*df.columns)


def latest(df: DataFrame, keys: list[str], when: str, tie: str) -> DataFrame:
    """The newest row of each key; rows without a time are oldest, equal times go to the larger tie.
    Null keys are one key."""
    return _best(df, keys, F.struct(F.col(when).isNotNull(), F.col(when), F.col(tie)), F.max_by)


def first_seen(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """The first row of each key by position."""
    return _best(df, keys, F.col(pos), F.min_by)


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key, with their rank."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)


def latest_join_back(df: DataFrame, key: str, when: str) -> DataFrame:
    """Every row whose time is its key's newest: ties give several rows, rows without a time none."""
    newest = df.groupBy(key).agg(F.max(when).alias("_newest")).withColumnRenamed(key, "_key")
    return df.join(newest, (F.col(key) == F.col("_key")) & (F.col(when) == F.col("_newest"))).drop("_key", "_newest")


def snippets(df: DataFrame, phones: str, pos: str) -> DataFrame:
    """Snippets with one phone stay once per phone; all others stay. Singles come first."""
    single = F.size(phones) == 1
    own = df.where(single).withColumn("_phone", F.get(phones, F.lit(0)))
    own = first_seen(own, ["_phone"], pos).drop("_phone").withColumn("part", F.lit(0))
    return own.unionByName(df.where(~single).withColumn("part", F.lit(1)))


def url_key(url: Column) -> Column:
    """A url without its query and trailing slashes."""
    return F.regexp_replace(F.substring_index(url, "?", 1), "/+$", "")


def contact_results(df: DataFrame, kind: Column, value: Column, pos: str) -> DataFrame:
    """First of each contact by its comparable form: digits of phones, small letters of addresses,
    name and department of persons. Rows without a comparable form go."""
    keyed = df.withColumn("_key", value).where(F.col("_key").isNotNull()).withColumn("_kind", kind)
    return first_seen(keyed, ["_kind", "_key"], pos)


def not_stored(new: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new whose key is not stored; null equals null."""
    same = F.lit(True)
    for k in keys:
        same = same & new[k].eqNullSafe(stored[k])
    return new.join(stored, same, "left_anti")
