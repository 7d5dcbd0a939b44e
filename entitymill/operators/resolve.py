"""From names to entity ids, by stages; each stage works on what the ones before left.

Exact and normalised stages are equi-joins. The first entity that starts with a name is the name's
successor in sorted order. The entities that hold a name are those with a suffix that starts with it:
one range of the sorted suffixes, whose smallest id comes from block minima. So no name meets more than
one entity in the prefix stage, or a few hundred blocks in the other, however many match it; no stage
compares every name with every entity.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymill.operators.ordered import places, range_minima, successors
from entitymill.scratch import written


def exact(names: DataFrame, dim: DataFrame, name: str = "name", key: str = "name_normalized", id: str = "id") -> DataFrame:
    """names (distinct) with `id`, null where nothing matches; equal keys give the smallest id."""
    by = dim.groupBy(F.col(key).alias("_k")).agg(F.min(id).alias("id"))
    return names.join(by, F.col(name) == F.col("_k"), "left").drop("_k")


def cascade(names: DataFrame, dim: DataFrame, norm: Callable[[Column], Column], id: str = "id", key: str = "name_normalized", last: bool = False) -> DataFrame:
    """Exact, else by normal form of both sides; of equal normal forms the first id (or the last).
    An empty normal form matches nothing."""
    found = exact(names, dim, key=key, id=id).withColumn("_n", norm(F.col("name")))
    pick = F.max if last else F.min
    by = dim.select(norm(F.col(key)).alias("_k"), F.col(id).alias("_id")).where("_k <> ''").groupBy("_k").agg(pick("_id").alias("_id"))
    return found.join(by, F.col("_n") == F.col("_k"), "left").select("name", F.coalesce("id", "_id").alias("id"))


def by_prefix(names: DataFrame, dim: DataFrame, id: str = "id", key: str = "name_normalized") -> DataFrame:
    """Exact, else an entity whose name starts with the name: the first by name, then id."""
    by = dim.groupBy(F.col(key).alias("full")).agg(F.min(id).alias("id")).where("full IS NOT NULL")
    found = written(names.join(by, F.col("name") == F.col("full"), "left").select("name", "id"))
    rest = found.where(F.col("id").isNull() & (F.col("name") != "")).select("name", F.col("name").cast("binary").alias("at"))
    near = successors(by.select("full", F.col("id").alias("first"), F.col("full").cast("binary").alias("at")), rest, "at")
    best = near.where(F.startswith(F.col("next.full"), F.col("name"))).select("name", F.col("next.first").alias("_id"))
    return found.join(best, "name", "left").select("name", F.coalesce("id", "_id").alias("id"))


def containing(names: DataFrame, dim: DataFrame, id: str = "id", key: str = "name_normalized") -> DataFrame:
    """(name, id) of the first entity (by id) whose name holds the name."""
    asked = names.where("name <> ''").select("name").distinct()
    # no suffix is needed beyond the longest name that is asked for
    longest = asked.agg(F.coalesce(F.max(F.length("name")), F.lit(0))).first()[0]
    cut = F.transform(F.sequence(F.lit(1), F.length(key)), lambda i: F.substring(F.col(key), i, F.lit(longest)))
    full = dim.where(F.length(key) > 0).select(F.col(id).alias("id"), F.explode(F.array_distinct(cut)).alias("suffix"))
    keys = full.groupBy("suffix").agg(F.min("id").alias("id")).select(F.col("suffix").cast("binary").alias("at"), "id")
    # a name's range ends below the byte that no text has
    ends = asked.select("name", F.explode(F.array(F.struct(F.lit(0).alias("end"), F.col("name").cast("binary").alias("at")), F.struct(F.lit(1).alias("end"), F.concat(F.col("name").cast("binary"), F.unhex(F.lit("FF"))).alias("at")))).alias("x"))
    placed, probes = places(keys, ends.select("name", "x.end", "x.at"), "at")
    ranges = probes.groupBy("name").agg(F.min("place").alias("low"), F.max("place").alias("high")).where("low < high")
    return range_minima(placed, ranges, "id", ["name"])


def three_stages(names: DataFrame, dim: DataFrame, norm: Callable[[Column], Column], id: str = "id", key: str = "name_normalized") -> DataFrame:
    """Exact, else contained, else by normal form, where the last id wins."""
    found = exact(names, dim, key=key, id=id)
    inside = containing(found.where("id IS NULL").select("name"), dim, id, key).withColumnRenamed("id", "_in")
    by = dim.select(norm(F.col(key)).alias("_k"), F.col(id).alias("_id")).where("_k <> ''").groupBy("_k").agg(F.max("_id").alias("_norm"))
    rows = found.join(inside, "name", "left").withColumn("_n", norm(F.col("name")))
    return rows.join(by, F.col("_n") == F.col("_k"), "left").select("name", F.coalesce("id", "_in", "_norm").alias("id"))


def fill_ids(rows: DataFrame, resolved: DataFrame, name: str, id: str = "original_id") -> DataFrame:
    """rows with their missing ids filled from resolved (name, id)."""
    r = resolved.select(F.col("name").alias("_name"), F.col("id").alias("_found"))
    joined = rows.join(r, F.col(name) == F.col("_name"), "left")
    return joined.withColumn(id, F.coalesce(F.nullif(F.col(id), F.lit("")), F.col("_found"))).drop("_name", "_found")
