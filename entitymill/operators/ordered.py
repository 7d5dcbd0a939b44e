"""Places in sorted order, and minima over ranges of it, without a task that sees all rows.

`places` deals keys and probes by range, so that a task sorts a stretch of both; what stands before a
stretch is the sum of the stretches before it, of which there are as many as partitions. A probe's
place is the number of keys below it, so the key with that number is its successor.

`range_minima` answers the minimum of a value over a range of places by a tree of block minima: a
level has one row for each FAN rows of the level below it, and a range is cut into at most 2 FAN
blocks for each level, however long it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from entitymill.scratch import written

FAN = 64


def places(keys: DataFrame, probes: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """keys (no two equal) with `place`, their number in order from 0, and probes with `place`, the
    number of keys below them; on: a binary or string column of both."""
    k, p = keys.select(F.lit(1).alias("_key"), F.col(on).alias("_on"), F.struct(*keys.columns).alias("_k")), probes.select(F.lit(0).alias("_key"), F.col(on).alias("_on"), F.struct(*probes.columns).alias("_p"))
    # at equal values the probe comes first
    dealt = k.unionByName(p, allowMissingColumns=True).repartitionByRange("_on").withColumn("_part", F.spark_partition_id())
    rows = written(dealt)
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # a row for each partition
    parts = rows.groupBy("_part").agg(F.sum("_key").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = W.partitionBy("_part").orderBy("_on", "_key").rowsBetween(W.unboundedPreceding, -1)
    found = rows.withColumn("_in", F.coalesce(F.sum("_key").over(inside), F.lit(0))).join(F.broadcast(parts), "_part")
    found = written(found.select("_key", "_k", "_p", (F.col("_base") + F.col("_in")).alias("place")))
    return found.where("_key = 1").select("_k.*", "place"), found.where("_key = 0").select("_p.*", "place")


def successors(keys: DataFrame, probes: DataFrame, on: str) -> DataFrame:
    """probes with the first key at or above them, as the struct `next` (null behind the last key)."""
    k, p = places(keys, probes, on)
    return p.join(k.select("place", F.struct(*keys.columns).alias("next")), "place", "left").drop("place")


def _blocks(levels: int, low: Column, high: Column) -> Column:
    """The blocks that make up places low to high (exclusive): array of (level, start, stop)."""

    def step(acc: Column, level: Column) -> Column:
        up, down = F.ceil(acc["low"] / FAN), F.floor(acc["high"] / FAN)
        last = (level == levels - 1) | (up >= down)
        part = lambda a, b: F.struct(level.alias("level"), a.alias("start"), b.alias("stop"))
        cut = F.when(last, F.array(part(acc["low"], acc["high"]))).otherwise(F.array(part(acc["low"], up * FAN), part(down * FAN, acc["high"])))
        rest = lambda c: F.when(last, F.lit(0).cast("long")).otherwise(c)
        return F.struct(rest(up).alias("low"), rest(down).alias("high"), F.concat(acc["out"], cut).alias("out"))

    begun = F.struct(low.cast("long").alias("low"), high.cast("long").alias("high"), F.array().cast("array<struct<level:int,start:bigint,stop:bigint>>").alias("out"))
    every = F.aggregate(F.sequence(F.lit(0), F.lit(levels - 1)), begun, step, lambda acc: acc["out"])
    return F.filter(every, lambda x: x["start"] < x["stop"])


def range_minima(values: DataFrame, ranges: DataFrame, value: str, by: list[str]) -> DataFrame:
    """`by` and the least `value` of values (place, value) at the places low to high (exclusive) of each
    row of ranges (by, low, high); ranges without places have no row."""
    tree = [written(values.select(F.lit(0).alias("level"), "place", value))]
    rows = tree[0].count()
    while rows > FAN:
        below = tree[-1]
        tree.append(written(below.groupBy(F.floor(F.col("place") / FAN).alias("place")).agg(F.min(value).alias(value)).select(F.lit(len(tree)).alias("level"), "place", value)))
        rows = -(-rows // FAN)
    every = tree[0]
    for level in tree[1:]:
        every = every.unionByName(level)
    cut = ranges.select(*by, F.explode(_blocks(len(tree), F.col("low"), F.col("high"))).alias("x"))
    cut = cut.select(*by, "x.level", F.explode(F.sequence(F.col("x.start"), F.col("x.stop") - 1)).alias("place"))
    return cut.join(every, ["level", "place"]).groupBy(*by).agg(F.min(value).alias(value))
