"""Clusters of names that are nearly the same.

The measure is twice the matched characters over the total length. What it reaches at most follows
from the characters, counted with repeats, that two names share: a pair at the threshold lacks few of
the longer name's. So each name is a set of numbered characters ("a1", "a2", ...), put in one order
for all names, rarest first, and only names that share one of their first few (the prefix that a pair
at the threshold cannot miss) and whose lengths allow it meet. A pair is made at the rarest character
that both prefixes share, once. What is common to most names stands last in the order and is in no
prefix. Names of one small alphabet share common characters all the same. Where more than CROWD names
meet at a character they must also share a segment: a pair at the threshold leaves at most
(1 - threshold) of its characters unmatched, so of a longer name cut in one segment more than that, one
is whole in the shorter one, shifted by no more than what is unmatched. The bound on all characters
and then the measure itself, in Arrow batches, decide. No bound loses a pair. Components grow by the
smallest name of the neighbourhood until nothing changes; every round is checkpointed.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitymill.scratch import checkpointed


@F.pandas_udf(T.DoubleType())
def _measure(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype=float)


#: Names that meet at a character before segments are asked for.
CROWD = 64


def _unmatched(n: Column, threshold: float) -> Column:
    """Characters of two names, n in all, that a pair at the threshold may leave unmatched."""
    return F.floor(n * F.lit(1 - threshold) + 1e-9)


def _cut(n: Column, i: Column, k: Column) -> Column:
    """Where the i-th of k segments of n characters starts."""
    return F.floor(i * n / k)


def _index_segments(name: Column, n: Column, threshold: float) -> Column:
    """Hashes of a name's own segments, as the longer of a pair."""
    k = _unmatched(2 * n, threshold) + 1
    return F.transform(F.sequence(F.lit(0).cast("long"), k - 1), lambda i: F.xxhash64(n, i, F.substring(name, (_cut(n, i, k) + 1).cast("int"), (_cut(n, i + 1, k) - _cut(n, i, k)).cast("int"))))


def _probe_segments(name: Column, n: Column, threshold: float) -> Column:
    """Hashes of the segments that a name holds, as the shorter of a pair, of longer names at their places."""

    def of_length(longer: Column) -> Column:
        k, gap, lost = _unmatched(2 * longer, threshold) + 1, longer - n, _unmatched(longer + n, threshold)

        def at(i: Column) -> Column:
            start, size = _cut(longer, i, k), _cut(longer, i + 1, k) - _cut(longer, i, k)
            low, high = F.greatest(start - F.floor((lost + gap) / 2), F.lit(0)), F.least(start + F.floor((lost - gap) / 2), n - size)
            found = F.transform(F.sequence(low, F.greatest(low, high)), lambda q: F.xxhash64(longer, i, F.substring(name, (q + 1).cast("int"), size.cast("int"))))
            return F.when(low <= high, found).otherwise(F.array().cast("array<bigint>"))

        return F.flatten(F.transform(F.sequence(F.lit(0).cast("long"), k - 1), at))

    most = F.floor(n * F.lit((2 - threshold) / threshold) + 1e-9)
    return F.array_distinct(F.flatten(F.transform(F.sequence(n, F.greatest(n, most)), of_length)))


def candidates(rows: DataFrame, threshold: float, crowd: int = CROWD) -> DataFrame:
    """(a, na, ca, b, nb, cb) of names (name, n, chars, prefix) that share a character of their prefixes,
    the rarest one that they share, and where that is crowded a segment too."""
    met = rows.select("*", F.explode("prefix").alias("mark"))
    crowded = met.groupBy("mark").agg(F.count("*").alias("c")).where(F.col("c") > crowd).select("mark")
    # a segment has a character at least: below that, prefixes alone must do
    cut = _unmatched(2 * F.col("n"), threshold) < F.col("n")
    met = met.join(crowded.withColumn("crowded", F.lit(True)), "mark", "left").withColumn("n", F.col("n").cast("long")).withColumn("by", F.coalesce("crowded", F.lit(False)))
    side = lambda df, x: df.select(F.col("name").alias(x), F.col("n").alias(f"n{x}"), F.col("chars").alias(f"c{x}"), F.col("prefix").alias(f"p{x}"), "mark", *(["seg"] if "seg" in df.columns else []))
    near = 2 * F.least("na", "nb") >= threshold * (F.col("na") + F.col("nb"))
    first = F.get(F.array_intersect("pa", "pb"), F.lit(0)) == F.col("mark")
    open_, busy = met.where(~F.col("by")), met.where("by")
    pairs = side(open_, "a").join(side(open_, "b"), "mark").where((F.col("a") < F.col("b")) & near & first)
    # a pair is short if its longer name is: it meets by the character alone
    short = side(busy.where(~cut), "x").join(side(busy, "y"), "mark").where((F.col("nx") > F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("x") < F.col("y"))))
    long = busy.where(cut).withColumn("seg", F.explode(_index_segments(F.col("name"), F.col("n"), threshold)))
    held = busy.withColumn("seg", F.explode(_probe_segments(F.col("name"), F.col("n"), threshold)))
    long = side(long, "x").join(side(held, "y"), ["mark", "seg"]).where((F.col("nx") > F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("x") < F.col("y"))))
    swap = F.col("x") < F.col("y")
    turned = lambda df: df.select("mark", *(F.when(swap, F.col(f"{p}x")).otherwise(F.col(f"{p}y")).alias(f"{p}a") for p in ("", "n", "c", "p")), *(F.when(swap, F.col(f"{p}y")).otherwise(F.col(f"{p}x")).alias(f"{p}b") for p in ("", "n", "c", "p")))
    both = turned(short).unionByName(turned(long)).where(near & first).dropDuplicates(["a", "b"])
    return pairs.select("a", "na", "ca", "b", "nb", "cb").unionByName(both.select("a", "na", "ca", "b", "nb", "cb"))


def similar_pairs(names: DataFrame, threshold: float = 0.85, crowd: int = CROWD) -> DataFrame:
    """(a, b), a before b, of distinct names whose measure reaches the threshold."""
    rows = names.select("name").where(F.col("name").isNotNull() & (F.col("name") != "")).distinct()
    chars = F.array_sort(F.split("name", ""))
    # a character and which of its kind it is: the k-th in the sorted list, less the place of the first
    rows = rows.withColumn("chars", chars).withColumn("marks", F.transform("chars", lambda c, i: F.concat(c, (i - F.array_position("chars", c) + 2).cast("string"))))
    rows = checkpointed(rows.withColumn("n", F.size("chars")))
    counts = rows.select(F.explode("marks").alias("mark")).groupBy("mark").agg(F.count("*").alias("c"))
    ranked = rows.select("name", F.explode("marks").alias("mark")).join(counts, "mark").groupBy("name").agg(F.array_sort(F.collect_list(F.struct("c", "mark"))).alias("marks"))
    # a pair shares at least threshold / (2 - threshold) of either name's characters
    least = F.ceil(F.col("n") * F.lit(threshold / (2 - threshold) - 1e-9))
    prefix = F.slice("marks", F.lit(1), (F.col("n") - least + 1).cast("int"))
    rows = rows.select("name", "n", "chars").join(ranked, "name").withColumn("prefix", F.transform(prefix, lambda x: x["mark"]))
    pairs = candidates(checkpointed(rows), threshold, crowd)
    kinds = F.array_distinct("ca")
    shared = F.aggregate(kinds, F.lit(0), lambda t, c: t + F.least(F.size(F.filter("ca", lambda x: x == c)), F.size(F.filter("cb", lambda x: x == c))))
    pairs = pairs.where(2 * shared >= threshold * (F.col("na") + F.col("nb"))).select("a", "b")
    return pairs.withColumn("ratio", _measure("a", "b")).where(F.col("ratio") >= threshold).select("a", "b", "ratio")


def clusters(pairs: DataFrame) -> DataFrame:
    """cluster_id (from 1, by smallest name) and name of every name in a pair."""
    both = checkpointed(pairs.select("a", "b").union(pairs.select("b", "a")).distinct())
    labels = checkpointed(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("name"), F.least("a", "low").alias("label")))
    while True:
        near = both.join(labels, both["b"] == labels["name"]).groupBy("a").agg(F.min("label").alias("low"))
        # a label's own label shortens chains
        hop = labels.select(F.col("name").alias("label"), F.col("label").alias("hop"))
        after = labels.join(near, labels["name"] == near["a"]).join(hop, "label").select("name", F.least("label", "low", "hop").alias("new"), "label")
        after = checkpointed(after)
        changed = not after.where("new <> label").isEmpty()
        labels = after.select("name", F.col("new").alias("label"))
        if not changed:
            break
    heads = labels.select("label").distinct()
    # one row for each cluster: the only window without a key
    from pyspark.sql import Window as W

    ids = heads.withColumn("cluster_id", F.row_number().over(W.orderBy("label")))
    return labels.join(ids, "label").select("cluster_id", "name")
