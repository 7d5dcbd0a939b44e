"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a sequence of slots of equal numbers of words. Slot t has the point frac(t * g), g near
the golden ratio's inverse; mapped through the cumulative shares of the sources, it names a source,
and every prefix of the schedule holds each source close to its share. Each source has its target's
number of slots, rounded up, however rare it is: what the points deal to a source beyond that goes to
sources that they leave short, and its last slot takes the remaining words. The slots of a source are
ranked in order. The documents of a source, shuffled by a hash, form a stream that is read again
from its start when it ends; the stream is cut into blocks of as many words as a slot. Slot number
r of a source takes its block number r. Everything runs in the JVM.

A source may hold a third of all rows: ranks and stream positions are prefix sums in two levels
(inside buckets of bounded size, then over buckets), so no task gets a whole source. Buckets are by a
hash of the whole row; rows that are alike are counted first, and numbered, which is part of the hash.
Each step that is read more than once is written first: one plan for all of it, with its dozens of
shuffles at a time, takes more of the driver's memory than the rest of a pipeline.

Defined results: a null or empty text has size 0 and is never taken. A null source is a source,
ordered last. A null doc_id is a document, and so is each row of those that share a doc_id. Rows that
repeat are each mixed and returned. If all
sizes are 0, targets and taken words are 0. Other columns are not read. An empty table gives an
empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from entitymill.llm.common import materialize, word_count

WEIGHTS, SHARE, EPOCHS = (5, 2, 1), 1.5, 2
#: Words in a slot at most, and slots at least until that is reached: small tables get short slots.
SLOT_WORDS, SLOTS = 4096, 1 << 17
#: Rows that a bucket of a prefix sum should hold.
BUCKET_ROWS = 2_000
#: Neighbours in Fibonacci's sequence. Their ratio is the golden one up to MODULUS slots,
#: which no point repeats before, and their product fits 63 bits.
MODULUS, STEP = 2971215073, 1836311903


def prefix_sum(df: DataFrame, group: str, bucket: str, order: list, value: str, out: str) -> DataFrame:
    """Adds `out`: the sum of `value` over the rows of `group` before this one, by bucket, then
    order. Window partitions are (group, bucket); over buckets only their sums are added up."""
    sums = df.groupBy(group, bucket).agg(F.sum(value).alias("_in"))
    ahead = W.partitionBy(group).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    base = sums.select(F.col(group).alias("_g"), F.col(bucket).alias("_b"), F.coalesce(F.sum("_in").over(ahead), F.lit(0)).alias("_base"))
    inside = W.partitionBy(group, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    rows = df.withColumn("_within", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    same = rows[group].eqNullSafe(base["_g"]) & (rows[bucket] == base["_b"])
    return rows.join(base, same).withColumn(out, F.col("_base") + F.col("_within")).drop("_g", "_b", "_base", "_within")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size and target. sizes: source, size.

    Below their caps, targets are a common level times the weight; a source whose cap is lower
    stops there. By rising cap/weight, a source stops if the level that is left for it and those
    behind it would pass its cap."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row for each source: the only windows without a key stand on this table
    order = W.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    by = by.withColumn("weight", pick.cast("double")).withColumn("cap", (F.col("source_size") * epochs).cast("double"))
    every, rise = W.partitionBy(), W.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    to_here = rise.rowsBetween(W.unboundedPreceding, -1)
    total = F.sum("source_size").over(every) * F.lit(float(share))
    left = total - F.coalesce(F.sum("cap").over(to_here), F.lit(0.0))
    behind = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(to_here), F.lit(0.0))
    by = by.withColumn("level", left / behind).withColumn("stops", F.col("cap") <= F.col("level") * F.col("weight"))
    level = F.min(F.when(~F.col("stops"), F.struct((F.col("cap") / F.col("weight")).alias("at"), "level"))).over(every)["level"]
    return by.select("source", "source_size", F.when(F.col("stops"), F.col("cap")).otherwise(level * F.col("weight")).alias("target"))


def schedule(goal: DataFrame, n_slots: int) -> DataFrame:
    """slot, source and rank (from 0) of n_slots slots; goal: source, target."""
    spark = goal.sparkSession
    every, before = W.partitionBy(), W.orderBy(F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    lo = F.coalesce(F.sum("target").over(before), F.lit(0.0)) / F.sum("target").over(every)
    spans = goal.where("target > 0").select("source", lo.alias("lo"))
    last = W.orderBy("lo")
    spans = spans.withColumn("hi", F.coalesce(F.lead("lo").over(last), F.lit(2.0)))
    # a range lookup by cells: a cell meets only the spans that reach into it, few however many there are
    cells = max(1024, 4 * spans.count())
    cell = lambda c: F.least(F.floor(c * cells), F.lit(cells - 1))
    spans = spans.withColumn("cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi")))))
    slots = spark.range(n_slots).withColumnRenamed("id", "slot")
    point = (F.pmod(F.pmod("slot", F.lit(MODULUS)) * STEP, F.lit(MODULUS)) / F.lit(float(MODULUS))).alias("u")
    slots = slots.select("slot", point).withColumn("cell", cell(F.col("u")))
    dealt = slots.join(spans, "cell").where("u >= lo AND u < hi").select("slot", "source", F.lit(1).alias("one"))
    dealt = materialize(dealt.withColumn("bucket", F.floor(F.col("slot") / BUCKET_ROWS)), "dealt")
    return prefix_sum(dealt, "source", "bucket", [F.col("slot")], "one", "rank").select("slot", "source", "rank")


def full_schedule(goal: DataFrame, per: int) -> DataFrame:
    """slot, source and rank of a schedule in which each source has as many slots of `per` words as
    hold its target, the last one perhaps in part; goal: source, target."""
    wanted = goal.where("target > 0").select("source", F.ceil(target_words() / per).alias("n"))
    wanted = materialize(wanted, "slots")
    n_slots = wanted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    dealt = materialize(schedule(wanted.select("source", F.col("n").cast("double").alias("target")), n_slots), "schedule")
    have = dealt.groupBy(F.col("source").alias("_s")).agg(F.count("*").alias("have"))
    counts = wanted.join(have, F.col("source").eqNullSafe(F.col("_s")), "left").select("source", "n", F.coalesce("have", F.lit(0)).alias("have"))
    counts = materialize(counts, "counts")
    ranked = dealt.join(counts.select(F.col("source").alias("_s"), "n"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    # a few slots for each source: the only windows without a key stand on these tables
    surplus = ranked.where("rank >= n").select("slot", F.row_number().over(W.orderBy("slot")).alias("i"))
    short = counts.where("have < n").select("source", F.explode(F.sequence(F.col("have"), F.col("n") - 1)).alias("rank"))
    short = short.select("source", "rank", F.row_number().over(W.orderBy("rank", F.col("source").asc_nulls_last())).alias("i"))
    filled = surplus.join(short, "i").select("slot", "source")
    every = ranked.where("rank < n").select("slot", "source").union(filled)
    every = every.withColumn("one", F.lit(1)).withColumn("bucket", F.floor(F.col("slot") / BUCKET_ROWS))
    every = materialize(every, "filled")
    return prefix_sum(every, "source", "bucket", [F.col("slot")], "one", "rank").select("slot", "source", "rank")


def target_words() -> Column:
    """Words of a target: rounded up, but for the error of its sum."""
    return F.ceil(F.col("target") * (1 - 1e-14))


def row_hash(seed: int, columns: list[str]) -> Column:
    """A hash of a row; a null is not passed over."""
    return F.xxhash64(F.lit(seed), *(F.col(c) for c in columns), *(F.col(c).isNull() for c in columns))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, slot_words: int = SLOT_WORDS, slots: int = SLOTS, carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with size, source_size and target; the schedule; the segments that slots take).

    Segments: doc_id, source, bucket, nth, rank, words: so many words of the document in the source's
    slot of that rank. carry: columns of docs that the documents keep, of types that can be grouped."""
    own = ["doc_id", "source", "size", "t"]
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("t"), *carry)
    alike = materialize(rows.groupBy(*own, *carry).agg(F.count("*").alias("alike")), "sizes")
    n_rows, words = alike.agg(F.coalesce(F.sum("alike"), F.lit(0)), F.coalesce(F.sum(F.col("alike") * F.col("size")), F.lit(0))).first()
    goal = materialize(targets(alike.select("source", (F.col("size") * F.col("alike")).alias("size")), weights, share, epochs), "targets")
    sizes = alike.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("alike").cast("int")))).drop("alike")
    total = share * words
    per = max(1, min(slot_words, math.ceil(total / slots)))
    plan = materialize(full_schedule(goal, per), "plan")

    shuffled = row_hash(2, own + ["copy"])
    buckets = max(1, math.ceil(n_rows / BUCKET_ROWS))
    rows = sizes.withColumn("bucket", F.pmod(row_hash(1, own + ["copy"]), F.lit(buckets)))
    order = [shuffled, *map(F.col, [*own, "copy", *carry])]
    rows = prefix_sum(rows, "source", "bucket", order, "size", "start")
    rows = rows.withColumn("nth", F.row_number().over(W.partitionBy("source", "bucket").orderBy(*order)))
    rows = rows.join(goal.select(F.col("source").alias("_s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    rows = materialize(rows, "numbered")
    # the stream is read up to `epochs` times, and no further than the target
    epoch = F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))
    spans = rows.where("size > 0").withColumn("e", epoch).withColumn("a", F.col("start") + F.col("e") * F.col("source_size")).withColumn("b", F.least(F.col("a") + F.col("size"), target_words())).where("a < b")
    spans = spans.withColumn("rank", F.explode(F.sequence(F.floor(F.col("a") / per), F.floor((F.col("b") - 1) / per))))
    segments = spans.select(
        "doc_id", "source", "bucket", "nth", "rank",
        (F.least("b", (F.col("rank") + 1) * per) - F.greatest("a", F.col("rank") * per)).alias("words"),
    )
    right = plan.select(F.col("source").alias("_s"), F.col("rank").alias("_r"))
    segments = segments.join(right, F.col("source").eqNullSafe(F.col("_s")) & (F.col("rank") == F.col("_r"))).drop("_s", "_r")
    return rows, plan, segments


def mix_documents(docs: DataFrame, carry: tuple[str, ...] = (), **how) -> DataFrame:
    """doc_id, size, source_size, target and taken of each row of docs (doc_id, source, text), and the
    columns to carry."""
    rows, _, segments = mix(docs, carry=carry, **how)
    taken = segments.groupBy(F.col("source").alias("_s"), F.col("bucket").alias("_b"), F.col("nth").alias("_n")).agg(F.sum("words").alias("words"))
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b")) & (F.col("nth") == F.col("_n"))
    return rows.join(taken, same, "left").select("doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken"), *carry)


def copy_documents(docs: DataFrame, **how) -> DataFrame:
    """docs, all columns whatever their names, each row as often as the mix takes it: whole while words
    are taken. Rows that are alike in every column meet as one, with the copies of all of them."""
    kinds = dict(docs.dtypes)
    plain = [F.to_json(F.struct(docs[f"`{c}`"])) if "map<" in kinds[c] else docs[f"`{c}`"] for c in docs.columns]
    key = [F.xxhash64(F.lit(seed), *plain, *(c.isNull() for c in plain)).alias(f"key{seed}") for seed in (1, 2)]
    rows = docs.select(*key, F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"))
    taken = mix_documents(rows.select("key1", "key2", "row.doc_id", "row.source", "row.text"), carry=("key1", "key2"), **how)
    times = F.sum(F.ceil(F.col("taken") / F.col("size"))).cast("int").alias("times")
    copies = taken.where("taken > 0").groupBy("key1", "key2").agg(times)
    once = rows.groupBy("key1", "key2").agg(F.first("row").alias("row")).join(copies, ["key1", "key2"])
    return once.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))
