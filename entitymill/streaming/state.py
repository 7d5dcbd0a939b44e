"""Rows by key that outlive a stream, in a table of which a batch reads and writes a small share.

Keys are dealt to buckets by linear hashing: when the buckets hold more rows than they should, one
bucket more is made and the next in turn is split between itself and the new one, so the table grows a
bucket at a time and is never dealt anew. A bucket is some files: one that was written whole and later
additions, put together after a few.

Each write also keeps a filter of its keys (a Bloom filter in blocks of 32,768 bits). A key that the
filters of its bucket have not seen is new: it is added without a look at the bucket. Only buckets that
may hold a key of the batch are read.

The table is committed (`entitymill.sources.commits`) under a batch's name: a batch that runs again
changes nothing, whatever its number, and readers never see half of one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymill.operators.dedupe import latest
from entitymill.scratch import written
from entitymill.sources.commits import Conflict, Table

#: Rows that a bucket should hold, files of one before they are put together, splits in one batch.
BUCKET_ROWS, ADDITIONS, SPLITS = 200_000, 8, 64
#: Bits of a filter's block (fixed by Spark's bitmaps), bits set for a key, keys of a block.
BITS, HASHES, BLOCK_KEYS = 32_768, 3, 3_000


@dataclass
class Work:
    """What a batch has cost: buckets and rows read, rows written."""

    buckets: int = 0
    read_buckets: int = 0
    read_rows: int = 0
    written_rows: int = 0


def key_hash(keys: list[str], seed: int = 0) -> Column:
    """Not negative; null is a value."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys, *(F.col(k).isNull() for k in keys)), 2)


def bucket_of(h: Column, n: int) -> Column:
    """The bucket of a hash among n, by linear hashing."""
    low = 1 << (n.bit_length() - 1)
    wide = F.pmod(h, F.lit(2 * low))
    return F.when(wide < n, wide).otherwise(F.pmod(h, F.lit(low))).cast("int")


def _bits(keys: list[str]) -> Column:
    """The bits of a key in its block."""
    return F.array(*(F.pmod(key_hash(keys, 10 + i), F.lit(BITS)) for i in range(HASHES)))


def _has_bit(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1


class KeyedState:
    """A table of rows by `keys` at a path."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 4, bucket_rows: int = BUCKET_ROWS) -> None:
        self.spark, self.keys, self.start, self.bucket_rows = spark, keys, buckets, bucket_rows
        self.table = Table(spark, path)
        self.work = Work()

    def read(self, schema) -> DataFrame:
        found = self.table.manifest()
        if found is None or not found.folders:
            return self.spark.createDataFrame([], schema)
        return self._rows(found.folders, schema)

    def _rows(self, folders: list[str], schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*(f"{self.table.root}/data/{f}" for f in folders))

    def _write(self, rows: DataFrame) -> tuple[dict[int, list[str]], dict[int, int], list[str]]:
        """Writes rows (with `_bucket`) and their filters: folders and rows of each bucket, and the filters' folders."""
        name = uuid.uuid4().hex
        root = f"{self.table.root}/data"
        rows.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{root}/{name}")
        if not self.table.files.exists(f"{root}/{name}") or not [n for n in self.table.files.names(f"{root}/{name}") if n.startswith("_bucket=")]:
            return {}, {}, []
        back = self.spark.read.option("basePath", f"{root}/{name}").parquet(f"{root}/{name}")
        counts = {r["_bucket"]: r["n"] for r in back.groupBy("_bucket").agg(F.count("*").alias("n")).collect()}  # written buckets
        blocks = back.join(F.broadcast(self.spark.createDataFrame([(b, -(-n // BLOCK_KEYS)) for b, n in counts.items()], "_bucket int, _blocks int")), "_bucket")
        bits = blocks.select("_bucket", "_blocks", F.pmod(key_hash(self.keys, 9), F.col("_blocks")).alias("_block"), F.explode(_bits(self.keys)).alias("_bit"))
        maps = bits.groupBy("_bucket", "_blocks", "_block").agg(F.bitmap_construct_agg("_bit").alias("bits"))
        filters = f"{name}-filter"
        maps.select(F.col("_bucket").alias("of"), "*").repartition("_bucket").write.partitionBy("_bucket").parquet(f"{root}/{filters}")
        return {b: [f"{name}/_bucket={b}"] for b in counts}, counts, [f"{filters}/_bucket={b}" for b in counts]

    def _may_hold(self, rows: DataFrame, filters: list[str]) -> DataFrame:
        """rows with `_seen`: whether a filter of their bucket has their key."""
        if not filters:
            return rows.withColumn("_seen", F.lit(False))
        maps = self.spark.read.parquet(*(f"{self.table.root}/data/{f}" for f in filters))
        # the writes of a bucket have filters of different sizes
        sizes = maps.select(F.col("of").alias("_bucket"), "_blocks").distinct()
        asked = rows.join(sizes, "_bucket").withColumn("_block", F.pmod(key_hash(self.keys, 9), F.col("_blocks")))
        hit = asked.join(maps.withColumnRenamed("of", "_bucket"), ["_bucket", "_blocks", "_block"]).where(F.forall(_bits(self.keys), lambda b: _has_bit(F.col("bits"), b)))
        hit = hit.select("_row").distinct().withColumn("_hit", F.lit(True))
        return rows.join(hit, "_row", "left").withColumn("_seen", F.coalesce("_hit", F.lit(False))).drop("_hit")

    def apply(self, batch: DataFrame, run_id: str, keep: Callable[[DataFrame, DataFrame], tuple[DataFrame | None, DataFrame]], changed: Callable[[DataFrame], None] | None = None) -> bool:
        """Applies rows of unlike keys under a name, unless that has been done; returns whether it did.

        keep(old, new) sees the stored rows of the buckets that may hold keys of new. It gives the rows
        that take the place of old (None: they stay as they are) and the rows to add to their buckets.
        changed gets rows that came and went with `_sign` (1, -1) before the table shows them."""
        base = self.table.manifest()
        if base and run_id in base.runs:
            return False
        n = base.more["buckets"] if base else self.start
        files: dict[int, list[str]] = {int(b): f for b, f in base.more["files"].items()} if base else {}
        sizes: dict[int, int] = {int(b): k for b, k in base.more["rows"].items()} if base else {}
        filters: dict[int, list[str]] = {int(b): f for b, f in base.more["filters"].items()} if base else {}
        columns, schema = batch.columns, batch.schema
        rows = written(batch.withColumn("_bucket", bucket_of(key_hash(self.keys), n)).withColumn("_row", F.monotonically_increasing_id()))
        touched = {r["_bucket"]: r["n"] for r in rows.groupBy("_bucket").agg(F.count("*").alias("n")).collect()}  # at most n rows
        rows = written(self._may_hold(rows, [f for b in touched for f in filters.get(b, ())]))
        seen = {r["_bucket"] for r in rows.where("_seen").select("_bucket").distinct().collect()}
        crowded = {b for b in touched if len(files.get(b, ())) >= ADDITIONS}
        # the buckets that are split now, each in its turn
        total, wanted, split = sum(sizes.values()) + sum(touched.values()), n, set()
        while total > wanted * self.bucket_rows and wanted - n < SPLITS:
            split.add(wanted - (1 << (wanted.bit_length() - 1)))
            wanted += 1
        self.work = Work(buckets=wanted)
        home = bucket_of(key_hash(self.keys), wanted)
        old_of = lambda some: written(self._rows([f for b in sorted(some) for f in files.get(b, ())], schema)) if any(files.get(b) for b in some) else self.spark.createDataFrame([], schema)
        looked = seen | crowded | split
        old, mine = old_of(looked), rows.where(F.col("_bucket").isin(*looked) if looked else F.lit(False)).select(*columns)
        fresh = rows.where(~F.col("_bucket").isin(*looked) if looked else F.lit(True)).select(*columns)
        self.work.read_buckets, self.work.read_rows = sum(b in files for b in looked), old.count() if looked else 0
        instead, more = keep(old, mine)
        if changed is not None:
            came = fresh.withColumn("_sign", F.lit(1))
            if instead is None:
                came = came.unionByName(more.withColumn("_sign", F.lit(1)))
            else:
                kept = [F.xxhash64(*columns), *(F.col(k) for k in self.keys)]
                both = old.withColumn("_sign", F.lit(-1)).unionByName(instead.unionByName(more).withColumn("_sign", F.lit(1))).withColumn("_same", kept[0])
                moved = both.groupBy(*self.keys, "_same").agg(F.sum("_sign").alias("_sum"), F.first(F.struct(*columns)).alias("_r")).where("_sum <> 0")
                came = came.unionByName(moved.select("_r.*", F.col("_sum").cast("int").alias("_sign")))
            changed(written(came))
        rewrite = set(looked) if instead is not None else set(crowded | split)
        if instead is None and rewrite:
            whole = old.where(bucket_of(key_hash(self.keys), n).isin(*rewrite))
            instead = whole
        out = [d for d in (instead, more, fresh) if d is not None]
        every = out[0]
        for d in out[1:]:
            every = every.unionByName(d)
        new_files, counts, new_filters = self._write(every.withColumn("_bucket", home))
        for b in rewrite:
            files.pop(b, None), sizes.pop(b, None), filters.pop(b, None)
        for b, f in new_files.items():
            files.setdefault(b, []).extend(f)
            sizes[b] = sizes.get(b, 0) + counts[b]
            filters.setdefault(b, []).extend(x for x in new_filters if x.endswith(f"/_bucket={b}"))
        self.work.written_rows = sum(counts.values())
        note = {"buckets": wanted, "files": files, "rows": sizes, "filters": filters, "also": [f for v in filters.values() for f in v]}
        if self.table.publish("state", [f for v in files.values() for f in v], schema, run_id, base, note) is None:
            raise Conflict(f"{self.table.root} was changed by another writer")
        return True

    # ---------------------------------------------------------------- what is kept of a key

    def keep_latest(self, batch: DataFrame, when: str, tie: str, run_id: str, changed=None) -> bool:
        """The latest row of each key."""
        none = self.spark.createDataFrame([], batch.schema)
        return self.apply(latest(batch, self.keys, when, tie), run_id, lambda old, new: (latest(old.unionByName(new), self.keys, when, tie), none), changed)

    def keep_first(self, batch: DataFrame, when: str, run_id: str, changed=None) -> bool:
        """The row of each key that came first; a stored row stays, whatever its time."""
        early = batch.withColumn("_early", -F.col(when).cast("double"))
        first = latest(early, self.keys, "_early", "_early").drop("_early")

        def new(old: DataFrame, rows: DataFrame):
            on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in self.keys]
            cond = on[0]
            for c in on[1:]:
                cond = cond & c
            return None, rows.alias("a").join(old.select(*self.keys).alias("b"), cond, "left_anti")

        return self.apply(first, run_id, new, changed)


# ---------------------------------------------------------------- totals

#: Deltas of a level that are put together as one of the next.
FAN = 8


class Totals:
    """Sums by group, kept as deltas: a batch adds its own sums, with minus for rows that went. FAN
    deltas of a level become one of the next, so a total is the sum of a few rows for each level, and a
    batch writes no more than its own groups but for its share of the putting together."""

    def __init__(self, spark: SparkSession, path: str, by: list[str], sums: list[str]) -> None:
        self.spark, self.by, self.sums = spark, by, sums
        self.table = Table(spark, path)

    def _summed(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.by).agg(*(F.sum(c).alias(c) for c in self.sums))

    def add(self, rows: DataFrame, run_id: str) -> bool:
        """Adds rows (by, sums), unless this run has."""
        base = self.table.manifest()
        if base and run_id in base.runs:
            return False
        delta = self._summed(rows)
        levels: list[list[str]] = [list(x) for x in base.more["levels"]] if base else [[]]
        kind = base and self.table.read(base.version).schema or delta.schema
        levels[0].append(self.table.stage(delta))
        for i in range(len(levels)):
            if len(levels[i]) >= FAN:
                paths = [f"{self.table.root}/data/{f}" for f in levels[i]]
                zero = " AND ".join(f"`{c}` = 0" for c in self.sums)
                one = self._summed(self.spark.read.schema(kind).parquet(*paths)).where(f"NOT ({zero})")
                if i + 1 == len(levels):
                    levels.append([])
                levels[i + 1].append(self.table.stage(one))
                levels[i] = []
        if self.table.publish("totals", [f for x in levels for f in x], kind, run_id, base, {"levels": levels}) is None:
            raise Conflict(f"{self.table.root} was changed by another writer")
        return True

    def read(self, schema=None) -> DataFrame:
        """The totals now; groups of which nothing is left are gone (their first sum is 0)."""
        return self._summed(self.table.read(schema=schema)).where(F.col(self.sums[0]) != 0)
