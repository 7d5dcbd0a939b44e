"""Structured Streaming jobs over files that keep arriving. A job runs over what is there and ends;
its checkpoint says what it has done, so the next run goes on from there."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymill.sources import commits
from entitymill.streaming import state


def source(spark: SparkSession, path: str, times: tuple[str, ...] = ()) -> DataFrame:
    """The files of a table as a stream; columns in `times` become timestamps with a zone, as event
    times must be. A table that is a single file is found by its name in its folder."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(p).isDirectory():
        stream = reader.parquet(path)
    else:
        stream = reader.option("pathGlobFilter", p.getName()).parquet(str(p.getParent().toString()))
    return stream.withColumns({c: F.col(c).cast("timestamp") for c in times})


def _finish(writer, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def run_name(spark: SparkSession, checkpoint: str, number: int) -> str:
    """A batch's name: its stream's identity, which the checkpoint keeps, and its number in it. Batches of
    a new checkpoint have names of their own, though their numbers begin again."""
    return f"{json.loads(commits.Files(spark, checkpoint).read(f'{checkpoint}/metadata'))['id']}-{number}"


def keep_latest(stream: DataFrame, keys: list[str], when: str, tie: str, table: str, checkpoint: str, buckets: int = 4, changed=None) -> DataFrame:
    """Latest row per key, kept in buckets of keys that grow one at a time. A batch is reduced to its own
    latest rows and reads the buckets that may hold their keys (see `state`). changed, if given, gets
    (rows that came or went, the batch's name)."""
    spark = stream.sparkSession
    held = state.KeyedState(spark, table, keys, buckets)

    def merge(batch: DataFrame, number: int) -> None:
        name = run_name(spark, checkpoint, number)
        held.keep_latest(batch, when, tie, name, changed and (lambda rows: changed(rows, name)))

    _finish(stream.writeStream.foreachBatch(merge), checkpoint)
    return held.read(stream.schema)


def daily(stream: DataFrame, when: str, kind: str, value: str, table: str, checkpoint: str) -> DataFrame:
    """Counts and sums by day and kind of all rows, late ones too. A batch adds its own sums to totals
    that are kept as deltas."""
    spark = stream.sparkSession
    rows = stream.select(F.to_date(when).alias("day"), kind, F.lit(1).cast("long").alias("n"), F.col(value).alias("total"))
    totals = state.Totals(spark, table, ["day", kind], ["n", "total"])
    _finish(rows.writeStream.foreachBatch(lambda batch, number: totals.add(batch, run_name(spark, checkpoint, number)) and None), checkpoint)
    empty = rows.groupBy("day", kind).agg(F.sum("n").alias("n"), F.sum("total").alias("total")).schema
    return totals.read(empty)


def coverage(stream: DataFrame, keys: list[str], when: str, tie: str, fields: list[str], folder: str, checkpoint: str) -> DataFrame:
    """field, filled and total over the latest row of each key, kept up to date: a row that replaces
    another takes its values out of the sums and brings its own."""
    spark = stream.sparkSession
    totals = state.Totals(spark, f"{folder}/totals", ["field"], ["total", "filled"])
    has = lambda c: F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")

    def count(rows: DataFrame, name: str) -> None:
        each = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col("_sign").cast("long").alias("total"), F.when(has(c), F.col("_sign")).otherwise(0).cast("long").alias("filled")) for c in fields)))
        totals.add(rows.select(each.alias("x")).select("x.*"), name)

    keep_latest(stream, keys, when, tie, f"{folder}/latest", checkpoint, changed=count)
    return totals.read(spark.createDataFrame([], "field string, total long, filled long").schema)


def first_seen(stream: DataFrame, keys: list[str], when: str, table: str, checkpoint: str, buckets: int = 4) -> DataFrame:
    """The first row of each key, ever: a batch's first rows are added unless the table has their key.
    A batch reads the buckets that may hold its keys and adds to those of new ones."""
    spark = stream.sparkSession
    held = state.KeyedState(spark, table, keys, buckets)
    _finish(stream.writeStream.foreachBatch(lambda batch, number: held.keep_first(batch, when, run_name(spark, checkpoint, number)) and None), checkpoint)
    return held.read(stream.schema)


def recent(stream: DataFrame, keys: list[str], when: str, table: str, checkpoint: str, late: str = "40 days") -> DataFrame:
    """One row per key within a span of event time: state is bounded, and a key that comes again after
    the span is shown again."""
    rows = stream.withWatermark(when, late).dropDuplicatesWithinWatermark(keys)
    _finish(rows.writeStream.format("parquet").option("path", table), checkpoint)
    return stream.sparkSession.read.parquet(table)


def windows(stream: DataFrame, when: str, kind: str, table: str, checkpoint: str, span: str = "1 hour", step: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """start, end, kind and n of sliding windows that the watermark has closed; later rows are left out."""
    counts = stream.withWatermark(when, late).groupBy(F.window(when, span, step).alias("w"), F.col(kind)).agg(F.count("*").alias("n"))
    _finish(counts.select("w.start", "w.end", kind, "n").writeStream.outputMode("append").format("parquet").option("path", table), checkpoint)
    return stream.sparkSession.read.parquet(table)


def sessions(stream: DataFrame, when: str, key: str, table: str, checkpoint: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """start, end, key and n of sessions (rows less than a gap apart) that the watermark has closed."""
    counts = stream.withWatermark(when, late).groupBy(F.session_window(when, gap).alias("w"), F.col(key)).agg(F.count("*").alias("n"))
    _finish(counts.select("w.start", "w.end", key, "n").writeStream.outputMode("append").format("parquet").option("path", table), checkpoint)
    return stream.sparkSession.read.parquet(table)
