"""Helpers that the corpus operators share: scratch tables, row keys, word rules."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymill.scratch import shared_folder

#: The white space of the word rule: space and the control characters tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


#: Lists that take the paths of scratch tables while their `scratch_tables` is open.
_OPEN: list[list[str]] = []


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a local one only where that is unset and driver
    and executors are one machine's (tests)."""
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder."""
    path = f"{scratch_dir(spark)}/entitymill-{tag}-{uuid.uuid4().hex}"
    for paths in _OPEN:
        paths.append(path)
    return path


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df once to the shared folder and read it back: the lineage ends here, and every
    later reader, also after a lost executor, gets the same rows. Its column types are kept."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_tables() -> Iterator[list[str]]:
    """Paths of the tables that are materialized inside, in order."""
    _OPEN.append(paths := [])
    try:
        yield paths
    finally:
        _OPEN[:] = [x for x in _OPEN if x is not paths]


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete materialized tables that nothing will read again."""
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def word_count(text: Column) -> Column:
    """Number of words (null: 0), in the JVM."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_key(text: Column) -> Column:
    """A key that equal texts share and different texts do not."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is. Pure ASCII takes the JVM's fast path."""
    upper = "".join(map(chr, range(65, 91)))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
