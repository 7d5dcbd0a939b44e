"""Folders for tables that live as long as a job."""

from __future__ import annotations

import os
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset a local one will do, but only if
    driver and executors are one machine's: elsewhere files written there would not be found."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + os.path.join(tempfile.gettempdir(), "entitymill")
    return folder.rstrip("/")


#: Scratch folders that nobody has touched for so many seconds are swept by the next application.
STALE = 7 * 86400
_SWEPT: set[str] = set()


def new_folder(spark: SparkSession) -> str:
    """A folder of this job. What jobs of a week ago have left goes, once in an application."""
    top = f"{shared_folder(spark)}/entitymill-scratch"
    if top not in _SWEPT:
        _SWEPT.add(top)
        sweep(spark, top)
    return f"{top}/{uuid.uuid4().hex}"


def sweep(spark: SparkSession, folder: str, older_than: float = STALE) -> list[str]:
    """Deletes the folders below `folder` that were made or changed so many seconds ago; returns their names."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for s in fs.listStatus(path) if fs.exists(path) else []:
        if s.getModificationTime() / 1000 <= time.time() - older_than:
            fs.delete(s.getPath(), True)
            gone.append(s.getPath().getName())
    return gone


def written(df: DataFrame) -> DataFrame:
    """df written once and read back: what stands above is computed once, however often it is read."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint."""
    if not df.sparkSession.sparkContext.getCheckpointDir():
        df.sparkSession.sparkContext.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
