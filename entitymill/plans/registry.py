"""Registry of named queries and of the SQL that each equals, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLES[name or f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pick(examples: list[str | None], key: str) -> Column:
    """One of the examples by a row's key."""
    return F.element_at(F.array(*map(F.lit, examples)), (F.col(key) % len(examples) + 1).cast("int"))


def sql_pick(examples: list[str | None], key: str) -> str:
    quoted = ", ".join("NULL" if e is None else "'" + e.replace("'", "''") + "'" for e in examples)
    return f"([{quoted}])[CAST({key} % {len(examples)} + 1 AS INTEGER)]"
