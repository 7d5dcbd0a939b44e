"""How full tables are: per column, per entity, per field. One pass over a table, whatever its width."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNCOUNTED = ("scraped_at", "original_id")


def filled(df: DataFrame, column: str) -> Column:
    c = F.col(f"`{column}`")
    text = isinstance(df.schema[column].dataType, T.StringType)
    return c.isNotNull() & (c != "") if text else c.isNotNull()


def fill_rates(df: DataFrame, table: str, skip: tuple[str, ...] = UNCOUNTED) -> DataFrame:
    """table_name, field_name, filled_count, total_count and fill_rate; an empty table has no rows."""
    columns = [c for c in df.columns if c not in skip]
    counts = df.agg(F.count("*").alias("total_count"), *[F.count_if(filled(df, c)).alias(f"c{i}") for i, c in enumerate(columns)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(f"c{i}").alias("filled_count")) for i, c in enumerate(columns)]))
    long = counts.where("total_count > 0").select("total_count", rows.alias("x")).select(F.lit(table).alias("table_name"), "x.field_name", "x.filled_count", "total_count")
    return long.withColumn("fill_rate", F.bround(F.col("filled_count") / F.col("total_count"), 4))


def coverage_by_entity(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Filled fields and their share of all, for each entity."""
    n = sum((filled(df, c).cast("int") for c in columns), F.lit(0))
    return df.select(key, n.cast("long").alias("filled_fields"), F.bround(n / F.lit(len(columns)), 4).alias("fill_rate"))


def coverage_by_field(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Entities with each field filled. Entities are those of distinct keys."""
    any_filled = df.groupBy(key).agg(*[F.max(filled(df, c).cast("int")).alias(f"c{i}") for i, c in enumerate(columns)])
    sums = any_filled.agg(F.count("*").alias("n"), *[F.sum(f"c{i}").alias(f"s{i}") for i in range(len(columns))])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"s{i}").alias("filled_entities")) for i, c in enumerate(columns)]))
    return sums.select("n", rows.alias("x")).select("x.field", "x.filled_entities", F.bround(F.col("x.filled_entities") / F.col("n"), 4).alias("fill_rate"))


def low_fields(rates: DataFrame, below: float = 0.5) -> DataFrame:
    return rates.where(F.col("fill_rate") < below).orderBy("fill_rate", "field_name")


def stripped_rates(df: DataFrame, key: str) -> DataFrame:
    """field, filled, total and rate (not rounded) of all columns but the key; blanks are not filled."""
    columns = [c for c in df.columns if c != key]
    counts = df.agg(F.count("*").alias("total"), *[F.count_if(F.trim(F.col(f"`{c}`").cast("string"), F.lit(" \t\r\n\u3000")) != "").alias(f"c{i}") for i, c in enumerate(columns)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"c{i}").alias("filled")) for i, c in enumerate(columns)]))
    return counts.where("total > 0").select(rows.alias("x"), "total").select("x.field", "x.filled", "total", (F.col("x.filled") / F.col("total")).alias("rate"))


def report(rates: DataFrame, width: int = 20) -> DataFrame:
    """line: field, share and a bar of each row of stripped_rates, fullest first."""
    bar = F.round(F.col("rate") * width).cast("int")
    line = F.concat(F.rpad("field", 24, " "), F.lpad(F.format_string("%.1f%%", F.col("rate") * 100), 7, " "), F.lit(" "), F.expr("repeat('#', _bar)"), F.expr(f"repeat('.', {width} - _bar)"), F.lit(" "), F.col("filled").cast("string"), F.lit("/"), F.col("total").cast("string"))
    return rates.withColumn("_bar", bar).orderBy(F.desc("rate"), "field").select("field", line.alias("line"))


def contact_summary(phones: DataFrame, people: DataFrame, mails: DataFrame, key: str) -> DataFrame:
    """Entities with a phone, a person, a mail address, and with any of them: one pass over the three."""
    kinds = (("with_phone", phones), ("with_person", people), ("with_email", mails))
    rows = [df.select(key, F.lit(name).alias("kind")) for name, df in kinds]
    every = rows[0].unionByName(rows[1]).unionByName(rows[2]).distinct()
    return every.agg(*[F.count_if(F.col("kind") == name).alias(name) for name, _ in kinds], F.count_distinct(key).alias("with_any"))


def counted(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, Observation]:
    """df and an observation that holds the measures (aggregates over its rows) once an action on it
    has ended: counters that cost no pass of their own."""
    seen = Observation(name)
    return df.observe(seen, *[m.alias(n) for n, m in measures.items()]), seen
