"""Between long, wide and nested."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymill.functions.text import money_million, ratio

#: Keys of the financial map that hold shares, and all kinds of keys.
RATIO_KEYS = ("ROE_", "自己資本率_", "売上成長率_")
METRIC_KEYS = ("売上高_", "営業利益_", "自己資本率_", "ROE_", "営業CF_", "フリーCF_", "売上成長率_")


def json_long(df: DataFrame, key: str, column: str) -> DataFrame:
    """key, name and value of each entry of a JSON object; what is no object has none."""
    entries = F.from_json(column, "map<string,string>")
    return df.select(key, F.explode(entries).alias("name", "value"))


def clean_metrics(long: DataFrame) -> DataFrame:
    """Financial entries cleaned by the kind of their key."""
    name = F.regexp_replace("name", "^minkabu_", "")
    shares = reduce(lambda a, b: a | b, [name.startswith(k) for k in RATIO_KEYS])
    return long.withColumn("value", F.when(shares, ratio(F.col("value"))).otherwise(money_million(F.col("value")))).withColumn("name", name)


def wide(long: DataFrame, key: str, names: list[str], agg: Column) -> DataFrame:
    """One column for each of the names, in their order."""
    return long.groupBy(key).pivot("name", names).agg(agg)


def presence(rows: DataFrame, entity: str, service: str, services: list[str]) -> DataFrame:
    """entity by service, 1 or 0."""
    return rows.groupBy(entity).pivot(service, services).agg(F.max(F.lit(1))).na.fill(0)


def union_services(sources: dict[str, DataFrame], column: str = "service") -> DataFrame:
    """All sources, each with its name, by column name; absent columns are null."""
    named = [df.withColumn(column, F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def levels(array: Column, n: int) -> list[Column]:
    """The first n entries as columns level1.., "" where there are fewer."""
    return [F.coalesce(F.get(array, F.lit(i)), F.lit("")).alias(f"level{i + 1}") for i in range(n)]


def numbered(array: Column, prefix: str, n: int) -> list[Column]:
    return [F.get(array, F.lit(i)).alias(f"{prefix}{i + 1}") for i in range(n)]


def names_to_ids(df: DataFrame, key: str, columns: list[str], resolved: DataFrame) -> DataFrame:
    """df with `<column>_id` for each name column: unpivot, one join, back to wide by aggregate."""
    long = df.select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("slot"), F.col(c).alias("name")) for c in columns])).alias("x")).select(key, "x.slot", "x.name")
    hit = long.join(resolved.select("name", "id"), "name")
    ids = hit.groupBy(key).agg(*[F.max(F.when(F.col("slot") == c, F.col("id"))).alias(f"{c}_id") for c in columns])
    return df.join(ids, key, "left")


def expand(df: DataFrame, struct: Column, names: list[str]) -> DataFrame:
    """Fields of a struct as columns."""
    with_s = df.withColumn("_s", struct)
    return with_s.select(*df.columns, *[F.col(f"_s.`{n}`").alias(n) for n in names])


def ordered_columns(schema: list[str], found: list[str]) -> list[str]:
    """Columns of a schema in its order, then the others by name."""
    return [*schema, *sorted(set(found) - set(schema))]


#: Names that may become columns.
MOST_COLUMNS = 2000


def column_names(names: DataFrame, what: str) -> list[str]:
    """The distinct names of a table of one column, by name; too many to be columns are an error."""
    found = [r[0] for r in names.distinct().limit(MOST_COLUMNS + 1).collect()]
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} {what}: they cannot be columns")
    return sorted(x for x in found if x is not None)


def matrix(long: DataFrame, key: str, schema: list[str]) -> DataFrame:
    """A row for each key with a column for each name: those of the schema, then the others that
    occur (field names: few) by name. long: key, name, value; absent values are blank."""
    columns = ordered_columns(schema, column_names(long.select("name"), "names"))
    rows = long.groupBy(key).pivot("name", columns).agg(F.max("value"))
    return rows.na.fill("", columns)


def grid(df: DataFrame, column: str, values: list) -> DataFrame:
    """Every row of df with each of a fixed list of values: no join."""
    return df.withColumn(column, F.explode(F.array(*map(F.lit, values))))
