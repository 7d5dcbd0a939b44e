"""Scans of a database table in parts of about equal size, whatever its key looks like.

The database counts its rows by cells of the key: equal spans of a number's range, or first characters
of a text. Cells with too many rows are counted again in finer cells. Neighbouring cells are put
together until a part is full, so parts differ by less than two in size unless a single value is more
than a part. Rows without a key are a part of their own. Each part is one predicate, a range of the
key, that the database applies; columns and further filters are pushed down as in any scan.

Texts are cut by code points, as databases with a binary order compare them.

A server is scanned by JDBC. Where a table lies in several databases, or they have no JDBC driver, tasks
open them by a function that returns a connection of Python's database interface (PEP 249): one task a
database cuts it into parts, and one task a part reads it, so neither counts nor rows are the driver's.
"""

from __future__ import annotations

import math
import os
import shutil
import sqlite3
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, closing, contextmanager
from itertools import chain
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from entitymill.sources.commits import Files

#: Cells that one count asks for; a part is made of cells of at most a fourth of it.
CELLS, SHARE = 64, 4
#: Rows that a task holds at a time.
BATCH = 2_000

Count = Callable[[str], list[tuple]]


def _number(v) -> str:
    return str(int(v)) if float(v).is_integer() else repr(float(v))


def _quoted(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def number_cells(count: Count, table: str, key: str, low: int, high: int, most: int) -> list[tuple[int, int]]:
    """(first value, rows) of cells of whole numbers from low to high, in order; empty ones are left out."""
    width = max(1, -(-(high - low + 1) // CELLS))
    rows = count(f"SELECT ({key} - ({low})) / {width} AS c, COUNT(*) AS n FROM {table} WHERE {key} BETWEEN {low} AND {high} GROUP BY ({key} - ({low})) / {width}")
    out: list[tuple[int, int]] = []
    for c, n in sorted((int(c), int(n)) for c, n in rows):
        first = low + c * width
        if n > most and width > 1:
            out += number_cells(count, table, key, first, min(high, first + width - 1), most)
        else:
            out.append((first, n))
    return out


def text_cells(count: Count, table: str, key: str, most: int, prefix: str = "") -> list[tuple[str, int]]:
    """(first characters, rows) of cells of texts, in order."""
    size = len(prefix) + 1
    inside = f" AND SUBSTR({key}, 1, {len(prefix)}) = {_quoted(prefix)} AND LENGTH({key}) >= {len(prefix)}" if prefix else ""
    rows = count(f"SELECT SUBSTR({key}, 1, {size}) AS c, COUNT(*) AS n, MIN({key}) AS a, MAX({key}) AS b FROM {table} WHERE {key} IS NOT NULL{inside} GROUP BY SUBSTR({key}, 1, {size})")
    out: list[tuple[str, int]] = []
    for c, n, a, b in sorted((c, int(n), a, b) for c, n, a, b in rows):
        # a cell of one text only cannot be cut further
        if n > most and len(c) == size and a != b:
            # what all texts of the cell share is passed over, up to a NUL, which would end a statement
            out += text_cells(count, table, key, most, max(c, os.path.commonprefix([a, b]).split("\0")[0], key=len))
        else:
            out.append((c, n))
    return out


def part_starts(cells: list[tuple], target: float) -> list:
    """The first values of parts: cells in order until a part is about full; what is left over and less
    than half a part joins the part before it."""
    starts, held = [], 0
    for first, n in cells:
        if not starts or held + n > target * 1.125 or held >= target * 0.875:
            if starts and held < target / 2:
                held += n  # too small to stand alone
                continue
            starts.append(first)
            held = 0
        held += n
    if len(starts) > 1 and held < target / 2:
        starts.pop()
    return starts


def part_predicates(count: Count, table: str, key: str, parts: int, text: bool) -> list[str]:
    """Predicates of about `parts` parts that cover every row once."""
    total, nulls, low, high = count(f"SELECT COUNT({key}) AS k, COUNT(*) - COUNT({key}) AS z, MIN({key}) AS a, MAX({key}) AS b FROM {table}")[0]
    out = [f"{key} IS NULL"] if nulls else []
    if total:
        target = total / parts
        most = max(1, int(target / SHARE))
        cells = text_cells(count, table, key, most) if text else number_cells(count, table, key, int(low // 1), int(-(-high // 1)), most)
        shown = _quoted if text else _number
        starts = part_starts(cells, target)
        for i, first in enumerate(starts):
            upper = [f"{key} < {shown(starts[i + 1])}"] if i + 1 < len(starts) else []
            lower = [f"{key} >= {shown(first)}"] if i else []
            out.append(" AND ".join(lower + upper) or f"{key} IS NOT NULL")
    return out or ["1 = 1"]


def jdbc_scan(spark: SparkSession, url: str, table: str, key: str, parts: int, **options: str) -> DataFrame:
    """A table of a database, read in about `parts` parts of equal size by a whole-number or text key."""
    reader = lambda: spark.read.format("jdbc").options(url=url, **options)

    def count(sql: str) -> list[tuple]:
        return [tuple(r) for r in reader().option("query", sql).load().collect()]  # counts by cells

    kind = reader().option("dbtable", table).load().select(key).schema[0].dataType.simpleString()
    if not (kind in ("tinyint", "smallint", "int", "bigint", "string") or kind.startswith(("varchar", "char", "decimal"))) or (kind.startswith("decimal") and not kind.endswith(",0)")):
        raise ValueError(f"{key} is {kind}: a scan in parts needs whole numbers or texts")
    text = kind == "string" or kind.startswith(("varchar", "char"))
    properties = {k: str(v) for k, v in options.items()}
    quoted = spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(key)
    return spark.read.jdbc(url, table, predicates=part_predicates(count, table, quoted, parts, text), properties=properties)


def _named(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


#: Types of columns that databases give to tasks, as Arrow has them. Floats may come as decimals or texts.
_ARROW = {"boolean": pa.bool_(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(), "float": pa.float32(), "double": pa.float64(), "string": pa.string(), "date": pa.date32(), "timestamp": pa.timestamp("us", tz="UTC")}
_MADE = {"boolean": bool, "float": float, "double": float}

Connect = Callable[[str], AbstractContextManager]


def _asked(db) -> Count:
    def count(sql: str) -> list[tuple]:
        cursor = db.cursor()
        cursor.execute(sql)
        return cursor.fetchall()

    return count


def _cut(connect: Connect, source: str, key: str):
    """The predicates of the parts of each database."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address, parts in zip(*(batch.column(n).to_pylist() for n in ("address", "parts"))):
                with connect(address) as db:
                    low = _asked(db)(f"SELECT MIN({key}) AS a FROM {source}")[0][0]
                    if low is not None and not isinstance(low, (int, str)):
                        raise ValueError(f"{key} is {type(low).__name__}: a scan in parts needs whole numbers or texts")
                    found = part_predicates(_asked(db), source, key, parts, isinstance(low, str))
                yield pa.RecordBatch.from_pydict({"address": [address] * len(found), "predicate": found})

    return run


def _sized(connect: Connect, source: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address in batch.column("address").to_pylist():
                with connect(address) as db:
                    n = _asked(db)(f"SELECT COUNT(*) AS n FROM {source}")[0][0]
                yield pa.RecordBatch.from_pydict({"address": [address], "n": pa.array([n], pa.int64())})

    return run


def _read(connect: Connect, source: str, names: list[str], kinds: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address, predicate in zip(*(batch.column(n).to_pylist() for n in ("address", "predicate"))):
                with connect(address) as db:
                    cursor = db.cursor()
                    cursor.execute(f"SELECT {', '.join(map(_named, names))} FROM {source} WHERE {predicate}")
                    while rows := cursor.fetchmany(BATCH):
                        columns = [[v if v is None or k not in _MADE else _MADE[k](v) for v in c] for c, k in zip(zip(*rows), kinds)]
                        yield pa.RecordBatch.from_arrays([pa.array(c, _ARROW[k]) for c, k in zip(columns, kinds)], names)

    return run


def dbapi_scan(spark: SparkSession, connect: Connect, addresses: list[str], table: str, key: str, parts: int, schema: StructType, where: str = "1 = 1") -> DataFrame:
    """Columns and rows of a table that lies in the databases at `addresses`, in about `parts` parts of equal
    size by a whole-number or text key, at least one for each database. `connect` opens one, in a task."""
    names, kinds = schema.names, [f.dataType.simpleString() for f in schema]
    if other := sorted(set(kinds) - set(_ARROW)):
        raise ValueError(f"columns of types {', '.join(other)} can't be read from a database")
    if not addresses:
        return spark.createDataFrame([], schema)
    source = f"(SELECT * FROM {table} WHERE {where}) t"
    each = lambda rows, kind: spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), kind)  # noqa: E731 (a task for each row)
    sizes = each([(a,) for a in addresses], "address string").mapInArrow(_sized(connect, source), "address string, n long").collect()
    total = sum(n for _, n in sizes)
    shares = [(a, max(1, round(parts * n / max(1, total)))) for a, n in sizes]
    cut = each(shares, "address string, parts int").mapInArrow(_cut(connect, source, _named(key)), "address string, predicate string").collect()
    return each([tuple(r) for r in cut], "address string, predicate string").mapInArrow(_read(connect, source, names, kinds), schema)


def _file(uri: str) -> tuple[fs.FileSystem, str]:
    # paths of Spark are not escaped as those of URIs
    return (fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")) if uri.startswith("file:") else fs.FileSystem.from_uri(uri)


def _write_sqlite(folder: str, table: str, key: str, kinds: dict[str, str]):
    """A database of the rows of a task, made in the task's own folder and copied to the shared one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = (b for b in batches if b.num_rows)
        if not (first := next(filled, None)):
            return
        with tempfile.TemporaryDirectory() as own:
            with closing(sqlite3.connect(f"{own}/db", isolation_level=None)) as db:
                # no type for floats: SQLite would make whole ones integers, and lose the sign of zero
                db.execute(f"CREATE TABLE {table} ({', '.join(_named(n) + kinds[n] for n in kinds)})")
                db.execute("PRAGMA journal_mode = OFF")
                db.execute("BEGIN")
                for batch in chain([first], filled):
                    # NaN would be stored as NULL
                    columns = [["NaN" if isinstance(v, float) and math.isnan(v) else v for v in batch.column(n).to_pylist()] for n in kinds]
                    db.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * len(kinds))})", zip(*columns))
                db.execute(f"CREATE INDEX by_key ON {table} ({_named(key)})")
                db.execute("COMMIT")
            # a run of this task again makes a file of its own; the rows returned name those that count
            name = f"{folder}/{uuid.uuid4().hex}.sqlite"
            where, path = _file(name)
            where.create_dir(os.path.dirname(path), recursive=True)
            with open(f"{own}/db", "rb") as made, where.open_output_stream(path) as to:
                shutil.copyfileobj(made, to, 1 << 20)
        yield pa.RecordBatch.from_pydict({"address": [name]})

    return run


def sqlite_files(rows: DataFrame, folder: str, table: str, key: str) -> list[str]:
    """rows as a table of SQLite databases with an index by `key`, one of each task that has rows; their URIs.
    `folder` is one that all executors share."""
    files = Files(rows.sparkSession, folder)
    folder = files.fs.makeQualified(files.path(folder)).toString()
    types = {"smallint": " INTEGER", "int": " INTEGER", "bigint": " INTEGER", "string": " TEXT", "float": "", "double": ""}
    if other := sorted({k for _, k in rows.dtypes} - set(types)):
        raise ValueError(f"columns of types {', '.join(other)} can't be stored in SQLite")
    made = rows.mapInArrow(_write_sqlite(folder, table, key, {n: types[k] for n, k in rows.dtypes}), "address string")
    return [r.address for r in made.collect()]


@contextmanager
def open_sqlite(uri: str) -> Iterator[sqlite3.Connection]:
    """A database that nobody writes any more: in place, or copied first from where it has no path."""
    where, path = _file(uri)
    with tempfile.TemporaryDirectory() as own:
        if not isinstance(where, fs.LocalFileSystem):
            with where.open_input_stream(path) as stored, open(f"{own}/db", "wb") as to:
                shutil.copyfileobj(stored, to, 1 << 20)
            path = f"{own}/db"
        with closing(sqlite3.connect(f"file:{quote(path)}?mode=ro&immutable=1", uri=True)) as db:
            db.setconfig(sqlite3.SQLITE_DBCONFIG_DQS_DML, False)  # else a quoted name of no column is a text
            yield db
