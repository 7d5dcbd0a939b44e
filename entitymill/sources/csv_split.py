"""CSV files with line ends inside quotes, read by many tasks, and one ordered CSV file written by many.

Reading takes two passes over the file's splits. Whether a split begins inside a quoted field is not
known to its task, so the first pass runs both cases over the split's lines: where each ends, and how
many records begin. These small sums, chained in the order of the splits, tell each split its state
and the number of its first record. In the second pass a task cuts its lines into records with their
numbers. Only records that lie across splits are shuffled, to be put together.

A quote opens a field only at its start; doubled quotes inside are one; elsewhere a quote is a
character. Lines end in LF or CRLF; blank lines are no records. Texts are UTF-8.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymill.sources.commits import Files

_CLOSED = re.compile(r'(?:[^"]+|"")*+"')
MARK = "﻿"


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Whether a line that begins inside a quoted field, or not, ends inside one."""
    if '"' not in line:
        return inside
    at = 0
    if inside:
        closed = _CLOSED.match(line)
        if not closed:
            return True
        at = line.find(sep, closed.end()) + 1
        if at == 0:
            return False
    while True:
        if line.startswith('"', at):
            closed = _CLOSED.match(line, at + 1)
            if not closed:
                return True
            at = closed.end()
        at = line.find(sep, at) + 1
        if at == 0:
            return False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, split (its first byte) and line, in the order of the file within each partition."""
    return spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").alias("line"))


def _blank(line: str) -> bool:
    return line in ("", "\r")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("file", "split", "line")))


def _summaries(sep: str):
    """Lines to a row for each split: for both states at its start, the state at its end and the records begun."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], list[list]] = {}
        for file, split, line in _rows(batches):
            both = seen.setdefault((file, split), [[False, 0], [True, 0]])
            same = both[0][0] == both[1][0]
            bare = line.removeprefix(MARK) if split == 0 else line
            for i, case in enumerate(both):
                if not case[0] and not _blank(bare):
                    case[1] += 1
                case[0] = both[0][0] if i and same else ends_inside(bare, case[0], sep)
        yield pa.RecordBatch.from_pydict(
            {"file": [f for f, _ in seen], "split": [s for _, s in seen], "out": [b[0][0] for b in seen.values()], "n_out": [b[0][1] for b in seen.values()], "in": [b[1][0] for b in seen.values()], "n_in": [b[1][1] for b in seen.values()]},
            schema=pa.schema([("file", pa.string()), ("split", pa.int64()), ("out", pa.bool_()), ("n_out", pa.int64()), ("in", pa.bool_()), ("n_in", pa.int64())]),
        )

    return run


def split_states(spark: SparkSession, path: str, sep: str) -> dict[tuple[str, int], tuple[bool, int]]:
    """For each split of a file: whether it begins inside a field, and the records that begin before it.
    There is a row for each split, of some megabytes or more."""
    rows = _lines(spark, path).mapInArrow(_summaries(sep), "file string, split long, out boolean, n_out long, in boolean, n_in long").collect()
    states, now = {}, {}
    for r in sorted(rows, key=lambda r: (r["file"], r["split"])):
        inside, n = now.get(r["file"], (False, 0))
        states[r["file"], r["split"]] = (inside, n)
        now[r["file"]] = (r["in"], n + r["n_in"]) if inside else (r["out"], n + r["n_out"])
    return states


_RECORD = pa.schema([("file", pa.string()), ("record", pa.int64()), ("split", pa.int64()), ("whole", pa.bool_()), ("text", pa.string())])


def _records(sep: str, states):
    """Lines to records; one that goes on in another split comes in pieces (whole is false)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, number, held, early = None, False, 0, [], False
        out: list[tuple] = []

        def close(whole: bool) -> None:
            if held:
                out.append((at[0], number - 1, at[1], whole, "\n".join(held)))
                held.clear()

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _RECORD)], schema=_RECORD)
            out.clear()
            return made

        for file, split, line in _rows(batches):
            if (file, split) != at:
                close(False)
                at, (inside, number) = (file, split), states.value[file, split]
                early = inside  # what comes first belongs to a record begun before
                if split == 0:
                    line = line.removeprefix(MARK)
            if not inside and _blank(line):
                continue
            number += not inside
            inside = ends_inside(line, inside, sep)
            held.append(line)
            if not inside:
                held[-1] = line.removesuffix("\r")
                close(not early)
                early = False
            if len(out) >= 4096:
                yield batch()
        close(False)
        if out:
            yield batch()

    return run


def records(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """file, record (from 0, in the order of the file) and text of the records of a CSV file."""
    states = spark.sparkContext.broadcast(split_states(spark, path, sep))
    rows = _lines(spark, path).mapInArrow(_records(sep, states), "file string, record long, split long, whole boolean, text string")
    pieces = rows.where("NOT whole").groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("split", "text"))).alias("p"))
    joined = pieces.select("file", "record", F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"))
    return rows.where("whole").select("file", "record", "text").unionByName(joined)


def header_of(spark: SparkSession, path: str, sep: str = ",") -> list[str] | None:
    """The fields of a file's first record; None of an empty file."""
    files, size = Files(spark, path), 1 << 16
    where = files.path(path)
    if files.fs.getFileStatus(where).isDirectory():
        where = min((s.getPath() for s in files.fs.listStatus(where) if not s.getPath().getName().startswith(("_", "."))), key=lambda p: p.getName(), default=None)
        if where is None:
            return None
    total = files.fs.getFileStatus(where).getLen()
    while True:
        stream = files.fs.open(where)
        data = bytes(files.jvm.org.apache.commons.io.IOUtils.toByteArray(stream, min(size, total)))
        stream.close()
        lines = data.decode("utf-8", "ignore").removeprefix(MARK).split("\n")
        inside, held = False, []
        for i, line in enumerate(lines):
            if not inside and _blank(line) and i < len(lines) - 1:
                continue
            held.append(line)
            inside = ends_inside(line, inside, sep)
            if not inside and (i < len(lines) - 1 or size >= total):
                found = next(csv.reader(io.StringIO("\n".join(held)), delimiter=sep), None)
                return found or None
        if size >= total:
            return None
        size *= 4


def split_csv_file(spark: SparkSession, path: str, sep: str = ",", header: bool = True, columns: tuple[str, ...] = ()) -> DataFrame:
    """All columns as text, and row_no: the record's number in its file, from 2 with a header, else 1."""
    names = list(columns) if columns and not header else header_of(spark, path, sep)
    if not names:
        return spark.createDataFrame([], "row_no long")
    if not header and not columns:
        names = [f"_c{i}" for i in range(len(names))]
    names = [n or f"_c{i}" for i, n in enumerate(names)]
    names = [n if names.count(n) == 1 else f"{n}{i}" for i, n in enumerate(names)]
    schema = ", ".join(f"`{n}` string" for n in names)
    rows = records(spark, path, sep).where(F.col("record") >= int(header))
    parsed = F.from_csv("text", schema, {"sep": sep, "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"})
    return rows.select(parsed.alias("r"), (F.col("record") + 1).alias("row_no")).select(*(F.col(f"r.`{n}`").alias(n) for n in names), "row_no")


# ---------------------------------------------------------------- writing


def _parts(files: Files, folder: str) -> list[tuple[str, int]]:
    """(path, length) of the part files of a folder, in their order."""
    found = sorted(((s.getPath().getName(), s.getPath().toString(), s.getLen()) for s in files.fs.listStatus(files.path(folder))))
    return [(p, n) for name, p, n in found if name.startswith("part-")]


def _local(path: str) -> str:
    return re.sub(r"^file:/+", "/", path)


def concatenate(spark: SparkSession, opening: bytes, parts: list[tuple[str, int]], target: str) -> None:
    """One file of `opening` and the parts in order, under its name when it is whole. HDFS joins blocks
    without a copy; on a mounted path tasks copy the parts to their places side by side; elsewhere the
    bytes go through one stream."""
    files = Files(spark, target)
    staged, scheme = f"{target}.staged", files.fs.getScheme()
    files.delete(staged)
    if scheme == "hdfs":
        files.write(staged, opening)
        if full := [files.path(p) for p, n in parts if n]:
            paths = files.gateway.new_array(files.jvm.org.apache.hadoop.fs.Path, len(full))
            for i, p in enumerate(full):
                paths[i] = p
            files.fs.concat(files.path(staged), paths)
    elif scheme == "file":
        places, at = [], len(opening)
        for p, n in parts:
            if n:
                places.append((_local(p), at))
                at += n
        to = _local(files.fs.makeQualified(files.path(staged)).toString())
        with open(to, "wb") as f:
            f.write(opening)
            f.truncate(at)

        def copy(rows) -> None:
            for source, offset in rows:
                with open(source, "rb") as a, open(to, "r+b") as b:
                    b.seek(offset)
                    while chunk := a.read(1 << 20):
                        b.write(chunk)

        if places:
            spark.createDataFrame(places, "source string, at long").repartition(len(places)).foreachPartition(lambda rows: copy((r["source"], r["at"]) for r in rows))
    else:
        out = files.fs.create(files.path(staged), True)
        out.write(bytearray(opening))
        for p, _ in parts:
            stream = files.fs.open(files.path(p))
            files.jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 16, False)
            stream.close()
        out.close()
    files.delete(target)
    if not files.fs.rename(files.path(staged), files.path(target)):
        raise OSError(f"{staged} could not be renamed")
    for side in (staged, target):  # checksums of a file that was written past its stream
        name = files.path(side)
        files.delete(f"{name.getParent().toString()}/.{name.getName()}.crc")


def write_one_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """One CSV file that opens with a byte order mark, header also without rows; nulls are blank. Rows
    are written by the partitions of df, in their order: that of an orderBy, which deals by range."""
    spark, folder = df.sparkSession, f"{path}.part"
    rows = df.select(*(columns or df.columns))
    how = {"escape": '"', "emptyValue": ""}
    rows.write.mode("overwrite").options(header=False, **how).csv(f"{folder}/rows")
    spark.createDataFrame([], rows.schema).coalesce(1).write.mode("overwrite").options(header=True, **how).csv(f"{folder}/header")
    files = Files(spark, path)
    opening = MARK.encode() + b"".join(files.read(p) for p, _ in _parts(files, f"{folder}/header"))
    concatenate(spark, opening, _parts(files, f"{folder}/rows"), path)
    files.delete(folder)
