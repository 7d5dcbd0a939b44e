"""CSV read in splits against one reader over the whole file, and one file written by many tasks."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from entitymill.sources import csv_split, readers, writers

FIELDS = ["a", "", "x y", 'say ""hi""', "line\nbreak", "two\r\nlines", "comma, here", "\n\n", '"', "日本\n語", "z" * 50, "\r", "q\""]


def content(seed, n, end, mark):
    r, out = random.Random(seed), io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerow(["id", "no\nte", "more"])
    for i in range(n):
        w.writerow([i + 1, r.choice(FIELDS), r.choice(FIELDS)])
        if r.random() < 0.05:
            out.write(end)
    return (mark + out.getvalue()).encode()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [37, 200, 1 << 20])
def test_splits_are_one_file(spark, tmp_path, end, size):
    path = tmp_path / "f.csv"
    data = content(size, 400, end, "﻿" if size != 200 else "")
    path.write_bytes(data)
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        lines = csv_split._lines(spark, f"file://{path}")
        assert (lines.rdd.getNumPartitions() > 20) == (size < 1 << 20)
        got = readers.csv_file(spark, f"file://{path}")
        assert got.columns == ["id", "no\nte", "more", "row_no"]
        rows = sorted(tuple(r) for r in got.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    # the library's reader counts no blank lines either
    read = [r for r in csv.reader(io.StringIO(data.decode("utf-8-sig"), newline="")) if r][1:]
    want = sorted((a, b or None, c or None, i) for i, (a, b, c) in enumerate(read, 2))
    assert [(r[0], r[3]) for r in rows] == [(w[0], w[3]) for w in want]
    assert rows == want
    if end == "\r\n":  # Spark's reader takes a lone CR inside quotes for a line's end here
        return
    whole = sorted(tuple(r) for r in readers.whole_csv_file(spark, f"file://{path}").collect())
    assert [(r[0], r[3]) for r in whole] == [(r[0], r[3]) for r in rows]


def test_quotes_inside_fields(spark, tmp_path):
    """A quote opens a field only at its start."""
    text = 'a,b\n5" disk,x\n"q ""w"" e",6" more\n"multi\nline",y\nlast,"z"\n'
    (tmp_path / "q.csv").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 9)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        rows = sorted(tuple(r) for r in csv_split.records(spark, f"file://{tmp_path}/q.csv").select("record", "text").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert rows == [(0, "a,b"), (1, '5" disk,x'), (2, '"q ""w"" e",6" more'), (3, '"multi\nline",y'), (4, 'last,"z"')]


def test_headers_and_empty_files(spark, tmp_path):
    for name, text in (("none", ""), ("mark", "﻿"), ("head", "a,b"), ("blank", "\n\na,b\n")):
        (tmp_path / f"{name}.csv").write_text(text)
        df = readers.csv_file(spark, f"file://{tmp_path}/{name}.csv")
        assert df.count() == 0 and df.columns == (["a", "b", "row_no"] if name in ("head", "blank") else ["row_no"])
    (tmp_path / "bare.csv").write_text("1|x\n2|\n")
    df = readers.csv_file(spark, f"file://{tmp_path}/bare.csv", "|", False, ("n", "s"))
    assert sorted(map(tuple, df.collect())) == [("1", "x", 1), ("2", None, 2)]
    (tmp_path / "short.csv").write_text("a,b,c\n1\n1,2,3,4\n")
    assert sorted((tuple(r) for r in readers.csv_file(spark, f"file://{tmp_path}/short.csv").collect()), key=lambda r: r[3]) == [("1", None, None, 2), ("1", "2", "3", 3)]


def one_task(df, path):
    """The file as one task writes it."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(f"file://{path}")
    return b"\xef\xbb\xbf" + b"".join(p.read_bytes() for p in sorted(path.glob("part-*")))


def test_one_file_of_many_tasks(spark, tmp_path):
    df = spark.range(5000).select("id", F.when(F.col("id") % 7 != 0, F.concat(F.lit('q"\n,'), "id")).alias("no te"), F.lit("").alias("空")).repartition(5).orderBy(F.desc("id"))
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        assert df.rdd.getNumPartitions() > 1
        writers.csv_with_mark(df, f"file://{tmp_path}/out.csv")
        want = one_task(df, tmp_path / "one")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
    assert (tmp_path / "out.csv").read_bytes() == want
    assert sorted(x.name for x in tmp_path.iterdir()) == ["one", "out.csv"]
    assert readers.csv_file(spark, f"file://{tmp_path}/out.csv").agg(F.max("row_no"), F.count("*")).first()[:] == (5001, 5000)
    for rows in (df.limit(0), df.limit(1)):
        writers.csv_with_mark(rows, f"file://{tmp_path}/out.csv", ["空", "id"])
        assert (tmp_path / "out.csv").read_bytes() == one_task(rows.select("空", "id"), tmp_path / "two")
