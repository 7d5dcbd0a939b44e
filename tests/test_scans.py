"""Database scans in parts, in the database that Spark ships."""

import os
import random
import subprocess
import sys

import pyarrow as pa
import pyspark
import pytest
from pyarrow import fs
from pyspark.errors import PythonException

from entitymill.plans import work_queries
from entitymill.sources import scans

HOW = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
URL = "jdbc:derby:memory:scans;create=true"


@pytest.fixture(scope="module")
def table(spark):
    r = random.Random(2)
    rows = []
    for i in range(4000):
        skewed = int(10 ** r.uniform(0, 7)) if r.random() < 0.9 else -r.randrange(50)
        word = r.choice(["a", "aa", "ab'", "b", "日本"]) + "".join(r.choice("abcx") for _ in range(r.randrange(0, 9)))
        rows.append((i, skewed if i % 40 else None, word, i % 3))
    df = spark.createDataFrame(rows, "id int, n bigint, word string, kind int")
    df.write.format("jdbc").options(url=URL, dbtable="things", createTableColumnTypes="word varchar(40)", **HOW).mode("overwrite").save()
    return df


@pytest.mark.parametrize("key", ["id", "n", "word"])
def test_parts(spark, table, key):
    got = scans.jdbc_scan(spark, URL, "things", key, 8, **HOW)
    sizes = [len(p) for p in got.rdd.glom().collect()]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, table.collect()), key=str)
    nulls = table.where(f"{key} IS NULL").count()
    if nulls:
        assert sizes.pop(0) == nulls
    assert 6 <= len(sizes) <= 10 and max(sizes) <= 2 * min(sizes)


def test_pushed_down(spark, table):
    some = scans.jdbc_scan(spark, URL, "things", "n", 4, **HOW).where("kind = 1").select("id")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "kind" in plan.split("PushedFilters")[1].split("]")[0] and "word" not in plan.split("ReadSchema")[-1]
    assert some.count() == table.where("kind = 1").count()


def test_hot_values_and_empty_tables(spark, table):
    hot = spark.createDataFrame([(7 if i % 3 else i, "same" if i % 4 else f"s{i}") for i in range(900)], "n int, word string")
    hot.write.format("jdbc").options(url=URL, dbtable="hot", createTableColumnTypes="word varchar(40)", **HOW).mode("overwrite").save()
    hot.limit(0).write.format("jdbc").options(url=URL, dbtable="nothing", createTableColumnTypes="word varchar(40)", **HOW).mode("overwrite").save()
    for key in ("n", "word"):
        assert sorted(map(tuple, scans.jdbc_scan(spark, URL, "hot", key, 5, **HOW).collect())) == sorted(map(tuple, hot.collect()))
        assert scans.jdbc_scan(spark, URL, "nothing", key, 5, **HOW).count() == 0
    with pytest.raises(ValueError):
        spark.createDataFrame([(1.5,)], "x double").write.format("jdbc").options(url=URL, dbtable="reals", **HOW).mode("overwrite").save()
        scans.jdbc_scan(spark, URL, "reals", "x", 2, **HOW)


def customers(spark, folder, rows):
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_acctbal double").repartition(3).write.parquet(f"{folder}/customer.parquet")
    return sorted([(k, n, b) for k, n, c, b in rows if c == 3], key=str)


def test_several_databases(spark, tmp_path):
    """All rows, whatever their keys and numbers: null and repeated names, quotes, NUL, what names share."""
    names = [None, "", "it's", "a\0b", "日本", "😀", "￿", "x" * 2000, *(f"{'y' * 2000}{i % 90}" for i in range(300)), *["same"] * 300]
    numbers = [None, 0.1, float("inf"), -0.0, 1e300, 7.0]
    want = customers(spark, f"file://{tmp_path}/a b%20", [(i, names[i % len(names)], (3, None, 3, 4)[i % 4], numbers[i % 6]) for i in range(3000)])
    got = work_queries.database_scan(spark, f"file://{tmp_path}/a b%20")
    assert sorted(map(tuple, got.collect()), key=str) == want
    nan = f"file://{tmp_path}/nan"
    customers(spark, nan, [(1, "n", 3, float("nan"))])
    assert [str(r.c_acctbal) for r in work_queries.database_scan(spark, nan).collect()] == ["nan"]


def test_parts_of_several_databases(spark, table, tmp_path):
    rows = table.repartition(3)
    files = scans.sqlite_files(rows, f"{tmp_path}/x y", "things", "id")
    assert len(files) == 3 and sorted(p.name for p in (tmp_path / "x y").iterdir()) == sorted(f.rsplit("/", 1)[1] for f in files)
    for key in ("id", "n", "word"):
        got = scans.dbapi_scan(spark, scans.open_sqlite, files, "things", key, 9, table.schema, "kind < 2")
        sizes = [len(p) for p in got.rdd.glom().collect()]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, table.where("kind < 2").collect()), key=str)
        assert 9 <= len(sizes) <= 18 and max(sizes) <= 500
    assert scans.dbapi_scan(spark, scans.open_sqlite, files, "things", "id", 9, table.schema, "kind > 5").count() == 0
    assert scans.dbapi_scan(spark, scans.open_sqlite, scans.sqlite_files(rows.limit(0), f"{tmp_path}/none", "things", "id"), "things", "id", 9, table.schema).count() == 0
    with pytest.raises(PythonException, match="no such column"):
        scans.dbapi_scan(spark, scans.open_sqlite, files, "things", "id", 9, table.select("id", table.n.alias("absent")).schema).collect()


def test_on_a_cluster(tmp_path):
    """Executors of their own, with nothing in common but the folder for checkpoints."""
    home = os.path.dirname(pyspark.__file__)
    (tmp_path / "home" / "work").mkdir(parents=True)
    for n in os.listdir(home):
        if n != "work":
            (tmp_path / "home" / n).symlink_to(f"{home}/{n}")
    code = f"""
from pyspark.sql import SparkSession
conf = {{"spark.master": "local-cluster[2,1,1024]", "spark.executor.memory": "700m", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.checkpoint.dir": "file://{tmp_path}/shared"}}
spark = SparkSession.builder.config(map=conf).getOrCreate()
from entitymill.plans import work_queries
print("rows", work_queries.database_scan(spark, "/root/testdata/sf0.001").count(), spark.read.parquet("/root/testdata/sf0.001/customer.parquet").where("c_nationkey = 3").count())
spark.stop()
"""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"SPARK_HOME": str(tmp_path / "home"), "SPARK_LOCAL_IP": "127.0.0.1", "SPARK_SCALA_VERSION": "2.13", "PYTHONPATH": repo, "PYSPARK_PYTHON": sys.executable}
    env.pop("PYSPARK_GATEWAY_PORT", None)
    run = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=240)
    said = [line.split() for line in run.stdout.splitlines() if line.startswith("rows")]
    assert said and said[0][1] == said[0][2] != "0", run.stderr[-2000:]


def test_databases_without_a_path(tmp_path, monkeypatch):
    """A file system that is none of the machine's: the file goes there and is copied back."""
    (tmp_path / "far").mkdir()
    monkeypatch.setattr(scans, "_file", lambda uri: (fs.SubTreeFileSystem(str(tmp_path / "far"), fs.LocalFileSystem()), uri.removeprefix("far://")))
    rows = pa.RecordBatch.from_pydict({"id": [1, None, 3], "x": [0.5, float("nan"), None]})
    (made,) = scans._write_sqlite("far://a/b", "t", "id", {"id": " INTEGER", "x": ""})(iter([rows]))
    with scans.open_sqlite(made.column("address")[0].as_py()) as db:
        assert db.execute("SELECT id, x FROM t").fetchall() == [(1, 0.5), (None, "NaN"), (3, None)]
