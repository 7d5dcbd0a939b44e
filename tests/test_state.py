"""Keyed state and totals: results of many batches against plain dictionaries, and what a batch costs."""

import random

from pyspark.sql import functions as F

from entitymill.streaming import jobs, state

SCHEMA = "k long, t long, v string"


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def held(s, schema):
    return sorted((r.k is None, r.k, r.t, r.v) for r in s.read(schema).collect())


def test_latest_over_batches(spark, tmp_path):
    r, want = random.Random(1), {}
    s = state.KeyedState(spark, f"file://{tmp_path}/t", ["k"], buckets=2, bucket_rows=30)
    schema, signs = batch(spark, [(1, 1, "")]).schema, {}

    def changed(rows):
        for x in rows.collect():
            signs[x.k, x.t, x.v] = signs.get((x.k, x.t, x.v), 0) + x._sign

    for n in range(7):
        rows = [(r.choice([None, *range(150)]) if n else i, r.randrange(100), f"{n}-{i}") for i in range(r.choice([3, 90]) if n else 60)]
        for k, t, v in rows:
            if k not in want or (t, v) > want[k]:
                want[k] = (t, v)
        assert s.keep_latest(batch(spark, rows), "t", "v", f"run{n}", changed)
        assert not s.keep_latest(batch(spark, rows), "t", "v", f"run{n}", changed)
        assert held(s, schema) == sorted((k is None, k, *x) for k, x in want.items())
        # what came and went adds up to what is there
        assert {x for x, c in signs.items() if c} == {(k, *x) for k, x in want.items()} and set(signs.values()) <= {0, 1}
    assert s.table.manifest().more["buckets"] >= 5
    assert max(s.table.manifest().more["rows"].values()) < 90


def test_first_over_batches(spark, tmp_path):
    r, want = random.Random(2), {}
    s = state.KeyedState(spark, f"file://{tmp_path}/t", ["k"], buckets=1, bucket_rows=40)
    schema = batch(spark, [(1, 1, "")]).schema
    for n in range(12):
        rows = [(r.choice([None, *range(200)]), n * 100 + i, f"{n}-{i}") for i in range(r.choice([1, 4, 60]))]
        for k, t, v in rows:
            want.setdefault(k, (t, v))
        assert s.keep_first(batch(spark, rows), "t", f"run{n}")
        assert held(s, schema) == sorted((k is None, k, *x) for k, x in want.items())


def test_a_small_batch_costs_little(spark, tmp_path):
    s = state.KeyedState(spark, f"file://{tmp_path}/t", ["k"], buckets=64, bucket_rows=400)
    whole = spark.range(20_000).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("t"), F.lit("a").alias("v"))
    s.keep_latest(whole, "t", "v", "0")
    assert s.work.read_rows == 0 and s.work.written_rows == 20_000
    s.keep_latest(batch(spark, [(5, 2, "b"), (6, 0, "b")]), "t", "v", "1")
    assert s.work.read_buckets <= 2 and s.work.read_rows < 1500 and s.work.written_rows < 1500
    # keys that the filters have not seen are added without a look
    s.keep_first(batch(spark, [(50_000 + i, 1, "n") for i in range(40)]), "t", "2")
    assert s.work.read_rows < 20_000 / 10 and s.work.written_rows < 1500
    rows = s.read(whole.schema)
    assert rows.count() == 20_040 and rows.where("k = 5").first().v == "b" and rows.where("k = 6").first().v == "a"


def test_filters_never_miss(spark, tmp_path):
    s = state.KeyedState(spark, f"file://{tmp_path}/t", ["k"], buckets=3)
    s.keep_latest(spark.range(9_000).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("t"), F.lit("a").alias("v")), "t", "v", "0")
    filters = [f for x in s.table.manifest().more["filters"].values() for f in x]
    asked = spark.range(18_000).withColumnRenamed("id", "k").withColumn("_bucket", state.bucket_of(state.key_hash(["k"]), 3)).withColumn("_row", F.col("k"))
    seen = s._may_hold(asked, filters).groupBy((F.col("k") < 9_000).alias("in")).agg(F.avg(F.col("_seen").cast("int")).alias("p")).collect()
    share = {x["in"]: x["p"] for x in seen}
    assert share[True] == 1 and share[False] < 0.05


def test_a_new_checkpoint_goes_on(spark, tmp_path):
    """Batches of a new checkpoint begin at 0 again; none is taken for one of the table's."""
    folder = f"file://{tmp_path}"

    def arrive(name, rows):
        batch(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
        return jobs.source(spark, f"{folder}/{name}")

    for i, rows in enumerate(([(1, 1, "a")], [(1, 2, "b"), (2, 1, "x")])):
        jobs.keep_latest(arrive("one", rows), ["k"], "t", "v", f"{folder}/t", f"{folder}/c1")
    out = jobs.keep_latest(arrive("two", [(1, 3, "c")]), ["k"], "t", "v", f"{folder}/t", f"{folder}/c2")
    assert sorted(map(tuple, out.collect())) == [(1, 3, "c"), (2, 1, "x")]


def test_totals(spark, tmp_path):
    totals, want, r = state.Totals(spark, f"file://{tmp_path}/t", ["g"], ["n", "total"]), {}, random.Random(3)
    schema = spark.createDataFrame([], "g string, n long, total long").schema
    assert totals.read(schema).count() == 0
    for i in range(20):
        rows = [(r.choice("abcd"), s, s * r.randrange(9)) for s in r.choices((1, 1, 1, -1), k=4)]
        for g, n, t in rows:
            a, b = want.get(g, (0, 0))
            want[g] = a + n, b + t
        assert totals.add(spark.createDataFrame(rows, schema), f"r{i}") and not totals.add(spark.createDataFrame(rows, schema), f"r{i}")
    assert {x.g: (x.n, x.total) for x in totals.read(schema).collect()} == {g: x for g, x in want.items() if x[0]}
    levels = totals.table.manifest().more["levels"]
    assert len(levels) == 2 and len(levels[0]) == 20 % state.FAN and len(levels[1]) == 20 // state.FAN


def test_coverage_and_days_follow_late_and_replaced_rows(spark, tmp_path):
    folder, every = f"file://{tmp_path}", []
    r = random.Random(4)
    for n in range(4):
        rows = [(r.randrange(12), r.randrange(40), r.choice([None, "", " ", "v"])) for _ in range(15)]
        every += rows
        batch(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        source = jobs.source(spark, f"{folder}/in")
        cover = {x.field: (x.filled, x.total) for x in jobs.coverage(source, ["k"], "t", "v", ["v", "k"], f"{folder}/cover", f"{folder}/c1").collect()}
        best = {}
        for k, t, v in every:
            if k not in best or (t, v is not None, v or "") > best[k]:
                best[k] = (t, v is not None, v or "")
        assert cover == {"v": (sum(x[2].strip() != "" for x in best.values()), len(best)), "k": (len(best), len(best))}
        days = jobs.daily(source.withColumn("at", F.timestamp_seconds(F.col("t") * 40_000)), "at", "v", "k", f"{folder}/days", f"{folder}/c2")
        count = {}
        for k, t, v in every:
            a, b = count.get((t * 40_000 // 86_400, v), (0, 0))
            count[t * 40_000 // 86_400, v] = a + 1, b + k
        assert {((x.day - __import__("datetime").date(1970, 1, 1)).days, x.v): (x.n, x.total) for x in days.collect()} == count
