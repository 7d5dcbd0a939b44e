"""Operators that avoid comparing all with all, against versions that do, and state that outlives a run."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from entitymill import scratch
from entitymill.functions import contact
from entitymill.operators import fuzzy, resolve
from entitymill.plans import medallion
from entitymill.streaming import jobs


def names(n=150, seed=1):
    r, out = random.Random(seed), []
    for _ in range(n):
        base = r.choice(out) if out and r.random() < 0.5 else "".join(r.choice("株式会社あいうえおかきくabc") for _ in range(r.randrange(1, 14)))
        at = r.randrange(len(base) + 1)
        out.append(base[:at] + r.choice(["", "あ", "x"]) + base[at + r.randrange(2) :])
    return sorted({x for x in out if x})


@pytest.mark.parametrize("threshold", [0.85, 0.6])
def test_similar_pairs(spark, threshold):
    rows = names()
    got = {(r.a, r.b): r.ratio for r in fuzzy.similar_pairs(spark.createDataFrame([(x,) for x in rows] + [(None,), ("",), (rows[0],)], "name string"), threshold).collect()}
    want = {(a, b): v for a in rows for b in rows if a < b and (v := SequenceMatcher(None, a, b).ratio()) >= threshold}
    assert want and got == want


@pytest.mark.parametrize("threshold, crowd", [(0.85, 0), (0.85, 5), (0.7, 0), (0.6, 2), (0.4, 0)])
def test_similar_pairs_by_segments(spark, threshold, crowd):
    """The same where characters are crowded, down to thresholds at which names are too short for segments."""
    r = random.Random(8)
    rows = sorted({"".join(r.choice("abc") for _ in range(r.randrange(1, 9))) for _ in range(70)} | {x + "株式会社" for x in names(30, 5)})
    got = {(x.a, x.b): x.ratio for x in fuzzy.similar_pairs(spark.createDataFrame([(x,) for x in rows], "name string"), threshold, crowd).collect()}
    want = {(a, b): v for a in rows for b in rows if a < b and (v := SequenceMatcher(None, a, b).ratio()) >= threshold}
    assert want and got == want


def test_segments_leave_few_candidates(spark):
    """Names of one small alphabet: far fewer meet than by characters alone."""
    r = random.Random(3)
    rows = [("".join(r.choice("abcdefgh") for _ in range(r.randrange(8, 14))),) for _ in range(1200)]
    met, real = {}, fuzzy.candidates
    for crowd in (10**9, 64):
        def counted(df, threshold, c, crowd=crowd):
            out = real(df, threshold, crowd)
            met[crowd] = out.count()
            return out

        fuzzy.candidates = counted
        try:
            met[f"pairs{crowd}"] = fuzzy.similar_pairs(spark.createDataFrame(rows, "name string")).count()
        finally:
            fuzzy.candidates = real
    assert met[64] * 5 < met[10**9] and met["pairs64"] == met[f"pairs{10**9}"]


def test_containing(spark):
    rows = names(120, 2)
    dim = spark.createDataFrame([(f"{i:03}", f"株式会社{x}") for i, x in enumerate(rows)], "id string, name_normalized string")
    asked = sorted({x[:k] for x in rows for k in (1, 2, 4, 9)} | {"株式会", "株式会社", "なし社名"})
    got = {r.name: r.id for r in resolve.containing(spark.createDataFrame([(x,) for x in asked], "name string"), dim).collect()}
    want = {x: min((f"{i:03}" for i, y in enumerate(rows) if x in f"株式会社{y}"), default=None) for x in asked}
    assert got == {k: v for k, v in want.items() if v is not None}


def test_metrics_that_meet(spark, tmp_path):
    """Two spellings of a metric's name, and names that are no metric."""
    def put(rows, schema, name):
        spark.createDataFrame(rows, schema).write.parquet(f"file://{tmp_path}/{name}.parquet")

    put([("1", "株式会社甲", "甲", None)], "id string, name string, name_normalized string, stock_code string", "companies")
    put([("a", "1", '{"minkabu_ROE_2024": "4%", "ROE_2024": "3%", "売上高_2024": "5", "other": "x"}', None)], "id string, original_id string, financial_data string, scraped_at timestamp", "minkabu")
    import datetime as dt

    info = medallion.gold(spark, f"file://{tmp_path}", dt.datetime(2025, 1, 1))["company_info"]
    assert info.first().financial == {"ROE_2024": "3", "売上高_2024": "5000000"}
    flat = medallion.flat_company_info(info)
    assert flat.columns[-3:] == ["ROE_2024", "売上高_2024", "scraped_at"] and flat.first()["売上高_2024"] == "5000000"


def test_streams_go_on(spark, tmp_path):
    """New files in a second run: the latest rows and the first ones take them in."""
    source, folder = f"{tmp_path}/in", f"file://{tmp_path}"

    def arrive(rows):
        spark.createDataFrame(rows, "user string, at timestamp_ntz, n long").withColumn("at", F.to_timestamp_ntz(F.lit("2025-01-01")) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("n").cast("int"))).coalesce(1).write.mode("append").parquet(source)

    def run():
        rows = jobs.source(spark, source, ("at",)).select("user", "at", "n")
        latest = jobs.keep_latest(rows, ["user"], "at", "n", f"{folder}/latest", f"{folder}/c1", buckets=4)
        first = jobs.first_seen(rows, ["user"], "at", f"{folder}/first", f"{folder}/c2")
        return {r.user: r.n for r in latest.collect()}, {r.user: r.n for r in first.collect()}

    arrive([(f"u{i}", None, i) for i in range(20)])
    assert run() == ({f"u{i}": i for i in range(20)},) * 2
    arrive([("u3", None, 50), ("u4", None, 2), ("new", None, 60)])
    arrive([("u3", None, 70)])
    latest, first = run()
    assert latest == {f"u{i}": i for i in range(20)} | {"u3": 70, "new": 60}
    assert first == {f"u{i}": i for i in range(20)} | {"new": 60}
    assert run() == (latest, first)


def test_long_blanks_in_contacts(spark):
    text = "x" + " " * 60000 + "y 03 1234 5678" + "\u3000" * 20000 + "TEL: (06) 1234-5678"
    rows = spark.createDataFrame([(text,)], "t string").select(contact.has_signals(F.col("t")).alias("s"), F.transform(contact.phones(F.col("t")), lambda x: x["normalized"]).alias("p"))
    assert tuple(rows.first()) == (True, ["0312345678", "061234-5678"])


def test_scratch_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError):
        scratch.shared_folder(Session())
    Context.master = "local[2]"
    assert scratch.shared_folder(Session()).startswith("file://")
