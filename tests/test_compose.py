"""Compatibility composition in the JVM against Python's own, on every code point and on sequences of them."""

import random
import sys
import unicodedata

from pyspark.sql import functions as F

from entitymill.functions import names, text


def test_every_code_point_and_sequences(spark):
    every = [chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000]
    odd = [c for c in every if unicodedata.combining(c) or unicodedata.decomposition(c)] + [chr(i) for i in (*range(0x1100, 0x1200), *range(0xAC00, 0xAC80), *range(0x1CCD0, 0x1CD00), 0x105C2, 0x16121, 0x1611E, 0x113C9, 0x113B8)]
    r = random.Random(5)
    rows = every + ["".join(r.choice(odd if r.random() < 0.8 else every) for _ in range(r.randrange(2, 7))) for _ in range(60_000)]
    got = spark.createDataFrame(list(enumerate(rows)), "i int, s string").repartition(8).select("i", text.nfkc(F.col("s")).alias("n"))
    bad = [(rows[x.i], x.n) for x in got.collect() if x.n != unicodedata.normalize("NFKC", rows[x.i])]
    assert not bad, bad[:10]


def test_no_python_worker(spark):
    df = spark.createDataFrame([("株式会社ＡＢＣ",), (None,)], "s string")
    for norm in (*names.PROFILES.values(), names.label_key, text.email):
        plan = df.select(norm(F.col("s")).alias("n"))._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
    assert df.select(text.nfkc(F.col("s"))).collect()[0][0] == "株式会社ABC"
