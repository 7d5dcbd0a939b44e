"""What the corpus operators put on the driver: rows that it takes, plans that it runs at a time."""

import numpy as np
import pyarrow as pa

from entitymill.llm import mixing, quality


def test_driver_gets_small_rows_of_word_vectors(spark, monkeypatch):
    """The driver takes the vectors as float32 in small rows, not their sums: rows over half a region of
    its heap made it grow by some 300 MB."""
    took = []
    for name in ("collect", "toArrow"):
        get = getattr(type(spark.range(1)), name)

        def seen(self, get=get):
            out = get(self)
            rows = out.to_pylist() if isinstance(out, pa.Table) else [r.asDict() for r in out]
            took.extend(len(v) for r in rows for v in r.values() if isinstance(v, (bytes, bytearray)))
            return out

        monkeypatch.setattr(type(spark.range(1)), name, seen)
    rows = [(i * 7919, " ".join(f"w{i * 400 + j}" for j in range(400))) for i in range(100)]
    words = quality.word_vectors(spark.createDataFrame(rows, "h long, text string"))
    assert np.abs(words).sum(axis=1).astype(bool).sum() > quality.BUCKETS / 2
    assert max(took) <= 1 << 16 and sum(took) <= quality.BUCKETS * quality.DIM * 4


def test_mixing_plans_stay_small(spark, monkeypatch):
    """No step of the mix is one plan with dozens of exchanges, which would run side by side and fill the
    driver; the copies are the same as ever: whole documents, as often as the mix takes them."""
    exchanges, write = [], mixing.materialize
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange")

    def seen(df, tag):
        exchanges.append(plan(df))
        return write(df, tag)

    monkeypatch.setattr(mixing, "materialize", seen)
    docs = spark.createDataFrame([(i, "abc"[i % 3], "w " * (i % 7)) for i in range(200)], "doc_id long, source string, text string")
    copies = mixing.copy_documents(docs)
    exchanges.append(plan(copies))
    assert max(exchanges) <= 12, exchanges
    taken = {r.doc_id: -(-r.taken // r.size) for r in mixing.mix_documents(docs).collect() if r.taken}
    assert {r.doc_id: r["count"] for r in copies.groupBy("doc_id").count().collect()} == taken
