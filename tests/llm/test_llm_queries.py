"""The registered corpus queries against their SQL, on a small table."""

import duckdb
import pytest

from entitymill.llm import queries as q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(q.QUERIES))
def test_query(spark, name):
    df = q.QUERIES[name](spark, SF)
    got = sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)
    assert got
    if name in q.ORACLES:
        con = duckdb.connect()
        for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        res = con.execute(q.ORACLES[name])
        columns = [d[0] for d in res.description]
        rows = [dict(zip(columns, r)) for r in res.fetchall()]
        assert got == sorted((tuple(round(r[c], 9) if isinstance(r[c], float) else r[c] for c in df.columns) for r in rows), key=str)
