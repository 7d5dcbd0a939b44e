"""Every registered query outside the corpus operators against its SQL, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from entitymill.plans import page_queries, queries, text_queries, work_queries  # noqa: F401 (they register their queries)
from entitymill.plans import registry as q

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    c.execute("SET TimeZone = 'UTC'")
    return c


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: None if v is None or v is pd.NaT else round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(q.QUERIES))
def test_query(spark, con, name):
    df = q.QUERIES[name](spark, SF)
    got = plain(df.collect(), df.columns)
    if name in q.ORACLES:
        res = con.execute(q.ORACLES[name])
        columns = [d[0] for d in res.description]
        assert sorted(columns) == sorted(df.columns)
        assert got == plain(res.fetchall(), columns)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
