"""Each registered query against its SQL in DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from trailforge.plans import all_queries as plans

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")


def plain(v):
    return repr(round(v, 9)) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = plans.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*cols).collect())
    cur = duck.execute(plans.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall())
    assert got == want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
