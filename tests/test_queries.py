"""Every registered query of the engine against its DuckDB twin."""

import os

import pytest

from lectern.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages conversations".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def shown(v):
    return "~" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(tuple(shown(r[c]) for c in cols) for r in df.collect())
    rel = duck.execute(catalog.oracle_sql()[name])
    names = [x[0] for x in rel.description]
    want = sorted(tuple(shown(r[names.index(c)]) for c in cols) for r in rel.fetchall())
    assert sorted(names) == cols
    assert got == want


def test_entry_works_alone(spark):
    import __spark_entry__

    assert set(catalog.queries()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
