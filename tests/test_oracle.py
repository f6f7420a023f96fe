"""Every query with a SQL oracle gives the same rows as DuckDB (sf0.001)."""

import pytest

from polyvox.plans.catalog import load_all
from polyvox.plans.check import compare, duck

from polyvox_testdata import SF_SMALL

REG = load_all()
SQL_QUERIES = sorted(n for n, q in REG.items() if q.sql)
ROWS_QUERIES = sorted(n for n, q in REG.items() if not q.sql)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF_SMALL, REG[name])
    assert r["status"] == "OK", r


@pytest.mark.parametrize("name", ROWS_QUERIES)
def test_rows_only_runs(spark, name):
    df = REG[name].build(spark, SF_SMALL)
    assert df.count() >= 0
    assert len(df.columns) > 0
