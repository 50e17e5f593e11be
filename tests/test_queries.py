"""Every value-checked registered query equals its DuckDB oracle SQL on sf0.001."""

import pytest

import __spark_entry__ as entry
from staylens.plans.oracle import SQL as ORACLE
from staylens.plans.registry import REGISTRY
from tools.check_oracle import duck, rows_of

from .conftest import SF_SMALL

SQL = ORACLE
QUERIES = {name: fn for name, fn in entry.queries().items() if name in REGISTRY}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(SQL[name])
    dnames = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dnames)
    assert rows_of(sdf.columns, srows) == rows_of(dnames, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 1 and "long_stay_p90_threshold" in df.columns
