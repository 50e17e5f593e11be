"""Queries of the subpackage against their DuckDB SQL on sf0.001."""

import pytest

from staylens.llm.queries import QUERIES, SQL
from tools.check_oracle import duck, rows_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = duck(SF).execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, got) == rows_of(names, cur.fetchall())
