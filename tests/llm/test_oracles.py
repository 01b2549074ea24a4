"""Each query that SQL can express against DuckDB over the same tables."""

import os

import duckdb
import pytest

from eddyflow.llm.oracle import ORACLE_SQL
from eddyflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{SF}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    have = sorted(map(repr, (tuple(r[c] for c in cols) for r in got.collect())))
    rel = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    want = sorted(map(repr, (tuple(r[names.index(c)] for c in cols) for r in rel.fetchall())))
    assert have == want and have
