"""Each query against its SQL on the smallest tables."""

import duckdb
import pytest

from waymark.plans.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "customer orders lineitem events supplier".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    return c


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    relation = con.sql(ORACLES[name])
    assert sorted(relation.columns) == columns
    assert sorted(map(repr, got)) == sorted(map(repr, relation.select(*columns).fetchall()))
