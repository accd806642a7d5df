"""Every catalogue query against its oracle on DuckDB."""

import math
import os

import duckdb
import pytest

from harrow.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    df = catalogue.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = duck.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in result.description]
    rows = result.fetchall()
    assert sorted(names) == columns
    assert rows, "a query without rows proves nothing"
    at = [names.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_without_oracle_runs(spark, name):
    assert catalogue.queries()[name](spark, DATA).count() > 0
