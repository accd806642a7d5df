"""The corpus queries that have oracle SQL, against DuckDB over whole tables."""

import os

import duckdb
import pytest

from harrow.llm import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_oracle(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{DATA}/documents.parquet'")
    result = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    df = registry.queries()[name](spark, DATA)
    assert sorted(df.columns) == sorted(names)
    at = [names.index(c) for c in sorted(names)]
    assert sorted(tuple(r[c] for c in sorted(names)) for r in df.collect()) == sorted(tuple(r[i] for i in at) for r in result.fetchall())
