"""Queries against their SQL."""

import duckdb
import pytest

from shiftloom.llm import catalog

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DIR}/{table}.parquet'")
    rel = con.execute(catalog.SQL[name])
    columns = [c[0] for c in rel.description]
    want = rel.fetchall()
    got = catalog.QUERIES[name](spark, DIR)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, want))
