"""Queries whose results SQL can state, against DuckDB on the same files."""

import duckdb
import pytest

from parcelscope.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "string": "VARCHAR"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = connection.sql(ORACLES[name])
    result = QUERIES[name](spark, SF)
    names = sorted(result.columns)
    assert names == sorted(expected.columns)
    assert {c: TYPES[t] for c, t in result.dtypes} == dict(zip(expected.columns, map(str, expected.types)))
    order = [expected.columns.index(c) for c in names]
    wanted = sorted((tuple(row[k] for k in order) for row in expected.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in names) for r in result.collect()), key=repr) == wanted
