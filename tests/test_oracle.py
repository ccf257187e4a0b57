"""Every registered query against its SQL counterpart on the same Parquet files."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import SF

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}
OWN = set(contract.REPORTS) | set(contract.STORED)
QUERIES = {name: query for name, query in contract.queries().items() if name in OWN}
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name in OWN}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in RAW:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) == OWN


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF)
    expected = duck.sql(ORACLES[name])
    names = sorted(result.columns)
    assert names == sorted(expected.columns)
    kinds = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: TYPES[t] for c, t in result.dtypes} == kinds
    actual = sorted(repr(tuple(row[c] for c in names)) for row in result.collect())
    order = [expected.columns.index(c) for c in names]
    wanted = sorted(repr(tuple(row[i] for i in order)) for row in expected.fetchall())
    assert actual == wanted
    assert actual


def test_entry_is_the_flagship(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["month_start", "metric", "ord", "value"]
    assert frame.count() == 60


def test_reports_do_without_the_text_operators():
    """With the optional folders gone, the entry still imports and has every report."""
    code = (
        "import sys; sys.modules['parcelscope.llm'] = None; sys.modules['corpus_pipeline'] = None; "
        "import __spark_entry__ as e; assert set(e.queries()) == set(e.oracle_sql()) == set(e.REPORTS) | set(e.STORED)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=Path(contract.__file__).parent, check=True)
