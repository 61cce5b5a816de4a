"""Every registered query of this subpackage against its SQL on DuckDB, over the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from clausemill.llm import queries
from tests.test_queries import DATA, TABLES, rows


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def test_oracles_are_sql_of_queries():
    assert set(queries.ORACLES) <= set(queries.QUERIES)
    assert all(isinstance(sql, str) for sql in queries.ORACLES.values())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, os.environ.get("TEST_SF_DIR", DATA))
    want = duck.sql(queries.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())
