"""Every registered query of the core against its SQL on DuckDB, over the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from clausemill import queries

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda v: round(v, 6) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(value(r[i]) for i in order) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, DATA)
    want = duck.sql(queries.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() > 0


def test_every_oracle_has_a_query():
    assert set(queries.ORACLES) <= set(queries.QUERIES)
