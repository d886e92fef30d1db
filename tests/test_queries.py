"""Every registered query with SQL against DuckDB, on the smallest given tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from riskmart.queries.tables import TABLES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Jobs that fit models need more rows than the smallest tables hold in every class and split.
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return str(value)


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, FOLDER)
    relation = duck.sql(entry_points.oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    assert _rows(df.collect(), df.columns) == _rows(relation.fetchall(), relation.columns)


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert {r["split"] for r in rows} == {"train", "validation", "test", "production"}


def test_names():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
