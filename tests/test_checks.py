"""Every registered query with SQL gives the same rows as its SQL, over whole tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from checks.registry import CHECKS
from checks.views import SOURCES

FOLDER = "/root/testdata/sf0.001"
SQL = {name: sql for name, sql in entry_points.oracle_sql().items() if name in CHECKS}
QUERIES = {name: query for name, query in entry_points.queries().items() if name in CHECKS}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in SOURCES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def text(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "-"
    return repr(value) if isinstance(value, float) else str(value)


def comparable(rows):
    return sorted(tuple(text(v) for v in row) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, database, name):
    frame = QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    expected = database.sql(SQL[name])
    assert sorted(expected.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    wanted = database.sql(f"select {quoted} from ({SQL[name]})").fetchall()
    found = frame.select(*[f"`{c}`" for c in columns]).collect()
    assert comparable(found) == comparable(wanted)


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0
