"""Every registered query against its SQL in DuckDB, on the smallest test tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = Path("/root/testdata/sf0.001")
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 10) + 0.0
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def test_every_query_has_sql():
    from lexigraph.plans.catalog import QUERIES

    assert set(QUERIES) <= set(SQL) <= set(contract.queries())


@pytest.mark.parametrize("name", list(SQL))
def test_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, str(FOLDER))
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, cursor.fetchall())
