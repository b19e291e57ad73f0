"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math
import os
from collections import Counter

import duckdb
import pytest
from conftest import DATA

from dealtide.checks.oracles import ORACLES
from dealtide.checks.queries import QUERIES

FOLDER = str(DATA / os.environ.get("CHECK_SF", "sf0.01"))


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in sorted(DATA.joinpath("sf0.01").glob("*.parquet")):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{FOLDER}/{table.name}'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, (bool, datetime.datetime, datetime.date, decimal.Decimal)):
        return f"{type(value).__name__}:{value}"
    return value


def as_bag(rows):
    return Counter(tuple(plain(v) for v in row) for row in rows)


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    result = duck.execute(ORACLES[name])
    assert columns == sorted(c[0] for c in result.description)
    wanted = result.fetchall()
    order = [[c[0] for c in result.description].index(c) for c in columns]
    expected = as_bag([tuple(row[i] for i in order) for row in wanted])
    found = as_bag(df.select(*[f"`{c}`" for c in columns]).collect())
    missing, extra = expected - found, found - expected
    assert not missing and not extra, (columns, list(missing)[:3], list(extra)[:3], len(missing), len(extra))
    assert found
