"""Every registered query against its SQL twin on the same files."""

from __future__ import annotations

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as entry_points
from quayside.plans.catalogue import ORACLE, QUERIES, TABLES


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", value.normalize())
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    expected = duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(expected.columns)
    got, want = multiset(df.columns, df.collect()), multiset(expected.columns, expected.fetchall())
    assert len(got) == len(want) and len(got) > 0
    assert got == want


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
