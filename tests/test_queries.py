"""Every registered query against its SQL, on the smallest driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def oracle():
    db = duckdb.connect()
    for name in TABLES:
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return db


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value.isoformat() if hasattr(value, "isoformat") else repr(value)


def table(columns, rows):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in places) for r in rows)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, oracle, name):
    result = contract.queries()[name](spark, FOLDER)
    rows = [tuple(r) for r in result.collect()]
    if name not in contract.oracle_sql():
        assert rows
        return
    expected = oracle.sql(contract.oracle_sql()[name])
    assert sorted(result.columns) == sorted(expected.columns)
    assert table(result.columns, rows) == table(expected.columns, expected.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() == 10
