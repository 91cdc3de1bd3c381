"""Every registered query against its SQL counterpart on the smallest given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from wattframe.plans import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "events")
KINDS = {"bigint": "BIGINT", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "string": "VARCHAR",
         "boolean": "BOOLEAN", "date": "DATE"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def normal(rows, order):
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    names = sorted(df.columns)
    expected = duck.sql(contract.oracle_sql()[name])
    assert names == sorted(expected.columns)
    kinds = {n: str(k) for n, k in zip(expected.columns, expected.types)}
    assert {f.name: KINDS[f.dataType.simpleString()] for f in df.schema} == kinds
    assert normal(df.collect(), [df.columns.index(n) for n in names]) == normal(
        expected.fetchall(), [expected.columns.index(n) for n in names])


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
