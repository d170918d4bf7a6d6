"""Every registered query against its SQL, over whole tables."""

import datetime
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_module
from contracts.oracle import ORACLE
from contracts.queries import QUERIES
from contracts.tables import TABLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


# DuckDB type names by Spark type name.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE", "float": "FLOAT",
         "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        return ("decimal", str(v))
    if isinstance(v, float):
        return ("float", v.hex())
    if isinstance(v, (datetime.datetime, datetime.date)):
        return (type(v).__name__, v.isoformat())
    return (type(v).__name__, str(v))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_contract(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    assert sorted(df.columns) == sorted(columns)
    kinds = dict(zip(columns, [str(x[1]) for x in duck.execute("describe " + ORACLE[name]).fetchall()]))
    for c, kind in df.dtypes:
        assert kinds[c] == TYPES.get(kind, kind.upper()), c
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(want)
    assert want, "a contract without rows proves nothing"
    assert _rows(df.columns, got) == _rows(columns, want)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns[-1] == "pt" and df.count() > 0
