"""Every registered query against its SQL, on the tables the driver checks with."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from shelfmark.plans.oracle import ORACLE as OWN_ORACLE
from shelfmark.plans.queries import QUERIES as OWN

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLE = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _canon(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_canon(row[i]) for i in order) for row in rows)


def test_same_keys():
    assert set(OWN) == set(OWN_ORACLE)
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLE[name])
    got_columns, got_rows = _rows(got.columns, [tuple(r) for r in got.collect()])
    want_columns, want_rows = _rows(want.columns, want.fetchall())
    assert got_columns == want_columns
    assert len(got_rows) == len(want_rows)
    different = [(g, w) for g, w in zip(got_rows, want_rows) if g != w]
    assert not different, different[:3]
    assert got_rows, "a query without rows proves nothing"
    order = sorted(range(len(want.columns)), key=lambda i: want.columns[i])
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER"}
    types = dict(got.dtypes)
    for i in order:
        assert kinds[types[want.columns[i]]] == str(want.types[i]), want.columns[i]


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
