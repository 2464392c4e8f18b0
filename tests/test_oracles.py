"""Every query against its SQL, row by row."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES = contract.queries()
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (bytes, bytearray)):
        return value.decode()
    return value


def sortable(row):
    return tuple((value is not None, str(type(value)), value) for value in row)


def as_rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(plain(record[i]) for i in order) for record in records]
    return sorted(names), sorted(rows, key=sortable)


SPARK_TYPES = {
    "VARCHAR": "string",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp",
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    got_names, got = as_rows(frame.columns, [tuple(row) for row in frame.collect()])
    result = duck.execute(SQL[name])
    names = [column[0] for column in result.description]
    want_names, want = as_rows(names, result.fetchall())
    assert got_names == want_names
    types = {column[0]: SPARK_TYPES[str(column[1])] for column in result.description}
    assert dict(frame.dtypes) == types
    assert len(got) == len(want) > 0
    assert got == want


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
