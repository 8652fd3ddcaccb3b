"""Runs a named query and its SQL on the same parquet files and compares names, types and rows."""

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events".split()

TYPE_WORDS = {
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(base):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{base}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def assert_matches(spark, con, base, name):
    result = entry.queries()[name](spark, base)
    expected = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    expected_types = {d[0]: str(d[1]) for d in expected.description}
    assert sorted(result.columns) == sorted(columns)
    for column, type_name in result.dtypes:
        assert TYPE_WORDS[type_name] == expected_types[column], column
    want = _bag(columns, expected.fetchall())
    got = _bag(result.columns, result.collect())
    assert sum(got.values()) > 0
    assert got == want
