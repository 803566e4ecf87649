"""Every registered query against the same query in SQL on DuckDB."""

import math
import os

import duckdb
import pytest

from vecloom.plans.oracle import ORACLE
from vecloom.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


_TYPES = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "INTEGER": "int"}


@pytest.mark.parametrize("name", list(ORACLE))
def test_matches_sql(spark, duck, name):
    ours = QUERIES[name](spark, SF_DIR)
    theirs = duck.execute(ORACLE[name])
    names = [d[0] for d in theirs.description]
    types = {d[0]: _TYPES[str(d[1])] for d in theirs.description}
    assert types == {f.name: f.dataType.simpleString() for f in ours.schema}
    expected = _rows(names, theirs.fetchall())
    got = _rows(ours.columns, [tuple(r) for r in ours.collect()])
    assert len(got) == len(expected)
    assert got == expected


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE])
def test_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
