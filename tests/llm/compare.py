"""Compare a query with its SQL on DuckDB."""

import os

import duckdb

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(value):
    return round(value, 6) + 0.0 if isinstance(value, float) else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def assert_same(ours, sql, sf_dir=SF_DIR):
    duck = duckdb.connect()
    for name in os.listdir(sf_dir):
        duck.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    theirs = duck.execute(sql)
    names = [d[0] for d in theirs.description]
    expected = rows_of(names, theirs.fetchall())
    got = rows_of(ours.columns, [tuple(r) for r in ours.collect()])
    assert sorted(names) == sorted(ours.columns)
    assert got == expected
