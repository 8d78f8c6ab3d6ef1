"""Every registered query against its SQL on the smallest test data."""

import math

import duckdb
import pytest

from donorloom.catalog import load

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
CATALOG = load()


@pytest.fixture(scope="session")
def oracle(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.11g}")
    return int(value) if isinstance(value, bool) else value


def rows(columns, data):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(cell(r[i]) for i in at) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query(name, spark, sf, oracle):
    q = CATALOG[name]
    df = q.run(spark, sf)
    got = rows(df.columns, df.collect())
    if q.sql is None:
        assert got
        return
    cursor = oracle.execute(q.sql)
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows(columns, cursor.fetchall())
