"""Registered queries against their SQL in DuckDB on the smallest tables."""

import math

import duckdb
import pytest

from sampleprep import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(value):
    return f"{value:.9g}" if isinstance(value, float) and not math.isnan(value) else repr(value)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, sf, duck, name):
    df = catalog.QUERIES[name](spark, sf)
    found = duck.execute(catalog.ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    want = sorted(tuple(plain(r[columns.index(c)]) for c in order) for r in found.fetchall())
    assert sorted(tuple(plain(r[c]) for c in order) for r in df.collect()) == want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert __spark_entry__.oracle_sql().keys() <= __spark_entry__.queries().keys()
