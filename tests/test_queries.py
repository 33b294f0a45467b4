"""Every query against its SQL in DuckDB, on the smallest data."""

import os

import duckdb
import pytest

from siltstone import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for file in os.listdir(SF):
        con.sql(f"create view {file.removesuffix('.parquet')} as select * from '{SF}/{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    if hasattr(value, "replace") and hasattr(value, "tzinfo"):
        return str(value.replace(tzinfo=None))
    if isinstance(value, (int,)) and not isinstance(value, bool):
        return f"{float(value):.9g}" if abs(value) < 10**8 else str(value)
    return str(value)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    spark.catalog.clearCache()
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert got or name in ()
        return
    rel = duck.sql(sql)
    names = rel.columns
    assert sorted(names) == columns
    want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in rel.fetchall())
    assert got == want


def test_contract(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["page", "outcome", "type", "key", "id"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
