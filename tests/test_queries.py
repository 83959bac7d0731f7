"""Registered queries against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from ledgerloom.plans import registry

from .conftest import SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(x):
    import datetime as dt

    if isinstance(x, float):
        return "nan" if x != x else f"{x:.6f}"
    if isinstance(x, dt.datetime):
        return x.replace(tzinfo=None).isoformat()
    return str(x)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_same_as_sql(spark, tables, name):
    df = registry.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    if name not in registry.oracle_sql():
        assert got
        return
    want = tables.execute(registry.oracle_sql()[name])
    place = {d[0]: i for i, d in enumerate(want.description)}
    assert sorted(place) == columns
    assert got == sorted(tuple(plain(r[place[c]]) for c in columns) for r in want.fetchall())


def test_entry_without_llm(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
