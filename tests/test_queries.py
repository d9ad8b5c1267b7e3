"""Every query of the engine against its SQL oracle, on the smallest tables."""

import os

import duckdb
import pytest

from sedimark.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return round(v, 9)
    return tuple(map(_plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=str)
    if name not in catalogue.ORACLE:
        assert got
        return
    want = duck.sql(catalogue.ORACLE[name])
    at = [want.columns.index(c) for c in columns]
    assert len(want.columns) == len(columns)
    assert got == sorted((tuple(_plain(r[k]) for k in at) for r in want.fetchall()), key=str)


def test_entry_and_registry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
