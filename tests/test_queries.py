"""Every registered query runs on sf0.001 and, where an oracle exists,
matches DuckDB (rows, columns, values up to 6 decimals)."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as se
from eventlens.sources.tables import DRIVER_TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry(spark):
    df = se.entry(spark)
    assert df.columns == ["window_end", "rk", "item_id", "cnt"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(se.queries()))
def test_query_against_oracle(spark, duck, name):
    df = se.queries()[name](spark, SF)
    rows = df.collect()
    oracle = se.oracle_sql().get(name)
    if oracle is None:
        assert len(rows) > 0
        return
    res = duck.execute(oracle)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _canon(rows, df.columns) == _canon(orows, ocols)
