"""Every registered key against its DuckDB oracle (sf0.001), like the driver's check."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from pitchside.registry import ORACLES, QUERIES

from conftest import SF0001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _canon(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return str(int(v)) if v.is_integer() and abs(v) < 2 ** 53 else repr(v)
    if hasattr(v, "item"):
        return _canon(v.item())
    return str(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_canon(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=lambda r: tuple("" if x is None else x for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        p = os.path.join(SF0001, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def test_every_key_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["team_name", "passes", "avg_completion_pct", "shots", "goals", "total_xg"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_key_matches_oracle(spark, duck, key):
    got = QUERIES[key](spark, SF0001).toPandas()
    want = duck.execute(ORACLES[key]).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr
