"""Every registered query against its SQL oracle on the smallest test scale."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from cadastra.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = ["nation", "supplier", "orders", "lineitem", "events"]


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, pd.Timestamp):
        return v.date()
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def _rows(df, cols):
    out = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False)]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return con


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.SQL) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, duck, key):
    s = E.queries()[key](spark, SF).toPandas()
    o = duck.execute(E.oracle_sql()[key]).df()
    assert sorted(s.columns) == sorted(o.columns)
    cols = sorted(s.columns)
    assert _rows(s, cols) == _rows(o, cols)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "opportunity_score" in df.columns
