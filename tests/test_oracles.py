"""Layer 1: every registered query equals its DuckDB oracle (small tables)."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from livestats.plans.catalog import QUERIES

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return (0, 0)
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return (0, 0) if math.isnan(v) else (1, round(v, 6))
    if isinstance(v, (bool, int)):
        return (1, int(v))
    return (2, str(v))


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(_norm(x) for x in r) for r in pdf[cols].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert not set(QUERIES) - set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["category_id", "product_id", "event_id", "cnt", "window_start", "window_end"]
    assert df.count() > 0
