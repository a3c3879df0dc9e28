"""Every registered query against its DuckDB oracle on the smallest fixture (the driver
runs the same comparison at sf0.01)."""
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from metroscope.plans.catalog import QUERIES as CATALOG
from metroscope.plans.oracle import ORACLE as ENGINE_ORACLE
from metroscope.sources.tables import TABLES

from conftest import SMALL_SF

# the engine's own queries; those of the llm subpackage have their own tests
assert CATALOG.items() <= entry.queries().items() and ENGINE_ORACLE.items() <= entry.oracle_sql().items()
QUERIES, ORACLE = CATALOG, ENGINE_ORACLE


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            v = v.item()  # numpy scalar -> python
        except (ValueError, AttributeError):
            pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() else round(v, 6) + 0.0
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    return v


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL_SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) - set(ORACLE) == set()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SMALL_SF).toPandas()
    want = duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "composite" in df.columns
