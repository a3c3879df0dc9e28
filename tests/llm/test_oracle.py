"""The queries with SQL against DuckDB on the smallest tables."""
import duckdb
import pytest

from metroscope.llm.oracle import ORACLE
from metroscope.llm.queries import QUERIES
from metroscope.sources.tables import TABLES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = QUERIES[name](spark, sf)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]}) AS q").fetchall()
    assert sorted(map(tuple, got.select(*cols).collect()), key=repr) == sorted(want, key=repr)
