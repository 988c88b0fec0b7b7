"""Every registered query against its DuckDB oracle, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, rows_of

from tests.support import SF_SMALL

@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return con


def test_every_query_has_an_oracle():
    assert set(entry._core_queries()) == set(entry._core_oracle())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "event_id" in df.columns


@pytest.mark.parametrize("name", sorted(entry._core_queries()))
def test_query_matches_oracle(spark, duck, name):
    df = entry._core_queries()[name](spark, SF_SMALL)
    res = duck.execute(entry._core_oracle()[name])
    d_cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert sorted(rows_of(df.columns, df.collect())) == sorted(rows_of(d_cols, res.fetchall()))
