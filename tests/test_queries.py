"""Every registered query against its SQL oracle, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "customer part orders lineitem".split()
OPTIONAL = {n for n in queries() if n == "pipeline" or n.startswith("op")}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def test_every_query_has_an_oracle():
    assert set(queries()) - set(oracle_sql()) <= OPTIONAL
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["p1", "p2", "ca", "depth", "year", "d1", "d2"]


@pytest.mark.parametrize("name", sorted(set(queries()) - OPTIONAL))
def test_query(spark, duck, name):
    got = normal(queries()[name](spark, FOLDER).toPandas())
    want = normal(duck.execute(oracle_sql()[name]).fetch_df())
    assert len(want), "a comparison of nothing with nothing"
    # A column of NULLs only has no type of its own in pandas.
    got, want = got.convert_dtypes(), want.convert_dtypes()
    pd.testing.assert_frame_equal(got, want, rtol=0, atol=0)
