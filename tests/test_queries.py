"""Every query with SQL is held against DuckDB over the smallest tables."""

import glob
import os

import pandas as pd
import pytest

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def names():
    from tidemark.plans.queries import QUERIES

    return sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def normal(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]").astype(str)
        elif df[c].dtype == object:
            df[c] = df[c].map(lambda x: "" if x is None or x is pd.NaT else str(x)[:10] if hasattr(x, "year") else str(x))
        else:
            df[c] = df[c].astype("float64")
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", names())
def test_query(spark, con, name):
    from tidemark.plans.queries import ORACLES, QUERIES

    got = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLES:
        assert len(got)
        return
    want = con.execute(ORACLES[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    pd.testing.assert_frame_equal(normal(got), normal(want), check_exact=True)


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
