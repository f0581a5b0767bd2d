"""Every query with SQL against DuckDB on the smallest tables."""

import glob
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module
from tagpulse.plans import file_queries, index_queries, name_queries

DATA = "/root/testdata/sf0.001"
ORACLES = index_queries.ORACLE_SQL | name_queries.ORACLE_SQL | file_queries.ORACLE_SQL


def rows(df: pd.DataFrame) -> list[str]:
    df = df[sorted(df.columns)].copy()
    for c in df:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].dt.date
    return sorted(map(repr, df.astype(object).where(df.notna(), None).values.tolist()))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(p).stem} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_duckdb(spark, duck, name):
    got, want = entry_module.queries()[name](spark, DATA).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["name", "category", "month", "posts", "relative"]


def test_oracles_name_queries():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
