"""Every query of the core that SQL can express, against DuckDB over the same tables."""

from __future__ import annotations

import glob
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from sievework.plans import catalog


def rows(df) -> list[tuple]:
    def cell(v):
        if pd.isna(v):
            return "null"
        if isinstance(v, bool) or type(v).__name__ == "bool_":
            return str(bool(v))
        if isinstance(v, (float, np.floating)):
            return f"{v:.6g}"
        return str(v)

    df = df[sorted(df.columns)]
    return sorted(tuple(map(cell, r)) for r in df.astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_equals_sql(spark, data, duck, name):
    got = catalog.queries()[name](spark, data).toPandas()
    want = duck.sql(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs_without_sql(spark, data, name):
    assert catalog.queries()[name](spark, data).count() >= 1
