"""The queries as the driver runs them: columns, distinct rows, and SQL where there is some."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from sievework.llm import queries

COLUMNS = {
    "p1_found": ["rec_no:bigint", "line_no:bigint"],
    "p2_found": ["rec_a:bigint", "rec_b:bigint"],
    "p3_found": ["rec_no:bigint", "defect:string"],
    "p4_found": ["rec_a:bigint", "rec_b:bigint"],
    "p5_found": ["scenario:string", "bucket:string", "polarity:string"],
    "p6_found": ["rec_no:bigint", "line_no:bigint"],
    "p7_found": ["rec_no:bigint", "group_no:bigint"],
    "p8_ids": ["doc_id:bigint", "ids:array<int>"],
    "p10_found": ["doc_id:bigint", "kind:string", "start_at:bigint"],
}


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_runs(spark, data, name):
    df = queries.queries()[name](spark, data)
    if name in COLUMNS:
        assert [f"{c}:{t}" for c, t in df.dtypes] == COLUMNS[name]
    rows = df.collect()
    assert rows
    if name.endswith("_found"):
        assert len({tuple(r) for r in rows}) == len(rows)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, data, name):
    con = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    want = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, data)
    assert sorted(got.columns) == sorted(want.columns)
    names = sorted(got.columns)
    cell = lambda v: f"{v:.6g}" if isinstance(v, float) else str(v)
    assert sorted(tuple(cell(r[c]) for c in names) for r in got.collect()) == sorted(tuple(map(cell, r)) for r in want.select(*names).fetchall())
