"""Queries against their SQL on the smallest tables; GRIDMEND_FULL=1 compares all of them."""

import os
from pathlib import Path

import pytest

import __spark_entry__ as entry

FEW = ["regular_grid", "gap_groups", "occupancy", "airtemp_ffill_bfill", "peer_ratio", "site_correlations", "route_gaps_plain", "fill_linear", "upsert_columns", "p3_found", "p5_found", "p5_rolling", "p6_found"]
NAMES = sorted(entry.oracle_sql()) if os.environ.get("GRIDMEND_FULL") else FEW


@pytest.fixture(scope="module")
def duck(data):
    import duckdb

    c = duckdb.connect()
    for f in Path(data).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_equal(spark, data, duck, name):
    got = entry.queries()[name](spark, data)
    rel = duck.sql(entry.oracle_sql()[name])
    cols = sorted(got.columns)
    assert cols == sorted(rel.columns)
    key = lambda row: tuple((v is None, v if v is not None else 0) for v in row)
    norm = lambda rows: sorted((tuple(float(v) if isinstance(v, float) else v for v in r) for r in rows), key=key)
    want = rel.project(", ".join(cols)).fetchall()
    assert norm(tuple(r) for r in got.select(*cols).collect()) == norm(want)
