from datetime import datetime, timedelta

import pytest

from gridmend.operators.regular_grid import to_grid

T0 = datetime(2024, 3, 1)
SCHEMA = "id bigint, src int, t timestamp_ntz, v double, slot_s string, cell string, block string, got timestamp_ntz"


def rows(spark, *xs):
    """(minutes after T0, number) with clashing extra columns."""
    return spark.createDataFrame([(i, 1, T0 + timedelta(minutes=m), v, "x", "y", "z", None) for i, (m, v) in enumerate(xs)], SCHEMA)


def grid(df, **kw):
    return {int((r["slot_s"] - T0.timestamp()) // 60): r for r in to_grid(df, "src", "t", "v", ["got", "id"], **kw).collect()}


@pytest.fixture(autouse=True)
def utc(monkeypatch):
    import time

    monkeypatch.setenv("TZ", "UTC")
    time.tzset()


def test_gauge_fills_short_gaps_and_marks_long_ones(spark):
    g = grid(rows(spark, (0, 10.0), (10, 20.0), (40, 50.0), (300, 7.0)), max_gap_s=3600)
    assert sorted(g) == list(range(0, 301, 10))
    assert [g[m]["status"] for m in (0, 10, 20, 30, 40, 50, 290, 300)] == ["read", "read", "filled", "filled", "read", "uncovered", "uncovered", "read"]
    assert g[20]["value"] == pytest.approx(35) and g[50]["value"] is None and g[300]["value"] == 7 and g[300]["covered_share"] == 0


def test_counter_resets_and_overlap(spark):
    g = grid(rows(spark, (0, 100.0), (10, 130.0), (30, 10.0)), kind="counter")
    # 30 between the first two readings, then a reset that leaves 10 over twenty minutes
    assert g[0]["increment"] == pytest.approx(15) and g[10]["increment"] == pytest.approx(15 + 2.5)
    assert g[20]["increment"] == pytest.approx(5) and g[30]["increment"] == pytest.approx(2.5) and g[20]["is_reset"] and not g[0]["is_reset"]
    assert sum(r["increment"] for r in g.values()) == pytest.approx(40)


def test_blocks_give_what_one_block_gives(spark):
    xs = [(7 * i + (i * i) % 5, float((i * 37) % 101)) for i in range(300) if i % 17 < 12]
    one, many = (grid(rows(spark, *xs), block_slots=b) for b in (100_000, 5))
    assert one.keys() == many.keys()
    for m in one:
        assert one[m]["status"] == many[m]["status"] and one[m]["value"] == (None if many[m]["value"] is None else pytest.approx(many[m]["value"])) and one[m]["n_readings"] == many[m]["n_readings"]


def test_nulls_nans_repeats_and_ties(spark):
    df = spark.createDataFrame(
        [(1, 1, T0, 5.0, None, None, None, T0), (2, 1, T0, 6.0, None, None, None, None), (3, 1, T0 + timedelta(minutes=10), float("nan"), None, None, None, T0), (4, None, T0, 1.0, None, None, None, T0),
         (5, 1, None, 1.0, None, None, None, T0), (6, 1, T0 + timedelta(minutes=20), 8.0, None, None, None, T0), (6, 1, T0 + timedelta(minutes=20), 8.0, None, None, None, T0)], SCHEMA)
    g = grid(df)
    assert sorted(g) == [0, 10, 20] and g[0]["reading"] == 5.0 and g[10]["status"] == "filled" and g[20]["n_readings"] == 1
    assert to_grid(df.limit(0), "src", "t", "v", ["id"]).count() == 0
