from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridmend.operators import rolling

T0 = datetime(2023, 12, 28)


def frame(spark, xs):
    return spark.createDataFrame([(i, 3, T0 + timedelta(days=d, minutes=i), v, "x") for i, (d, v) in enumerate(xs)], "id bigint, src int, t timestamp_ntz, v double, day string")


def test_totals_days_without_readings_and_zero(spark):
    out = {r["day_utc"]: r for r in rolling.rolling_totals(frame(spark, [(0, 1.0), (0, 2.0), (2, 0.0), (9, 5.0), (40, None), (41, 4.0)]), "src", "t", "v", ["id"]).collect()}
    assert len(out) == 42
    assert (out["2023-12-29"]["n_day"], out["2023-12-29"]["total_7"], out["2023-12-30"]["n_day"], out["2023-12-30"]["mean_7"]) == (0, 3.0, 1, 1.0)
    assert out["2024-01-05"]["mean_7"] == 0.0 and out["2024-01-06"]["total_7"] == 5.0 and out["2024-01-06"]["total_30"] == 8.0
    assert out["2024-01-20"]["mean_7"] is None and out["2024-01-20"]["total_7"] == 0.0 and out["2024-02-07"]["total_30"] == 4.0


@settings(max_examples=200, deadline=None)
@given(st.integers(-500, 500), st.integers(0, 400))
def test_cover_is_exact_and_short(lo, n):
    """The closed form against a literal reading of its definition."""
    hi, k, got = lo + n, rolling.TOP, []
    for lv in range(k):
        left, right = (lo + (1 << lv) - 1) >> lv, (hi + 1) >> lv
        if left < right:
            got += [(lv, left)] * (left % 2) + [(lv, right - 1)] * (right % 2)
    left, right = (lo + (1 << k) - 1) >> k, (hi + 1) >> k
    got += [(k, i) for i in range(left, right)]
    assert sorted(d for lv, i in got for d in range(i << lv, (i + 1) << lv)) == list(range(lo, hi + 1))


def test_cover_in_spark(spark):
    q = spark.createDataFrame([(a, a + n) for a in range(-70, 70, 7) for n in (0, 6, 29, 200)], "lo bigint, hi bigint")
    for r in q.select("lo", "hi", rolling.cover(F.col("lo"), F.col("hi")).alias("c")).collect():
        assert sorted(d for x in r["c"] for d in range(x["idx"] << x["level"], (x["idx"] + 1) << x["level"])) == list(range(r["lo"], r["hi"] + 1))


def test_late_corrections_touch_only_ancestors(spark):
    days = spark.createDataFrame([(1, d, float(d), 2) for d in range(19700, 19800)], "entity int, day bigint, total double, n bigint")
    change = spark.createDataFrame([(1, 19750, 10.0, 1), (1, 19900, 3.0, 1)], "entity int, day bigint, total double, n bigint")
    old = rolling.build_tree(days)
    new = {(r["level"], r["idx"]): (r["total"], r["n"]) for r in rolling.correct_tree(old, change).collect()}
    whole = {(r["level"], r["idx"]): (r["total"], r["n"]) for r in rolling.build_tree(days.unionByName(change)).collect()}
    assert new == whole
    before = {(r["level"], r["idx"]): (r["total"], r["n"]) for r in old.collect()}
    assert {k for k in new if before.get(k) != new[k]} == {(lv, d >> lv) for d in (19750, 19900) for lv in range(rolling.TOP + 1)}


def test_empty_and_null(spark):
    f = frame(spark, [(0, float("nan"))])
    assert rolling.rolling_totals(f, "src", "t", "v", ["id"]).count() == 0
    assert rolling.rolling_totals(f.limit(0), "src", "t", "v", ["id"]).count() == 0


def test_last_sent_row_counts(spark):
    df = spark.createDataFrame([(1, 1, T0, 5.0), (2, 1, T0, 7.0)], "id bigint, src int, t timestamp_ntz, v double")
    assert rolling.rolling_totals(df, "src", "t", "v", ["id"]).collect()[0]["total_7"] == pytest.approx(7.0)
