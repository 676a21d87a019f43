import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmend.operators import audit, features, fills, lookups, router, series
from gridmend.plans import engine

METERS = "site string, parent string, children array<string>, tier string"
#: The flag that each strategy leaves, 1 linear, 2 contextual, 3 from donor days or learned.
FLAGS = {
    "LINEAR_MICRO": 1, "LINEAR_SHORT": 1, "THERMAL_TEMPLATE": 2, "ENHANCED_TEMPLATE": 2, "WEEKEND_TEMPLATE_SATURDAY": 2, "WEEKEND_TEMPLATE_SUNDAY": 2, "WEEKEND_TEMPLATE_MIXED": 2,
    "SAFE_LINEAR_MEDIAN": 2, "PEER_CORRELATION": 2, "MULTI_WEEK_TEMPLATE": 3, "MICE": 3, "KNN_CONTEXT": 3, "KALMAN_FILTER": 3, "SAFE_MEDIAN": 3, "ANYTHING_ELSE": 2,
}


def test_flags(spark):
    got = spark.createDataFrame([(s,) for s in FLAGS], "s string").select("s", router.by_strategy(1, F.col("s")).alias("q")).collect()
    assert {r["s"]: r["q"] for r in got} == FLAGS


@pytest.fixture(scope="module")
def example(spark):
    t0 = 2893248  # a Monday in January, 00:00 UTC
    rng = np.random.default_rng(0)
    rows = []
    for site, gone in (("Ptot_HEI", [(3000, 3003), (3400, 3440)]), ("Ptot_HEI_13RT", [(2000, 2012), (3001, 3002), (3500, 3600)])):
        for i in range(144 * 35):
            if not any(a <= i < b for a, b in gone):
                rows.append((1, site, t0 + i, float(1000 + 200 * np.sin(i / 144 * 6.28) + rng.normal(0, 5))))
    r = spark.createDataFrame(rows, "poste_id int, site string, slot bigint, value double").cache()
    meters = spark.createDataFrame([("Ptot_HEI", None, ["Ptot_HEI_13RT"], "main"), ("Ptot_HEI_13RT", "Ptot_HEI", [], "sub")], METERS)
    cal = features.calendar(spark.createDataFrame([("2025-01-20", "Holiday")], "cal_date string, kind string").withColumn("cal_date", F.to_date("cal_date")))
    g = router.route(router.with_hierarchy(router.classify(series.gaps(r)), r, meters))
    return t0, r, meters, cal, router.with_confidence(g, cal)


def test_details_and_records(spark, example):
    t0, r, meters, cal, c = example
    f = features.datetime_features(r)
    args = c, cal, lookups.peer_ratio(r, meters), lookups.uncertainty_bounds(r)
    d = {(x["site"], x["gap_start"] - t0): x for x in audit.gap_details(*args).collect()}
    assert d["Ptot_HEI", 3000]["routing_trace"].startswith("START: size=3, tier=main -> BRANCH: LINEAR_MICRO (size<=3) -> SELECTED: LINEAR_MICRO (confidence=")
    assert "BRANCH: PEER_CORRELATION (sub-meter) -> SELECTED" in d["Ptot_HEI_13RT", 2000]["routing_trace"] and d["Ptot_HEI_13RT", 2000]["peer_ratio"] == pytest.approx(1, abs=0.05)
    assert "SKIP: parent has no data in gap window" in d["Ptot_HEI_13RT", 3001]["routing_trace"] and d["Ptot_HEI_13RT", 3001]["peer_ratio"] is None
    assert "MULTI_WEEK_TEMPLATE" in d["Ptot_HEI_13RT", 3500]["routing_trace"] and d["Ptot_HEI", 3400]["gap_size_minutes"] == 400
    x = d["Ptot_HEI_13RT", 2000]
    assert x["first_missing"][-5:] == "+0100" and x["lower"] < 1000 < x["upper"] and x["unique_days"]
    recs = {(x["site"], x["gap_start"] - t0): json.loads(x["record"]) for x in audit.gap_records(c, cal, lookups.weekly_templates(f), *args[2:]).collect()}
    doc = recs["Ptot_HEI_13RT", 2000]
    assert len(doc["missing"]) == 12 and doc["missing"][0]["slot"] == t0 + 2000 and doc["missing"][0]["timestamp"] == x["first_missing"] and doc["method"] == "PEER_CORRELATION"
    assert doc["routing_trace"][0].startswith("START") and doc["inputs_used"]["template_values"][0]["recent_count"] >= 0 and doc["inputs_used"]["uncertainty_bounds"]["lower"] == x["lower"]
    assert audit.gap_records(c.limit(0), cal, lookups.weekly_templates(f), *args[2:]).count() == 0


def test_one_pass_fills_like_the_strategies_one_by_one(spark, data):
    from gridmend.plans import reference

    r = reference._rc(spark, data)
    f = features.day_flags(features.datetime_features(r), reference._cal(spark, data))
    g = reference._routed(spark, data, router.Routing(True, mice=False, kalman=False, knn=False), r).where("strategy <> 'PEER_CORRELATION'").cache()
    hour, day, week, med = lookups.hour_template(f), lookups.day_templates(f), lookups.weekly_templates(f), fills.medians(r)
    got = fills.template_gaps(g, r, hour, day, week, med)
    of = lambda *s: g.where(F.col("strategy").isin(*s))
    parts = [
        fills.linear(of("LINEAR_MICRO", "LINEAR_SHORT")), fills.safe_linear_median(of("SAFE_LINEAR_MEDIAN"), r), fills.thermal(of("THERMAL_TEMPLATE", "ENHANCED_TEMPLATE"), r, hour),
        fills.weekend(g.where("strategy like 'WEEKEND%'"), r, day), fills.multi_week(of("MULTI_WEEK_TEMPLATE"), r, week, hour).drop("point_confidence"),
    ]
    want = parts[0]
    for p in parts[1:]:
        want = want.unionByName(p)
    both = got.where("value is not null").join(want.withColumnRenamed("value", "want"), [*router.GAP, "slot"], "full")
    assert got.count() == g.agg(F.sum("gap_size")).first()[0] and both.where("value is null or want is null or abs(value - want) > 1e-6").count() == 0
    assert {r["by"] for r in got.select("by").distinct().collect()} >= {"LINEAR", "MULTI_WEEK"} and isinstance(engine.Config(), engine.Config)


def test_smoother_by_its_equations():
    y = np.random.default_rng(1).normal(size=30)
    n = len(y)
    # the mean given all readings of a walk that starts from 0 with variance 1: (A + I) x = y, A the walk's precision
    a = np.zeros((n, n))
    a[0, 0] = 1.0
    for i in range(1, n):
        a[i, i] += 1
        a[i - 1, i - 1] += 1
        a[i, i - 1] -= 1
        a[i - 1, i] -= 1
    assert np.allclose(fills.smooth_cells(y.tolist()), np.linalg.solve(a + np.eye(n), y)) and fills.smooth_cells([]) == []
