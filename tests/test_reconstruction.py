from datetime import UTC, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmend.operators import anomaly, audit, features, fills, lookups, router, series, timezones
from gridmend.plans import daily, engine

S0 = 2_840_000  # some slot
R = "poste_id int, site string, slot bigint, value double"


def readings(spark, xs, site="Ptot_HA"):
    return spark.createDataFrame([(1, site, S0 + i, float(v)) for i, v in xs], R)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_gaps_do_not_depend_on_blocks(spark, monkeypatch):
    r = readings(spark, [(i, i) for i in range(0, 400) if i % 50 < 30 or i in (41, 42)])
    one = rows(series.gaps(r), "gap_start", "gap_end", "gap_size", "y_l", "y_r")
    monkeypatch.setattr(series.neighbours, "__defaults__", (7,))
    assert rows(series.gaps(r), "gap_start", "gap_end", "gap_size", "y_l", "y_r") == one and one[0] == (S0 + 30, S0 + 41, 11, 29.0, 41.0)
    assert series.gaps(r.limit(0)).count() == 0


def test_linear_and_median_fills(spark):
    r = readings(spark, [(0, 10), (4, 50)])
    g = series.gaps(r)
    assert rows(fills.linear(g), "slot", "value") == [(S0 + 1, 20.0), (S0 + 2, 30.0), (S0 + 3, 40.0)]
    assert [v for _, v in rows(fills.safe_median(g, r), "slot", "value")] == [30.0] * 3
    assert [v for _, v in rows(fills.safe_linear_median(g, r), "slot", "value")] == pytest.approx([21.0, 30.0, 39.0])


def test_anchor_against_numpy(spark):
    rng = np.random.default_rng(0)
    n = 1200
    v = 1000 + 300 * np.sin(2 * np.pi * np.arange(n) / 144) + rng.normal(0, 20, n)
    r = readings(spark, [(i, v[i]) for i in range(n) if not 500 <= i < 560])
    f = features.datetime_features(r)
    t = lookups.hour_template(f)
    g = series.gaps(r)
    got = [x for _, x in rows(fills.anchored(g, fills.template_fill(g, t, ["hour"]), r, t, ["hour"]), "slot", "value")]
    by_hour = {x["hour"]: x["tpl"] for x in t.collect()}
    hour = {x["slot"] - S0: x["hour"] for x in features.datetime_features(spark.range(S0, S0 + n).select(F.col("id").alias("slot"))).collect()}
    fill = np.array([by_hour[hour[i]] for i in range(500, 560)])
    yl, yr, m, med = v[499], v[560], 60, np.median
    pick = lambda o, i: o if abs(o) < abs(i) else i
    dl = pick(med([v[i] - by_hour[hour[i]] for i in range(494, 500)]), yl - med(fill[:6]))
    dr = pick(med([v[i] - by_hour[hour[i]] for i in range(560, 566)]), yr - med(fill[-6:]))
    i, tau = np.arange(m), max(6, min(36, m / 12))
    wl, wr = np.exp(-i / tau), np.exp(-(m - 1 - i) / tau)
    w = np.maximum(wl, wr)
    want = w * (yl + (i + 1) / (m + 1) * (yr - yl)) + (1 - w) * (fill + wl * dl + wr * dr)
    assert got == pytest.approx(want.tolist(), abs=1e-4)


def test_stuck_run_over_many_blocks(spark, monkeypatch):
    xs = [(i, 100 + i % 7) for i in range(60)] + [(i, 55) for i in range(60, 90)] + [(i, 100 + i % 7) for i in range(90, 140)]
    r = readings(spark, xs)
    monkeypatch.setattr(anomaly.runs, "__defaults__", (1e-4, 8))
    assert [s - S0 for (s,) in rows(anomaly.stuck(r), "slot")] == list(range(61, 90))


def test_zscore_forest_and_runs(spark):
    xs = [(i, 100 + (i * 7) % 11) for i in range(400)] + [(400, 9000), (401, 9100)]
    r = readings(spark, xs)
    z = anomaly.zscores(r)
    assert [s - S0 for (s,) in rows(z, "slot")] == [400, 401]
    runs = anomaly.flagged_runs(z.withColumn("reason", F.lit("z")).unionByName(z.withColumn("reason", F.lit("a"))))
    assert rows(runs, "run_start", "run_end", "n_slots", "reasons") == [(S0 + 400, S0 + 401, 2, "a, z")]
    top = rows(anomaly.isolation_forest(features.datetime_features(r), 0.01), "slot")
    assert {S0 + 400, S0 + 401} & {s for (s,) in top}


def test_router_rules(spark):
    cols = "poste_id int, site string, gap_start bigint, gap_size bigint, pure_weekend boolean, day_type string, tier string, parent_present boolean"
    cases = [(97, False, None, "sub", True), (60, False, None, "sub", True), (60, False, None, "entry", False), (2, False, None, "sub", True), (2, False, None, "main", False), (10, False, None, "unknown", False), (30, True, "sunday", "main", False), (30, False, None, "main", False), (30, False, None, "entry", False)]
    g = spark.createDataFrame([(1, "x", i, n, w, d, t, p) for i, (n, w, d, t, p) in enumerate(cases)], cols)
    want = ["MULTI_WEEK_TEMPLATE", "MICE", "SAFE_LINEAR_MEDIAN", "PEER_CORRELATION", "LINEAR_MICRO", "LINEAR_SHORT", "WEEKEND_TEMPLATE_SUNDAY", "THERMAL_TEMPLATE", "SAFE_LINEAR_MEDIAN"]
    assert [s for _, s in rows(router.route(g), "gap_start", "strategy")] == want
    off = router.route(g.withColumn("gap_size", F.lit(200)), router.Routing(False, mice=False, kalman=False, knn=False))
    assert [s for _, s in rows(off, "gap_start", "strategy")][4:6] == ["ENHANCED_TEMPLATE"] * 2


def test_smart_chunks_restart_their_count(spark):
    g = spark.createDataFrame([(1, "x", S0 + 6, S0 + 406, 400, 1.0, 1.0)], "poste_id int, site string, gap_start bigint, gap_end bigint, gap_size bigint, y_l double, y_r double")
    flat = spark.createDataFrame([(1, "x", d, 1.0) for d in ("Monday", "Tuesday")], "poste_id int, site string, day_of_week string, day_std double")
    got = rows(router.smart_chunks(g, flat), "chunk_index", "chunk_start", "chunk_end")
    midnight = {s["slot"] for s in features.datetime_features(spark.range(S0, S0 + 500).select(F.col("id").alias("slot"))).where("hour = 0 and slot % 6 = 0").collect()}
    count, cuts = -1, []
    for s in range(S0 + 6, S0 + 406):
        count += 1
        if s > S0 + 6 and (count >= 144 or (s in midnight and count >= 96)):
            cuts.append(s)
            count = 0
    assert [a for _, a, _ in got] == [S0 + 6, *cuts] and got[-1][2] == S0 + 406
    assert rows(router.fixed_chunks(g), "chunk_start", "chunk_end")[-1] == (S0 + 6 + 384, S0 + 406)


def test_kalman_blocks_equal_the_whole(spark):
    r = readings(spark, [(i, 50 + (i * 13) % 29) for i in range(300) if i % 40 < 33])
    g = series.gaps(r)
    assert [v for _, v in rows(fills.kalman(r, g, 37), "slot", "value")] == pytest.approx([v for _, v in rows(fills.kalman(r, g, 10**9), "slot", "value")], abs=1e-12)


def test_knn_against_brute_force(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.uniform(0, 9, (80, 3)), 1)
    y = [None if i % 9 == 4 else float(np.round(x[i].sum(), 2)) for i in range(80)]
    w = spark.createDataFrame([(1, S0 + i, *map(float, x[i]), y[i]) for i in range(80)], "poste_id int, slot bigint, a double, b double, c double, d double")
    g = series.gaps(series.long(w, ("a", "b", "c", "d")))
    got = {r["slot"] - S0: r["value"] for r in fills.knn(w, g, ("a", "b", "c", "d"), block=16, queries=3).collect()}
    known = [i for i in range(80) if y[i] is not None]
    for q in (i for i in range(80) if y[i] is None):
        best = sorted(known, key=lambda i: (((x[i] - x[q]) ** 2).sum(), i))[:5]
        assert got[q] == pytest.approx(sum(y[i] for i in best) / 5, abs=1e-3)


def test_mice_recovers_a_linear_relation(spark):
    rng = np.random.default_rng(4)
    a, b = rng.normal(5, 2, 300), rng.normal(-3, 1, 300)
    w = spark.createDataFrame([(1, S0 + i, float(a[i]), float(b[i]), None if i % 10 == 0 else float(2 * a[i] - b[i] + 1)) for i in range(300)] + [(2, S0, 1.0, None, None)], "poste_id int, slot bigint, a double, b double, c double")
    out = {(r["poste_id"], r["slot"]): r["c"] for r in fills.mice(w, ("a", "b", "c")).collect()}
    assert max(abs(out[1, S0 + i] - (2 * a[i] - b[i] + 1)) for i in range(0, 300, 10)) < 0.2 and out[2, S0] is None


def test_mice_fills_slots_without_a_row(spark):
    rng = np.random.default_rng(5)
    a = rng.normal(5, 2, 200)
    known = {i: float(3 * a[i] + 1) for i in range(200) if not 50 <= i < 60 and i % 20}
    w = spark.createDataFrame([(1, S0 + i, float(a[i]), known.get(i)) for i in range(200) if not 50 <= i < 60], "poste_id int, slot bigint, a double, b double")
    whole = w.join(spark.range(S0, S0 + 200).select(F.lit(1).alias("poste_id"), F.col("id").alias("slot")), ["poste_id", "slot"], "right")
    g = series.gaps(series.long(w, ("a", "b")))
    want = {(c, r["slot"]): r[c] for r in fills.mice(whole, ("a", "b")).collect() for c in ("a", "b")}
    got = {(r["site"], r["slot"]): r["value"] for r in fills.mice_gaps(w, g, ("a", "b")).collect()}
    assert set(got) == {(r["site"], r["slot"]) for r in series.points(g).collect()} and {("a", S0 + i) for i in range(50, 60)} <= set(got)
    assert all(v == pytest.approx(want[k], abs=1e-3) for k, v in got.items())
    assert got["b", S0 + 55] == pytest.approx(np.mean(list(known.values())), abs=1e-3) and got["b", S0 + 20] == pytest.approx(3 * a[20] + 1, abs=0.2)


def test_savgol_keeps_cubics(spark):
    r = readings(spark, [(i, 2 + 0.5 * i - 0.01 * i**2 + 1e-4 * i**3) for i in range(60)])
    got = rows(fills.savgol(r), "slot", "value", "smooth")
    assert len(got) == 40 and all(s == pytest.approx(v, abs=2e-3) for _, v, s in got)


def test_forward_then_backward(spark):
    df = spark.createDataFrame([(1, i, float(i) if i in (5, 40) else None) for i in range(60)] + [(2, 1, None)], "src int, slot bigint, v double")
    got = {(r["src"], r["slot"]): r["v"] for r in features.fill_forward_backward(df, "src", "slot", "v", 6).collect()}
    assert got[1, 0] == 5.0 and got[1, 39] == 5.0 and got[1, 59] == 40.0 and got[2, 1] is None


def test_clock_changes(spark):
    df = spark.createDataFrame([(t,) for t in ("2025-10-26 02:30:00", "2025-03-30 02:30:00", "2025-07-01 12:00:00")], "t string").select(F.unix_micros(timezones.localise(F.to_timestamp("t"))).alias("u"), "t")
    got = {r["t"]: datetime.fromtimestamp(r["u"] / 1e6, UTC).strftime("%m-%dT%H:%M") for r in df.collect()}
    assert list(got.values()) == ["10-26T01:30", "03-30T01:00", "07-01T10:00"]


def test_upsert(spark):
    t = spark.createDataFrame([(1, "a", 1.0, 5), (2, "b", 2.0, 6)], "k int, name string, v double, q int")
    b = spark.createDataFrame([(2, None, 0), (3, 9.0, 1)], "k int, v double, q int")
    assert rows(audit.upsert(t, b, ["k"]), "k", "name", "v", "q") == [(1, "a", 1.0, 5), (2, "b", None, 0), (3, None, 9.0, 1)]


def test_small_helpers(monkeypatch):
    monkeypatch.setenv("HOUR", "25")
    with pytest.raises(ValueError):
        daily.env_int("HOUR", 1, 0, 23)
    with pytest.raises(ValueError):
        daily.parse_gap("2024-01-02", "2024-01-01")
    assert daily.tomorrow(now=datetime(2024, 3, 1, 23, 30, tzinfo=UTC)).isoformat() == "2024-03-03"


def test_csv_window(spark, tmp_path):
    from gridmend.sources.files import csv_window

    lines = [f"2024-01-01T{h:02d}:{m}0:00Z,{'' if h == 3 else h}" for h in range(24) for m in range(6)]
    (tmp_path / "ok.csv").write_text("timestamp,value\n" + "\n".join(lines))
    assert csv_window(spark, str(tmp_path / "ok.csv"), rows=144).where("value is null").count() == 6
    (tmp_path / "bad.csv").write_text("timestamp,value\n" + "\n".join([*lines[:-1], lines[0]]))
    with pytest.raises(ValueError, match="increase"):
        csv_window(spark, str(tmp_path / "bad.csv"), rows=144)
    with pytest.raises(ValueError, match="rows"):
        csv_window(spark, str(tmp_path / "ok.csv"))


def test_reconstruct_properties(spark, data):
    t = lambda n: spark.read.parquet(f"{data}/{n}.parquet")
    out = engine.reconstruct(t("conso_historiques_clean"), t("compteurs"), t("calendar_days")).values.cache()
    raw = series.readings(t("conso_historiques_clean"))
    assert out.where("value is null or quality not between 0 and 3").count() == 0
    assert out.select(*series.KEY, "slot").distinct().count() == out.count()
    kept = out.where("not anomaly_replaced").join(raw.withColumnRenamed("value", "raw"), [*series.KEY, "slot"])
    assert kept.where("abs(value - raw) > 0.001 or quality <> 0").count() == 0
    out.unpersist()


def campus(spark, rows):
    """Tables for reconstruct: rows of (slot, Ptot_HA, Ptot_HEI) of station 1."""
    cols = "poste_id int, Date timestamp, reading_id bigint, Ptot_HA double, Ptot_HEI double, Ptot_HEI_13RT double, Ptot_HEI_5RNS double, Ptot_RIZOMM double"
    clean = spark.createDataFrame([(1, datetime.fromtimestamp((S0 + i) * 600, UTC), i, a, h, None, None, None) for i, a, h in rows], cols)
    meters = spark.createDataFrame([("Ptot_HA", "entry", None), ("Ptot_HEI", "main", None)], "site string, tier string, parent string")
    return clean, meters, spark.createDataFrame([], "cal_date date, kind string")


def test_reconstruct_runs_mice_and_falls_through(spark):
    rng = np.random.default_rng(6)
    a = rng.uniform(400, 600, 600)
    # 60 slots of Ptot_HEI: 50 whose other channel is there, 10 without any row
    clean, meters, days = campus(spark, [(i, float(a[i]), None if 300 <= i < 360 else float(2 * a[i] + 50)) for i in range(600) if not 350 <= i < 360])

    def hei(how):
        out = engine.reconstruct(clean, meters, days, engine.Config(how, mask_anomalies=False)).values.where(f"site = 'Ptot_HEI' and slot >= {S0 + 300} and slot < {S0 + 360}")
        return {r["slot"] - S0: r for r in out.collect()}

    got = hei(engine.Config().routing)
    assert len(got) == 60 and {r["strategy"] for r in got.values()} == {r["effective_strategy"] for r in got.values()} == {"MICE"}
    assert max(abs(got[i]["value"] - (2 * a[i] + 50)) for i in range(300, 350)) < 5 and abs(got[355]["value"] - 1050) < 40
    assert {r["effective_strategy"] for r in hei(router.Routing(mice=False)).values()} == {"KALMAN"}
    # neighbours can't fill slots without the other channel: the whole gap goes to the rule after them
    assert {r["strategy"] for r in hei(router.Routing(mice=False, kalman=False)).values()} == {"THERMAL_TEMPLATE"}


def test_reconstruct_masks_readings_near_zero(spark):
    # on a Monday evening; 0 is within 3 deviations of this channel, and nothing stands still
    v = {i: 1000.0 + 600 * (i % 2) - 300 * (i % 3) for i in range(300)} | {i: 0.0 for i in (260, 261, 262)}
    clean, meters, days = campus(spark, [(i, x, None) for i, x in v.items()])
    r = series.readings(clean)
    bad = {x["slot"] for x in anomaly.near_zero(features.full_features(r, features.calendar(days))).collect()}
    assert bad == {S0 + 260, S0 + 261, S0 + 262} and anomaly.zscores(r).count() == 0
    out = {x["slot"] - S0: x for x in engine.reconstruct(clean, meters, days).values.collect()}
    assert all(out[i]["anomaly_replaced"] and out[i]["value"] > 10 and out[i]["quality"] == 0 for i in (260, 261, 262))


def test_reconstruct_fills_anew_what_is_near_zero(spark):
    # the smoother over zeros leaves the middle of a gap near 0
    clean, meters, days = campus(spark, [(i, None, 1000.0 + i % 7) for i in range(3000) if not 500 <= i < 555])
    got = engine.reconstruct(clean, meters, days, engine.Config(router.Routing(mice=False), mask_anomalies=False))
    low = [(x["gap_start"] - S0, x["gap_end"] - S0) for x in got.corrected.collect()]
    out = {x["slot"] - S0: x for x in got.values.collect()}
    assert len(low) == 1 and 500 < low[0][0] < low[0][1] < 555
    assert len(out) == 3000 and all(out[i]["value"] > 10 and out[i]["effective_strategy"] != "KALMAN" for i in range(*low[0]))
    assert engine.reconstruct(clean, meters, days, engine.Config(mask_anomalies=False)).corrected is None


def test_stream_slots(spark, tmp_path):
    from gridmend.streaming.online import slots

    src = "poste_id int, Date timestamp, Ptot_HA double"
    spark.createDataFrame([(1, datetime(2024, 1, 1, 0, 3), 4.0), (1, datetime(2024, 1, 1, 0, 7), 6.0), (1, datetime(2024, 1, 1, 9), 1.0), (2, datetime(2024, 1, 1), None)], src).write.parquet(str(tmp_path / "in"))
    q = slots(spark.readStream.schema(src).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("slots").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert [(r["n"], r["value"]) for r in spark.table("slots").collect()] == [(2, 5.0)]
