from datetime import datetime, timedelta

import numpy as np
import pytest

from gridmend.operators.spikes import N_EXC, N_RUNS, N_STEPS, SIZES, SpikeModel, fit_pooled, fit_runs, fit_source, flag_spikes, forward_backward, pool, transitions

T0 = datetime(2024, 1, 1)


def test_forward_backward_equals_enumeration():
    rng, a = np.random.default_rng(0), transitions(5e-5, 2e-3)
    prior = np.array([0.97, 0.01, 0.01, 0.01])
    for t in (1, 2, 7, 40):
        e = rng.uniform(0.1, 3, (2, t, 4))
        got = forward_backward(e, a, prior)
        for s in range(2):
            f, b = np.empty((t, 4)), np.ones((t, 4))
            v = prior
            for i in range(t):
                v = f[i] = (v @ a) * e[s, i]
            for i in range(t - 2, -1, -1):
                b[i] = a @ (e[s, i + 1] * b[i + 1])
            want = f * b
            assert np.allclose(got[s], want / want.sum(1, keepdims=True))


def series(n=3000, seed=1):
    rng = np.random.default_rng(seed)
    i = np.arange(n)
    load = 10_000 * (1 + 0.5 * np.sin(2 * np.pi * i / 144)) * np.exp(rng.normal(0, 0.03, n))
    return np.round(load * 2) / 2


def found(spark, v, extra=(), model=SpikeModel()):
    rows = [(i, 1, T0 + timedelta(minutes=10 * i), None if np.isnan(x) else float(x), float("nan"), "x") for i, x in enumerate(v)] + list(extra)
    df = spark.createDataFrame(rows, "id bigint, src int, Date timestamp_ntz, a double, b double, state string")
    out = flag_spikes(df, "id", "src", "Date", ["a", "b"], model).collect()
    assert all(r["channel"] == "a" for r in out)
    return {r["id"]: r["state"] for r in out}


def test_injected_cases(spark):
    v = series()
    v[500] *= 8
    v[700:702] /= 9
    v[900] = -9999
    v[1000:1020] *= 1000
    v[1200:1260] = v[1200]
    v[1500:1503] *= 3  # a start-up peak
    v[1700:1705] = v[1700]  # a short repeat
    v[2000:] *= 3.2  # a lasting change of level
    v[2500] = np.nan
    s = found(spark, v)
    bad = {i for i, x in s.items() if x != "normal"}
    assert bad == {500, 700, 701, 900, *range(1000, 1020), *range(1201, 1260)} and 2500 not in s
    assert s[500] == "spike" and s[900] == "out_of_range" and s[1230] == "stuck"


def noisy(v, a, b, seed=5):
    """v stands still from a to b (without b) with a trace of noise, far below its ordinary steps."""
    v[a:b] = v[a] + np.r_[0, np.random.default_rng(seed).normal(0, v[a] * 2e-5, b - a - 1)]


def test_standing_still_with_a_trace_of_noise(spark):
    v = series(3000, 4)
    noisy(v, 400, 470)
    noisy(v, 1500, 1520)
    for k in range(2000, 2900, 90):  # short repeats, as this channel has them now and then
        v[k : k + 9] = v[k]
    bad = {i for i, x in found(spark, v).items() if x != "normal"}
    want = {*range(401, 470), *range(1501, 1520)}
    assert want <= bad and len(bad - want) <= 2


def test_long_repeats_are_ordinary_at_a_coarse_source(spark):
    rng = np.random.default_rng(6)
    i = np.arange(8000)
    coarse = np.round(20 * (1 + 0.5 * np.sin(2 * np.pi * i / 144)) * np.exp(np.cumsum(rng.normal(0, 0.01, len(i))) * 0.05 + rng.normal(0, 0.01, len(i))))
    change = np.flatnonzero(np.r_[True, np.diff(coarse) != 0])
    longest = np.diff(np.r_[change, len(coarse)]).max()
    assert longest >= 10  # far beyond what a finer source repeats
    coarse[5000:5120] = coarse[5000]
    s = found(spark, coarse)
    bad = {i for i, x in s.items() if x != "normal"}
    assert {*range(5001, 5120)} <= bad and len(bad) < 140
    fine = series(8000, 7)
    fine[3000 : 3000 + longest] = fine[3000]
    assert {3001 + i for i in range(longest - 1)} <= {i for i, x in found(spark, fine).items() if x == "stuck"}


def test_repeats_by_two_kinds():
    runs = np.zeros(N_RUNS + 1)
    runs[1], runs[4:10] = 100_000, [350, 280, 250, 270, 280, 210]  # ordinary repeats end at 9
    runs[12:60] = 1
    h, share, rho = fit_runs(runs, 0.02)
    assert (share[4:10] < 0.1).all() and (share[20:] > 0.99).all() and h[9] < 0.1 and 0 < rho < 1e-3
    # more of the same is told apart no worse: what stands still never becomes the order of things by being frequent in number
    h, share, _ = fit_runs(1000 * runs, 0.02)
    assert (share[4:10] < 0.1).all() and (share[12:] > 0.99).all() and h[9] < 0.02
    assert fit_runs(np.zeros(N_RUNS + 1), 0.02)[2] == 1e-6


def test_what_a_source_shows_too_seldom_comes_from_all():
    m = SpikeModel()
    full = [np.zeros(n) for n in SIZES]
    full[0][60:80], full[1][1:10], full[2][38:43] = 500, [9000, 20, 5, 20, 20, 15, 15, 10, 10], 2000
    total = {k: 50 * x for k, x in pool(full).items()}
    pooled = fit_pooled(total, m)
    empty = fit_source([np.zeros(n) for n in SIZES], pooled, m)
    assert np.isfinite(empty).all() and len(empty) == N_STEPS + N_RUNS + 1 + N_EXC


def test_blocks_agree(spark):
    v = series(4000, 2)
    v[2016 - 30 : 2016 + 40] = v[1986]  # across the border of two blocks
    v[2500] *= 7
    assert found(spark, v) == found(spark, v, model=SpikeModel(block_days=400))


def test_rows_sent_again_are_judged_by_their_own_number(spark):
    v = series(1000, 3)
    v[300:360] = v[300]
    again = [(10_001, 1, T0 + timedelta(minutes=10 * 320), float(v[300]), None, "x"), (10_002, 1, T0 + timedelta(minutes=10 * 500), float(v[500] * 9), None, "x"), (10_003, 1, None, 1.0, 1.0, "x"), (10_004, None, T0, 1.0, 1.0, "x")]
    s = found(spark, v, again)
    assert s[10_001] == "stuck" and s[10_002] == "spike" and s[500] == "normal" and s[340] == "stuck" and not {10_003, 10_004} & s.keys()


def test_small_and_empty(spark):
    df = spark.createDataFrame([(1, 1, T0, 5.0), (2, 2, T0, float("inf")), (3, 2, T0, 0.0)], "id bigint, src int, Date timestamp_ntz, a double")
    assert flag_spikes(df, "id", "src", "Date", ["a"]).count() == 3
    assert flag_spikes(df.limit(0), "id", "src", "Date", ["a"]).count() == 0
    with pytest.raises(ValueError):
        flag_spikes(df, "id", "src", "Date", [])


def test_a_source_of_impossible_numbers_only(spark):
    rows = [(i, 1, T0 + timedelta(minutes=10 * i), -5.0, None) for i in range(50)] + [(100 + i, 2, T0 + timedelta(minutes=10 * i), 10.0 + i % 3, float("inf")) for i in range(50)]
    df = spark.createDataFrame(rows, "id bigint, src int, Date timestamp_ntz, a double, b double")
    out = {(r["id"], r["channel"]): r["state"] for r in flag_spikes(df, "id", "src", "Date", ["a", "b"]).collect()}
    assert len(out) == 150 and all(out[i, "a"] == "out_of_range" and out[100 + i, "b"] == "out_of_range" for i in range(50))
