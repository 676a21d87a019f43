"""Implausible numbers in measurements: a hidden Markov model per source (problem 1)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmend.functions.cols import epoch_us, floordiv, number, ref
from gridmend.sources.tables import checkpoint_dir

DAY_US = 86_400_000_000
NORMAL, SPIKE, STUCK, OUT = range(4)
NAMES = ("normal", "spike", "stuck", "out_of_range")


@dataclass(frozen=True)
class SpikeModel:
    """Structure of the model; ratios are decimal logarithms of number / usual load at that time of day. What is usual is learned (`fit_sources`)."""

    bound: float = 1.3  # hard bound: further from the source's usual load nothing is possible
    floor: float = 1e-4  # numbers below this share of the usual load count as this share
    tail: float = 0.2  # excursions from the neighbourhood below this are in order
    leave_stuck: float = 0.02  # chance that a channel that stands still moves again
    again: float = 0.99  # chance that a number that stands still without a trace of noise is repeated once more
    least: float = 1e-6  # least chance of a step in either state
    pull: float = 10.0  # a source's own counts against the pooled ones: these weigh as much as so many of its own
    onset: float = 5e-5  # how often a channel begins to stand still, and how often a spike, before anything is counted; weighs as much as so many readings
    spike: float = 2e-3
    weight: float = 100_000.0
    near: int = 4  # readings next to one that are kept out of its neighbourhood, and the neighbourhood's width
    width: int = 9
    step_us: int = 600_000_000  # step of the daily profile
    block_days: int = 14
    halo_days: float = 2.0


#: Histograms of the block statistics: sizes of steps (eighths of a decade from 1e-6), lengths of exact repeats, excursions (twentieths of a decade from -2).
EIGHTH, LEAST_STEP, N_STEPS = 0.125, -6.0, 136
N_RUNS, N_EXC, EXC = 64, 80, 0.05
STEP, RUN, EXCURSION = range(3)
SIZES = (N_STEPS, N_RUNS + 1, N_EXC)


def forward_backward(e: np.ndarray, a: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """State probabilities given all emissions: e is (n sequences, steps, states), a the transition matrix.

    Exact, but with about 3 * sqrt(steps) interpreted steps: products of transition matrices are formed for sqrt(steps) pieces at
    once, chained, and the recursions then run inside all pieces at once.
    """
    b, t, s = e.shape
    if t == 0:
        return e
    size = max(1, int(np.ceil(np.sqrt(t))))
    n = -(-t // size)
    x = np.ones((b, n * size, s))
    x[:, :t] = e
    x = x.reshape(b, n, size, s)
    m = np.broadcast_to(np.eye(s), (b, n, s, s))
    for i in range(size):
        m = (m @ a) * x[:, :, i, None, :]
        m = m / m.max((2, 3), keepdims=True)
    start, end = np.empty((b, n, s)), np.empty((b, n, s))
    f = np.broadcast_to(prior, (b, s))
    for p in range(n):
        start[:, p] = f
        f = np.einsum("bi,bij->bj", f, m[:, p])
        f = f / f.sum(1, keepdims=True)
    g = np.ones((b, s))
    for p in range(n - 1, -1, -1):
        end[:, p] = g
        g = np.einsum("bij,bj->bi", m[:, p], g)
        g = g / g.max(1, keepdims=True)
    post, f = np.empty_like(x), start
    for i in range(size):
        f = (f @ a) * x[:, :, i]
        f = f / f.sum(2, keepdims=True)
        post[:, :, i] = f
    g = end
    for i in range(size - 1, -1, -1):
        p = post[:, :, i] * g
        post[:, :, i] = p / p.sum(2, keepdims=True)
        g = (x[:, :, i] * g) @ a.T
        g = g / g.max(2, keepdims=True)
    return post.reshape(b, n * size, s)[:, :t]


def transitions(onset: float, spike: float, leave: float = 0.02) -> np.ndarray:
    to = np.array([[0.0, spike, onset, 1e-3], [0.4, 0.0, onset, 0.05], [leave, 1e-3, 0.0, 1e-3], [0.2, 0.02, onset, 0.0]])
    return to + np.diag(1 - to.sum(1))


def _side_median(x: pd.Series, near: int, width: int) -> np.ndarray:
    return x.shift(near).rolling(width, min_periods=3).median().to_numpy()


def usual(slots: np.ndarray, medians: np.ndarray, n_slots: int) -> np.ndarray:
    """The decimal log of the usual load by slot of the day; smoothed over five slots, gaps bridged around the clock."""
    p = np.full(n_slots, np.nan)
    ok = medians > 0
    p[slots[ok]] = np.log10(medians[ok])
    if not ok.any():
        return p
    i = np.flatnonzero(~np.isnan(p))
    p = np.interp(np.arange(n_slots), np.r_[i[-1] - n_slots, i, i[0] + n_slots], np.r_[p[i[-1]], p[i], p[i[0]]])
    return np.median(np.stack([np.roll(p, k) for k in range(-2, 3)]), 0)


def excursions(t: np.ndarray, v: np.ndarray, profile: np.ndarray, m: SpikeModel) -> tuple[np.ndarray, np.ndarray]:
    """By how many decades each number lies off its neighbourhood, and which numbers are impossible."""
    u = profile[(t // m.step_us) % len(profile)]
    top = np.nanmax(profile) if not np.isnan(profile).all() else 0.0
    with np.errstate(divide="ignore", invalid="ignore"):
        x = np.log10(np.maximum(v, 10 ** (u + np.log10(m.floor)))) - u
    x = np.nan_to_num(np.where(np.isfinite(v), x, 99.0), nan=0.0)
    hard = (v < 0) | ~np.isfinite(v) | (np.abs(x) > m.bound) | (v > 10 ** (top + m.bound + 1))
    # the neighbourhood before and after, whichever is nearer: a lasting change of level agrees with one of them
    s = pd.Series(np.where(hard, np.nan, x))
    left, right = _side_median(s, m.near, m.width), _side_median(s[::-1], m.near, m.width)[::-1]
    dl, dr = x - left, x - right
    d = np.where(np.isnan(dr) | (np.abs(dl) <= np.abs(dr)), dl, dr)
    return np.nan_to_num(np.where(np.isnan(d), x, d), nan=0.0), hard


def _step_bins(step: np.ndarray) -> np.ndarray:
    """The bin of each step's size; 0 for none, the first number included."""
    with np.errstate(divide="ignore", invalid="ignore"):
        b = np.floor((np.log10(step) - LEAST_STEP) / EIGHTH) + 1
    return np.nan_to_num(np.clip(b, 1, N_STEPS - 1), nan=N_STEPS - 1).astype(int) * (step != 0)


def _walk(t: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first row of each time, its group by row, bin of the step to each first row, length so far of its exact repeat, 1 if none).

    The walk goes along the first row of each time, so that rows sent again neither lengthen nor break a stretch.
    """
    first = np.r_[True, t[1:] != t[:-1]]
    c = v[first]
    with np.errstate(invalid="ignore"):
        step = np.r_[np.inf, np.abs(np.diff(c))]
    step[0] = np.inf
    still = step == 0
    run = np.cumsum(~still) - 1
    return first, np.cumsum(first) - 1, _step_bins(step), np.arange(len(c)) - np.flatnonzero(~still)[run] + 1


def statistics(t: np.ndarray, v: np.ndarray, mine: np.ndarray, profile: np.ndarray, m: SpikeModel) -> list[np.ndarray]:
    """The block's histograms: of steps, of the lengths of exact repeats that begin in it, and of excursions. Impossible numbers are left out."""
    d, hard = excursions(t, v, profile, m)
    t, v, mine, d = t[~hard], v[~hard], mine[~hard], d[~hard]
    if not len(v):
        return [np.zeros(n) for n in SIZES]
    first, _, bins, length = _walk(t, v)
    own = mine[first]
    ends = np.r_[length[1:] == 1, True]
    at = np.flatnonzero(ends)
    runs = np.minimum(length[at], N_RUNS)[own[at - length[at] + 1]]
    e = np.clip(np.floor(d / EXC) + N_EXC // 2, 0, N_EXC - 1).astype(int)
    return [np.bincount(x, minlength=n).astype(float) for x, n in ((bins[1:][own[1:]], N_STEPS), (runs, N_RUNS + 1), (e[mine], N_EXC))]


# ---- what is usual: learned from the histograms of all blocks ----------------------------------------------------------


def _middle_step(steps: np.ndarray) -> int:
    """The bin of a source's ordinary step: the median of those that aren't none."""
    n = steps.copy()
    n[0] = 0
    return int(np.searchsorted(np.cumsum(n), n.sum() / 2)) if n.sum() else 0


def _repeat_class(runs: np.ndarray) -> int:
    """How often a number repeats at all, in tenths; the length of stretches doesn't matter to it."""
    return min(9, int(10 * runs[2:].sum() / max(1.0, runs.sum())))


def pool(stats: list[np.ndarray]) -> dict[tuple[str, int], np.ndarray]:
    """A channel's histograms as the pooled fit takes them: steps relative to the ordinary step, repeats by class, excursions."""
    mid = _middle_step(stats[STEP])
    rel = np.zeros(2 * N_STEPS)
    rel[np.arange(1, N_STEPS) - mid + N_STEPS] = stats[STEP][1:]
    return {("step", 0): rel, ("run", _repeat_class(stats[RUN])): stats[RUN], ("exc", 0): stats[EXCURSION]}


def _hazards(runs: np.ndarray, prior: np.ndarray, pull: float) -> np.ndarray:
    """The chance that a repeat of k readings goes on, k from 1."""
    upto = np.cumsum(runs[::-1])[::-1]
    longer = np.r_[upto[2:], 0.0]
    return np.r_[0.0, np.clip((longer + pull * prior[1:]) / (upto[1:] + pull), 1e-4, 0.999)]


def _ages(h: np.ndarray, long: int = 8) -> np.ndarray:
    """A repeat in order that has become long doesn't go on more surely than those of middling length did: what stands still would else pass for order, the surer the more of it there is."""
    return np.r_[h[: long + 1], np.minimum(h[long + 1 :], h[long // 2 + 1 : long + 1].max())]


def fit_runs(runs: np.ndarray, leave: float, passes: int = 60) -> tuple[np.ndarray, np.ndarray, float]:
    """(hazards in order, share of the repeats of each length that stand still, such repeats a reading) of two kinds of repeats, by EM.

    Ordinary ones have a hazard by length, bounded once they are long (_ages); those of a channel that stands still are geometric.
    """
    k = np.arange(len(runs))
    n = max(1.0, (runs * k).sum())
    stuck = np.where(k >= 2, leave * (1 - leave) ** np.maximum(k - 2, 0), 0.0)
    stuck[-1] = (1 - leave) ** (len(runs) - 3)  # the last bin holds all longer ones
    w, rho = np.zeros(len(runs)), 1e-3
    for _ in range(passes):
        o = runs * (1 - w)
        h = _ages(_hazards(o, np.full(len(runs), max(0.5, o[2:].sum() / max(1.0, o.sum()))), 1.0))
        p = np.r_[0.0, np.cumprod(np.r_[1.0, h[1:-1]]) * (1 - h[1:])]
        p[-1] = p[-1] / max(1e-9, 1 - h[-1])
        w = rho * stuck / np.maximum(rho * stuck + (1 - rho) * p, 1e-300)
        rho = float(np.clip((runs * w).sum() / max(1.0, runs.sum()), 1e-6, 0.05))
    return h, w, max(1e-6, float((runs * w).sum() / n))


def _small(rel: np.ndarray, mid: int) -> np.ndarray:
    """Counts of steps in order far below the ordinary one: as many as their width, by the counts between a third and an eighteenth of it."""
    i = np.arange(len(rel)) - mid
    near = (i >= -10) & (i < -4)
    width = 10.0 ** (EIGHTH * i)
    return np.where(i < -4, width * rel[near].sum() / max(width[near].sum(), 1e-300), rel)


def fit_tail(exc: np.ndarray, m: SpikeModel, prior: tuple | None = None, passes: int = 200) -> tuple[np.ndarray, float, float, float]:
    """(weights, scale, middle, width) of three kinds of excursions beyond m.tail, by EM: the tail of ordinary noise, peaks in order, and spikes anywhere up to the bound.

    exc: counts of excursions to one side by size. With a prior only the weights are a source's own, drawn to the pooled ones.
    """
    x = (np.arange(len(exc)) + 0.5) * EXC
    inside = (x > m.tail) & (x < m.bound)
    x, n = x[inside], exc[inside]
    first = np.array([0.4, 0.4, 0.2])
    w, scale, mid, width = prior or (first, 0.05, 0.5, 0.1)
    for _ in range(20 if prior else passes):
        p = w[:, None] * tail_densities(x, scale, mid, width, m)
        p = p / np.maximum(p.sum(0), 1e-300)
        c = (p * n).sum(1)
        if prior:
            w = (c + m.pull * prior[0]) / (c.sum() + m.pull)
            continue
        w = (c + m.pull * first) / (c.sum() + m.pull)
        if c[0] > 20:
            scale = float(np.clip((p[0] * n * (x - m.tail)).sum() / c[0], 0.01, 0.1))
        if c[1] > 20:
            mid = float(np.clip((p[1] * n * x).sum() / c[1], m.tail + 0.1, 0.6))
            width = float(np.clip(np.sqrt((p[1] * n * (x - mid) ** 2).sum() / c[1]), 0.03, 0.15))
    return w, scale, mid, width


def tail_densities(x: np.ndarray, scale: float, mid: float, width: float, m: SpikeModel) -> np.ndarray:
    noise = np.exp(-np.maximum(x - m.tail, 0) / scale) / scale
    return np.stack([noise, np.exp(-0.5 * ((x - mid) / width) ** 2) / (width * np.sqrt(2 * np.pi)), np.full(len(x), 1 / (m.bound - m.tail))])


@dataclass
class Pooled:
    """What all sources share: repeats by class, steps of channels that stand still, excursions up and down, and how often either begins."""

    hazards: np.ndarray
    share: np.ndarray
    steps: np.ndarray
    up: tuple
    down: tuple
    onset: float
    spike: float


def fit_pooled(sums: dict[tuple[str, int], np.ndarray], m: SpikeModel) -> Pooled:
    zero = np.zeros(N_RUNS + 1)
    hazards, share, runs_stuck, readings = np.zeros((10, N_RUNS + 1)), np.zeros((10, N_RUNS + 1)), 0.0, 0.0
    for c in range(10):
        r = sums.get(("run", c), zero)
        n = float((r * np.arange(N_RUNS + 1)).sum())
        hazards[c], share[c], rho = fit_runs(r, m.leave_stuck)
        runs_stuck, readings = runs_stuck + rho * n, readings + n
    rel = sums.get(("step", 0), np.zeros(2 * N_STEPS))
    i = np.arange(2 * N_STEPS) - N_STEPS
    more = np.where(i < -6, np.maximum(rel - _small(rel, N_STEPS), 0), 0.0)
    # a few steps of each size are always possible
    steps = (more + 1 + 9 * (i < -12) * (i > -60)) / (more + 1 + 9 * (i < -12) * (i > -60)).sum()
    e = sums.get(("exc", 0), np.zeros(N_EXC))
    up, down = fit_tail(e[N_EXC // 2 :], m), fit_tail(e[N_EXC // 2 - 1 :: -1], m)
    x = (np.arange(N_EXC // 2) + 0.5) * EXC
    beyond = (x > m.tail) & (x < m.bound)
    spikes = up[0][2] * e[N_EXC // 2 :][beyond].sum() + down[0][2] * e[N_EXC // 2 - 1 :: -1][beyond].sum()
    # stretches with a trace of noise begin about as often as exact ones
    return Pooled(hazards, share, steps, up, down, (2 * runs_stuck + m.onset * m.weight) / (readings + m.weight), (spikes + m.spike * m.weight) / (e.sum() + m.weight))


def fit_source(stats: list[np.ndarray], pooled: Pooled, m: SpikeModel) -> np.ndarray:
    """A channel's emissions in one array: log-odds of standing still by the step's bin, log chances that a repeat of k goes on in order, log-odds of a spike by excursion."""
    steps, runs, exc = stats
    c = _repeat_class(runs)
    h = _hazards(runs * (1 - pooled.share[c]), pooled.hazards[c], m.pull)
    mid, n = _middle_step(steps), max(1.0, steps.sum())
    order = np.maximum(_small(np.r_[0.0, steps[1:]], mid) / n, m.least)
    at = np.arange(N_STEPS) - mid + N_STEPS
    odds = np.log(np.maximum(pooled.steps[np.clip(at, 0, 2 * N_STEPS - 1)], m.least)) - np.log(order) if mid else np.full(N_STEPS, -9.0)
    out, x = np.empty(N_EXC), (np.arange(N_EXC // 2) + 0.5) * EXC
    for side, prior in ((slice(N_EXC // 2, None), pooled.up), (slice(N_EXC // 2 - 1, None, -1), pooled.down)):
        counts = exc[side]
        w, scale, middle, width = fit_tail(counts, m, prior)
        p = tail_densities(x, scale, middle, width, m)
        order_p = (w[0] * p[0] + w[1] * p[1]) * counts[x > m.tail].sum() + m.pull * (prior[0][0] * p[0] + prior[0][1] * p[1]) * 1e-2
        spike_p = w[2] * p[2] * counts[x > m.tail].sum() + m.pull * prior[0][2] * p[2] * 1e-2
        out[side] = np.where(x > m.tail, np.log(np.maximum(spike_p, 1e-300)) - np.log(np.maximum(order_p, 1e-300)), -9.0)
    odds = np.where(at < N_STEPS - 6, odds, -9.0)  # steps near the ordinary one or beyond are no standstill
    return np.concatenate([np.clip(odds, -9, 9), np.log(np.maximum(h, 1e-4)), np.clip(out, -14, 14)])


def judge(t: np.ndarray, v: np.ndarray, profile: np.ndarray, m: SpikeModel, fitted: np.ndarray, pooled: Pooled) -> tuple[np.ndarray, np.ndarray]:
    """The state (0 to 3) of each number and the chance that it is not in order. t (microseconds) ascends; v has no NaN."""
    n = len(v)
    if n == 0:
        return np.empty(0, int), np.empty(0)
    by_step, log_h, by_exc = np.split(fitted, [N_STEPS, N_STEPS + N_RUNS + 1])
    d, hard = excursions(t, v, profile, m)
    x = d / EXC - 0.5 + N_EXC // 2  # between the middles of two bins
    odds = np.interp(x, np.arange(N_EXC), by_exc)
    first, group, bins, length = _walk(t, v)
    before = np.minimum(length - 1, N_RUNS)
    # the log-odds of standing still: an exact repeat by the chance that one of its length goes on in order, else by the step's size
    exact = np.log(np.where(before >= 2, m.again, 0.5)) - log_h[before]
    after_still = np.r_[False, (length[:-1] > 3)]
    inner = np.where(length > 1, exact, by_step[bins] + np.where(after_still, np.log(1 - m.again), np.log(0.5)))
    still = (length > 1) | (by_step[bins] > 0)
    still[0] = False
    c = v[first]
    same = v == c[group]
    stands = still[group] & same
    e = np.ones((1, n, 4))
    # odds already weigh how rare spikes are: an excursion pays for its beginning once, however many readings it lasts
    begins = np.r_[True, np.abs(d[:-1]) <= m.tail]
    e[0, :, SPIKE] = np.exp(np.clip(odds, -14, 14)) / np.where(begins, pooled.spike * 0.4, 0.55)
    row = np.where(first, inner[group], np.where(same, 0.0, -9.0))  # a row sent again brings no evidence of its own
    row += np.maximum(odds, 0.0)  # a standing number may be far off as well
    e[0, :, STUCK] = np.exp(np.clip(row, -20, 20))
    e[0, :, OUT] = 1e-9
    e[0, hard] = np.array([1e-9, 1e-9, 1e-9, 1.0])
    # a row sent again with another number inside a stretch is judged by its own number, not as the stretch's end
    other = ~first & ~same & ~hard
    e[0, other, STUCK] = np.exp(-odds[other]) * 1e-3
    post = forward_backward(e, transitions(pooled.onset, pooled.spike, m.leave_stuck), np.array([0.97, 0.01, 0.01, 0.01]))[0]
    state = post.argmax(1)
    # the first of a stretch is in order, as are numbers that do not stand still
    state = np.where((state == STUCK) & ~stands & ((by_step[bins][group] < -4) | ~same | other), np.where(odds > 0, SPIKE, NORMAL), state)
    stretch = np.cumsum(~still)[group]
    any_stuck = np.zeros(stretch[-1] + 1, bool)
    np.logical_or.at(any_stuck, stretch, state == STUCK)
    state = np.where((state == NORMAL) & stands & any_stuck[stretch], STUCK, state)
    return state, 1 - post[:, NORMAL]


def flag_spikes(df: DataFrame, row_id: str, source: str, time: str, channels: list[str], model: SpikeModel = SpikeModel()) -> DataFrame:
    """One row per stored number of each channel: (row_id, channel, number, state, p_wrong).

    state is ``normal``, ``spike``, ``stuck`` or ``out_of_range``, from the forward-backward probabilities of a hidden Markov model over the
    source's readings in order of time; hard bounds (negative, infinite, or beyond `bound` decades from the source's usual
    load at that time of day) force ``out_of_range``. Null and NaN are no numbers and give no row; rows without source or
    time give none either. The first reading of a stretch that stands still is normal. Rows sent again (same source and time) are judged each by its own
    number. Ties in time are ordered by row_id. Empty input gives an empty result; other columns are ignored.

    What is usual is learned from all rows: each source's load by time of day, the size of its steps, how long its numbers repeat in order, and its
    excursions; what a source shows too seldom is drawn to the pooled counts of all sources (`fit_pooled`, `fit_source`).

    Plan: the usual load is one partial aggregation to (source, slot of day). The readings are cut into blocks of time with a halo on both sides that
    outlasts any stretch, so a source of any size spreads over many tasks, and shuffled to them twice: once for the blocks' histograms, which are added up to one
    small row a source (kept in the checkpoint folder), and once to be judged. The driver gets the pooled histogram, some thousand numbers. Only the rows of the block itself are given out.
    """
    if not channels:
        raise ValueError("no channel")
    n_slots = DAY_US // model.step_us
    size, halo = model.block_days * DAY_US, int(model.halo_days * DAY_US)
    r = df.select(ref(row_id).alias("id"), ref(source).alias("src"), epoch_us(ref(time)).alias("t"), *[number(ref(c)).alias(f"v{i}") for i, c in enumerate(channels)])
    r = r.where(F.col("src").isNotNull() & F.col("t").isNotNull() & F.coalesce(*[f"v{i}" for i in range(len(channels))]).isNotNull())
    slot = F.pmod(floordiv(F.col("t"), model.step_us), F.lit(n_slots)).cast("int")
    prof = r.groupBy("src", slot.alias("slot")).agg(*[F.percentile_approx(F.when(F.col(f"v{i}") > 0, F.col(f"v{i}")), 0.5, 500).alias(f"p{i}") for i in range(len(channels))])
    lists = [F.collect_list(F.coalesce(F.col(c).cast("double"), F.lit(float("nan")))).alias(c) for c in ("slot", *[f"p{i}" for i in range(len(channels))])]
    checkpoint_dir(df.sparkSession)
    prof = prof.groupBy("src").agg(*lists).checkpoint()  # a row a source, read by both passes
    lo, hi = floordiv(F.col("t") - halo, size), floordiv(F.col("t") + halo, size)
    blocks = r.withColumn("block", F.explode(F.sequence(lo, hi)))
    known = r.select("src", floordiv(F.col("t"), size).alias("block")).distinct()

    def beside(sources: DataFrame):
        side = known.join(sources, "src")
        return blocks.groupBy("src", "block").cogroup(side.select(F.col("src").alias("k_src"), F.col("block").alias("k_block"), *sources.columns[1:]).groupBy("k_src", "k_block"))

    def channel_of(key: tuple, rows: pd.DataFrame, usual_rows: pd.DataFrame):
        """The block's rows in order, which are its own, and by channel the rows with a number and the usual load."""
        start = int(key[1]) * size
        rows = rows.sort_values(["t", "id"], kind="stable")
        t = rows["t"].to_numpy(np.int64)
        for i in range(len(channels)):
            v = rows[f"v{i}"].to_numpy(float)
            has = ~np.isnan(v)
            profile = usual(np.asarray(usual_rows["slot"][0]).astype(int), np.asarray(usual_rows[f"p{i}"][0], float), n_slots) if len(usual_rows) else np.full(n_slots, np.nan)
            yield i, rows["id"].to_numpy()[has], t[has], v[has], ((t >= start) & (t < start + size))[has], profile

    def count(key: tuple, rows: pd.DataFrame, usual_rows: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for i, _, t, v, mine, profile in channel_of(key, rows, usual_rows):
            for kind, h in enumerate(statistics(t, v, mine, profile, model) if mine.any() else []):
                bins = np.flatnonzero(h)
                parts.append(pd.DataFrame({"src": [key[0]] * len(bins), "channel": np.int32(i), "kind": np.int32(kind), "bin": bins.astype("int32"), "n": h[bins]}))
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"src": pd.Series(dtype=object), "channel": pd.Series(dtype="int32"), "kind": pd.Series(dtype="int32"), "bin": pd.Series(dtype="int32"), "n": pd.Series(dtype=float)})

    kind_of = df.schema[source].dataType.simpleString()
    counts = beside(prof).applyInPandas(count, f"src {kind_of}, channel int, kind int, bin int, n double").groupBy("src", "channel", "kind", "bin").agg(F.sum("n").alias("n"))
    sums = counts.groupBy("src").agg(F.collect_list(F.struct(*[F.col(c).cast("double").alias(c) for c in ("channel", "kind", "bin", "n")])).alias("counts")).checkpoint()

    def histograms(rows: list) -> list[list[np.ndarray]]:
        out = [[np.zeros(n) for n in SIZES] for _ in channels]
        for x in rows:
            out[int(x["channel"])][int(x["kind"])][int(x["bin"])] = x["n"]
        return out

    def pools(frames):
        for f in frames:
            total: dict[tuple[str, int], np.ndarray] = {}
            for rows in f["counts"]:
                for h in histograms(rows):
                    for k, x in pool(h).items():
                        total[k] = total[k] + x if k in total else x
            rows = [(k, c, i, float(n)) for (k, c), x in total.items() for i, n in enumerate(x) if n]
            yield pd.DataFrame(rows, columns=["kind", "class", "bin", "n"])

    found: dict[tuple[str, int], np.ndarray] = {}
    for x in sums.select("counts").mapInPandas(pools, "kind string, class int, bin int, n double").groupBy("kind", "class", "bin").agg(F.sum("n").alias("n")).collect():
        found.setdefault((x["kind"], x["class"]), np.zeros({"step": 2 * N_STEPS, "run": N_RUNS + 1, "exc": N_EXC}[x["kind"]]))[x["bin"]] = x["n"]
    pooled = fit_pooled(found, model)

    def fit(frames):
        for f in frames:
            yield pd.DataFrame({"src": f["src"], "fitted": [np.concatenate([fit_source(h, pooled, model) for h in histograms(rows)]) for rows in f["counts"]]})

    nothing = fit_source([np.zeros(n) for n in SIZES], pooled, model)
    fitted = sums.mapInPandas(fit, f"src {kind_of}, fitted array<double>")

    def run(key: tuple, rows: pd.DataFrame, usual_rows: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for i, ids, t, v, mine, profile in channel_of(key, rows, usual_rows):
            if mine.any():
                own = usual_rows["fitted"][0]  # none where no number of the source is possible at all
                of = nothing if own is None else np.split(np.asarray(own, float), len(channels))[i]
                state, p = judge(t, v, profile, model, of, pooled)
                parts.append(pd.DataFrame({"id": ids[mine], "channel": np.int32(i), "number": v[mine], "state": state[mine].astype("int32"), "p_wrong": p[mine]}))
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"id": pd.Series(dtype="int64"), "channel": pd.Series(dtype="int32"), "number": pd.Series(dtype=float), "state": pd.Series(dtype="int32"), "p_wrong": pd.Series(dtype=float)})

    got = beside(prof.join(fitted, "src", "left")).applyInPandas(run, f"id {df.schema[row_id].dataType.simpleString()}, channel int, number double, state int, p_wrong double")
    label = F.element_at(F.array(*[F.lit(c) for c in channels]), F.col("channel") + 1)
    return got.select(F.col("id").alias(row_id), label.alias("channel"), "number", F.element_at(F.array(*[F.lit(x) for x in NAMES]), F.col("state") + 1).alias("state"), "p_wrong")
