"""Detectors of implausible readings that the reconstruction masks before it builds its look-ups."""

from __future__ import annotations

import json
import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmend.functions.cols import floordiv
from gridmend.operators.blocks import carry
from gridmend.operators.series import BLOCK, KEY, median, neighbours
from gridmend.sources.tables import checkpoint_dir


def series_stats(r: DataFrame) -> DataFrame:
    """(poste_id, site, n, median, std): std of the sample, rounded as the median is."""
    return r.groupBy(*KEY).agg(F.count("*").alias("n"), median("value").alias("median"), F.round(F.stddev_samp("value"), 6).alias("std"))


def checked(r: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Readings of series with at least 30 of them and a median that isn't 0, with the series' statistics (series_stats of r, or those given)."""
    return r.join((stats if stats is not None else series_stats(r)).where("n >= 30 and median <> 0"), KEY)


def runs(r: DataFrame, stats: DataFrame, share: float = 1e-4, block: int = BLOCK) -> DataFrame:
    """Readings with run_start: the slot at which the stretch began in which each reading is within share of the median of the one before.

    The start travels across blocks through the carried block ends, so a stretch may be of any length.
    """
    x = neighbours(r).join(stats.select(*KEY, "median"), KEY)
    new = F.col("prev").isNull() | (F.abs(F.col("value") - F.col("prev.value")) > F.abs(F.col("median")) * share)
    x = x.select(*KEY, "slot", "value", floordiv(F.col("slot"), block).alias("block"), F.when(new, F.col("slot")).alias("start"))
    ends = x.groupBy(*KEY, "block").agg(F.min("start").alias("first"), F.max("start").alias("last"))
    w = Window.partitionBy(*KEY, "block").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    x = x.join(carry(ends, KEY, "block", "first", "last"), [*KEY, "block"])
    return x.select(*KEY, "slot", "value", F.coalesce(F.max("start").over(w), "before").alias("run_start"))


def stuck(r: DataFrame, least: int = 18, stats: DataFrame | None = None) -> DataFrame:
    """Readings of stretches of at least `least` readings that stand still, but for the first of each."""
    stats = stats if stats is not None else series_stats(r)
    # a run's first reading is known from the others: most readings begin a run of their own and need not be grouped
    x = runs(checked(r, stats).select(*KEY, "slot", "value"), stats).where("slot > run_start")
    long_runs = x.groupBy(*KEY, "run_start").agg((F.count("*") + 1).alias("run_length")).where(F.col("run_length") >= least)
    return x.join(long_runs, [*KEY, "run_start"]).select(*KEY, "slot", "value", "run_start", "run_length")


def near_zero(featured: DataFrame, share: float = 0.01, stats: DataFrame | None = None) -> DataFrame:
    """Readings of occupied or evening hours at or below share of the median; featured has occupancy_type."""
    return checked(featured, stats).where(F.col("occupancy_type").isin("work_hours", "evening") & (F.col("value") <= F.col("median") * share))


def zscores(r: DataFrame, beyond: float = 3.0, stats: DataFrame | None = None) -> DataFrame:
    """Readings more than `beyond` sample deviations from the median."""
    z = F.round((F.col("value") - F.col("median")) / (F.col("std") + 1e-9), 6)
    return checked(r, stats).withColumn("z", z).where(F.abs("z") > beyond).select(*KEY, "slot", "value", "z")


def zero_fills(r: DataFrame, fill: DataFrame, share: float = 0.01, beyond: float = 3.0, least: int = 20) -> DataFrame:
    """Filled cells at or below share of the filled column's median and more than `beyond` deviations below it, to be filled anew."""
    col = r.select(*KEY, "slot", "value", F.lit(None).cast("bigint").alias("gap_start")).unionByName(fill.select(*KEY, "slot", "value", "gap_start"))
    st = col.groupBy(*KEY).agg(F.count("*").alias("n"), F.percentile("value", F.lit(0.5)).alias("med"), F.stddev_samp("value").alias("sd")).where(F.col("n") >= least)
    low = (F.col("value") <= share * F.col("med")) & ((F.col("value") - F.col("med")) / (F.col("sd") + 1e-9) < -beyond)
    return fill.join(st, KEY).where(low).select(*KEY, "gap_start", "slot", "value")


def flagged_runs(flags: DataFrame) -> DataFrame:
    """Flagged readings (poste_id, site, slot, value, reason) merged into runs of consecutive slots.

    (poste_id, site, run_start, run_end, n_slots, reasons): run_end is the last slot; reasons in order, joined by ', '.
    """
    # read three times below, and few rows: the detectors' plans are cut off in the shared checkpoint folder
    checkpoint_dir(flags.sparkSession)
    one = flags.groupBy(*KEY, "slot").agg(F.sort_array(F.collect_set("reason")).alias("reasons")).checkpoint()
    n = neighbours(one.select(*KEY, "slot", F.lit(0.0).alias("value")))
    x = n.join(one, [*KEY, "slot"]).select(*KEY, "slot", "reasons", floordiv(F.col("slot"), BLOCK).alias("block"), F.when(F.coalesce(F.col("prev.slot") < F.col("slot") - 1, F.lit(True)), F.col("slot")).alias("start"))
    ends = x.groupBy(*KEY, "block").agg(F.min("start").alias("first"), F.max("start").alias("last"))
    w = Window.partitionBy(*KEY, "block").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    x = x.join(carry(ends, KEY, "block", "first", "last"), [*KEY, "block"]).withColumn("run_start", F.coalesce(F.max("start").over(w), "before"))
    g = x.groupBy(*KEY, "run_start").agg(F.max("slot").alias("run_end"), F.count("*").alias("n_slots"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("reasons")))).alias("reasons"))
    return g.withColumn("reasons", F.array_join("reasons", ", "))


def _grow(rows: list[tuple], rng: random.Random, depth: int) -> list | int:
    """A tree as nested lists [feature, cut, left, right], or the size of a leaf."""
    n = len(rows)
    if n <= 1 or depth == 0:
        return n
    spans = [(f, min(r[f] for r in rows), max(r[f] for r in rows)) for f in range(len(rows[0]))]
    spans = [x for x in spans if x[2] > x[1]]
    if not spans:
        return n
    f, lo, hi = spans[rng.randrange(len(spans))]
    cut = rng.uniform(lo, hi)
    return [f, cut, _grow([r for r in rows if r[f] < cut], rng, depth - 1), _grow([r for r in rows if r[f] >= cut], rng, depth - 1)]


def grow_forest(rows: list[tuple], trees: int = 100, sample: int = 256, seed: int = 42) -> tuple[int, list]:
    """(rows a tree has seen, trees)."""
    rng, size = random.Random(seed), min(sample, len(rows))
    return size, [_grow(rng.sample(rows, size), rng, math.ceil(math.log2(max(size, 2)))) for _ in range(trees)]


def _depth(n: float) -> float:
    """Mean length of an unsuccessful search among n."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def _lengths(tree: list | int, x: np.ndarray, depth: int, out: np.ndarray, at: np.ndarray) -> None:
    if not len(at):
        return
    if not isinstance(tree, list):
        out[at] += depth + _depth(tree)
        return
    left = x[at, tree[0]] < tree[1]
    _lengths(tree[2], x, depth + 1, out, at[left])
    _lengths(tree[3], x, depth + 1, out, at[~left])


def forest_scores(forest: tuple[int, list], x: np.ndarray) -> np.ndarray:
    """Isolation scores of x (greater: easier to isolate)."""
    size, trees = forest
    total = np.zeros(len(x))
    for tree in trees:
        _lengths(tree, x, 0, total, np.arange(len(x)))
    return 2.0 ** (-total / max(1, len(trees)) / max(_depth(size), 1e-9))


def isolation_forest(featured: DataFrame, contamination: float = 0.05, sample: int = 4096, block: int = 8 * BLOCK) -> DataFrame:
    """(poste_id, site, slot, value, score): the share `contamination` of each series' readings that a forest over (value, hour) isolates soonest.

    Each series' forest is grown once, on about `sample` of its readings (those whose slots hash least; a documented bound); all readings are scored, in
    blocks, and the cut is an approximate percentile, so that no task holds a series.
    """
    x = checked(featured).select(*KEY, "slot", "value", F.col("hour").cast("double").alias("hour"), "n")
    small = x.where(F.pmod(F.xxhash64("slot"), F.lit(1 << 20)) < F.lit(float(sample << 20)) / F.col("n")).drop("n")

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("slot")
        forest = grow_forest(list(zip(rows["value"].tolist(), rows["hour"].tolist())))
        return pd.DataFrame({"mp": [rows["poste_id"].iloc[0]], "ms": [rows["site"].iloc[0]], "forest": [json.dumps(forest)]})

    forests = small.groupBy(*KEY).applyInPandas(grow, "mp int, ms string, forest string")
    rows = x.withColumn("block", floordiv(F.col("slot"), block))
    spread = rows.select(F.col("poste_id").alias("mp"), F.col("site").alias("ms"), F.col("block").alias("mb")).distinct().join(forests, ["mp", "ms"])

    def score(a: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        a = a[["poste_id", "site", "slot", "value", "hour"]]
        if m.empty or a.empty:
            return a.iloc[:0].rename(columns={"hour": "score"})
        return a.assign(hour=forest_scores(json.loads(m["forest"].iloc[0]), a[["value", "hour"]].to_numpy(float))).rename(columns={"hour": "score"})

    got = rows.groupBy(*KEY, "block").cogroup(spread.groupBy("mp", "ms", "mb")).applyInPandas(score, "poste_id int, site string, slot bigint, value double, score double")
    cut = got.groupBy(*KEY).agg(F.percentile_approx("score", 1 - contamination, 1000).alias("cut"))
    return got.join(cut, KEY).where("score > cut").select(*KEY, "slot", "value", "score")
