"""Fill strategies. Each takes gaps and look-ups and gives (poste_id, site, gap_start, slot, value), one row per missing slot.

Statistics are those of the readings before any fill (a snapshot), so the order of gaps doesn't matter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmend.functions.cols import floordiv
from gridmend.operators.features import datetime_features
from gridmend.operators.router import GAP
from gridmend.operators.series import KEY, SITES, long, median, points

OUT = [*GAP, "slot"]


def _linear() -> Column:
    return F.col("y_l") + (F.col("y_r") - F.col("y_l")) * F.col("k") / (F.col("gap_size") + 1)


def linear(g: DataFrame) -> DataFrame:
    return points(g).select(*OUT, _linear().alias("value"))


def medians(r: DataFrame) -> DataFrame:
    return r.groupBy(*KEY).agg(median("value").alias("med"), F.max("value").alias("top"))


def safe_median(g: DataFrame, r: DataFrame) -> DataFrame:
    return points(g).join(medians(r), KEY, "left").select(*OUT, F.coalesce("med", F.lit(0.0)).alias("value"))


def safe_linear_median(g: DataFrame, r: DataFrame) -> DataFrame:
    return points(g).join(medians(r), KEY).select(*OUT, (0.9 * _linear() + 0.1 * F.col("med")).alias("value"))


def clip(v: Column, med: Column, top: Column) -> Column:
    """A null becomes the median; the rest lies in [0, 1.5 * top]; without readings 0."""
    return F.when(top.isNull(), F.coalesce(v, F.lit(0.0))).otherwise(F.greatest(F.lit(0.0), F.least(F.coalesce(v, med), 1.5 * top)))


def clipped(fill: DataFrame, r: DataFrame) -> DataFrame:
    return fill.join(medians(r), KEY, "left").select(*OUT, clip(F.col("value"), F.col("med"), F.col("top")).alias("value"))


def shifts(g: DataFrame, p: DataFrame, r: DataFrame, tpl: DataFrame, tpl_keys: list[str], width: int = 6) -> DataFrame:
    """(poste_id, site, gap_start, sl, sr): by how much a fill p (points of g with its number f) is to be shifted on either side of its gap.

    tpl: (poste_id, site, tpl_keys, tpl), tpl_keys among hour, day_of_week and columns of g. On each side the shift is the median of reading - template over the `width`
    slots outside, or the reading beside the gap less the median of the first `width` filled numbers, whichever is smaller (the latter on ties);
    a side without any takes the other's. Only equi-joins: the slots outside are generated from the gaps.
    """
    side = F.explode(F.array(F.lit("l"), F.lit("r"))).alias("side")
    o = g.select(*GAP, "gap_end", *[k for k in tpl_keys if k in g.columns], side).withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(width))))
    o = o.withColumn("slot", F.when(F.col("side") == "l", F.col("gap_start") - F.col("i")).otherwise(F.col("gap_end") + F.col("i") - 1))
    o = datetime_features(o.join(r, [*KEY, "slot"])).join(tpl, [*KEY, *tpl_keys])
    o = o.groupBy(*GAP).agg(*[median(F.when(F.col("side") == s, F.col("value") - F.col("tpl"))).alias(f"out_{s}") for s in "lr"])
    edge = p.where((F.col("k") <= width) | (F.col("k") > F.col("gap_size") - width))
    inside = edge.groupBy(*GAP).agg(median(F.when(F.col("k") <= width, F.col("f"))).alias("m_l"), median(F.when(F.col("k") > F.col("gap_size") - width, F.col("f"))).alias("m_r"))

    def shift(s: str) -> Column:
        out, ins = F.col(f"out_{s}"), F.col(f"y_{s}") - F.col(f"m_{s}")
        return F.when(out.isNull() | ins.isNull(), F.coalesce(out, ins)).when(F.abs(out) < F.abs(ins), out).otherwise(ins)

    e = g.join(o, GAP, "left").join(inside, GAP, "left").select(*GAP, shift("l").alias("sl"), shift("r").alias("sr"))
    return e.select(*GAP, F.coalesce("sl", "sr").alias("sl"), F.coalesce("sr", "sl").alias("sr"))


def anchor() -> Column:
    """The number f of a point, shifted by sl and sr, which fade inwards, and drawn to the straight line at the ends."""
    tau = F.greatest(F.lit(6.0), F.least(F.lit(36.0), F.col("gap_size") / 12.0))
    wl, wr = F.exp(-(F.col("k") - 1) / tau), F.exp(-(F.col("gap_size") - F.col("k")) / tau)
    a = F.when(F.col("sl").isNull(), F.col("f")).otherwise(F.col("f") + wl * F.col("sl") + wr * F.col("sr"))
    w = F.greatest(wl, wr)
    return F.when(F.col("y_l").isNotNull() & F.col("y_r").isNotNull() & F.col("sl").isNotNull(), w * _linear() + (1 - w) * a).otherwise(a)


def anchored(g: DataFrame, fill: DataFrame, r: DataFrame, tpl: DataFrame, tpl_keys: list[str], width: int = 6) -> DataFrame:
    """fill shifted to meet the readings on both sides of its gap, the shift fading inwards (shifts, anchor)."""
    p = points(g).join(fill.select(*OUT, F.col("value").alias("f")), OUT)
    return p.join(shifts(g, p, r, tpl, tpl_keys, width), GAP).select(*OUT, anchor().alias("value"))


def template_gaps(g: DataFrame, r: DataFrame, hour_tpl: DataFrame, day_tpl: DataFrame, weekly: DataFrame, med: DataFrame) -> DataFrame:
    """(poste_id, site, gap_start, slot, strategy, value, by) of all gaps that need only their own series: linear, linear with median, and the templates, in one pass over their points.

    The same numbers as linear, safe_linear_median, thermal, weekend and multi_week give one by one; value is null where a strategy has nothing. med: medians of r.
    """
    s = F.col("strategy")
    kind = F.when(s.isin("THERMAL_TEMPLATE", "ENHANCED_TEMPLATE"), "hour").when(s == "MULTI_WEEK_TEMPLATE", "week").when(s == "WEEKEND_TEMPLATE_SATURDAY", "saturday").when(s == "WEEKEND_TEMPLATE_SUNDAY", "sunday")
    g = g.select(*GAP, "gap_end", "gap_size", "y_l", "y_r", "strategy", kind.alias("kind"))
    # one template for all kinds: those that don't tell days apart stand for each
    every = F.explode(F.array(*[F.lit(d) for d in ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")])).alias("day_of_week")
    t = hour_tpl.select(*KEY, F.lit("hour").alias("kind"), every, "hour", "tpl").unionByName(day_tpl.where("day_type <> 'holiday'").select(*KEY, F.col("day_type").alias("kind"), every, "hour", "tpl"))
    t = t.unionByName(weekly.select(*KEY, F.lit("week").alias("kind"), "day_of_week", "hour", "tpl"))
    keys = ["kind", "day_of_week", "hour"]
    p = datetime_features(points(g)).join(t, [*KEY, *keys], "left").join(hour_tpl.select(*KEY, "hour", F.col("tpl").alias("of_hour")), [*KEY, "hour"], "left")
    p = p.withColumn("f", F.coalesce("tpl", F.when(F.col("kind") == "week", F.col("of_hour")))).repartition(*GAP)
    of = g.where("kind is not null")
    x = p.join(shifts(of, p.where("f is not null"), r, t, keys), GAP, "left").join(med, KEY, "left")
    linear_kind, weekend_kind = s.isin("LINEAR_MICRO", "LINEAR_SHORT"), s.startswith("WEEKEND")
    v = F.when(linear_kind, _linear()).when(s == "SAFE_LINEAR_MEDIAN", 0.9 * _linear() + 0.1 * F.col("med")).when(F.col("f").isNotNull(), clip(anchor(), F.col("med"), F.col("top")))
    v = F.when(weekend_kind, F.coalesce(v, "med", F.lit(0.0))).otherwise(v)
    by = F.when(linear_kind, "LINEAR").when(weekend_kind, "WEEKEND").when(s == "MULTI_WEEK_TEMPLATE", "MULTI_WEEK").when(s == "SAFE_LINEAR_MEDIAN", s).otherwise("TEMPLATE")
    return x.select(*OUT, "strategy", v.alias("value"), by.alias("by"), "med")


def template_fill(g: DataFrame, tpl: DataFrame, keys: list[str]) -> DataFrame:
    """The template's number of each missing slot; slots without one are left out."""
    return datetime_features(points(g)).join(tpl.select(*KEY, *keys, "tpl"), [*KEY, *keys]).select(*OUT, F.col("tpl").alias("value"))


def thermal(g: DataFrame, r: DataFrame, hour_tpl: DataFrame) -> DataFrame:
    """The median by hour, anchored and clipped; the enhanced template is the same."""
    return clipped(anchored(g, template_fill(g, hour_tpl, ["hour"]), r, hour_tpl, ["hour"]), r)


def weekend(g: DataFrame, r: DataFrame, day_tpl: DataFrame) -> DataFrame:
    """Gaps that are purely Saturday or Sunday (g classified): that day's median by hour, anchored and clipped; mixed ones and missing templates the median."""
    of, keys = g.where(F.col("day_type").isin("saturday", "sunday")), ["day_type", "hour"]
    got = clipped(anchored(of, template_fill(of, day_tpl, keys), r, day_tpl, keys), r)
    p = points(g.where("day_type is not null")).join(got.withColumnRenamed("value", "got"), OUT, "left").join(medians(r).select(*KEY, "med"), KEY, "left")
    return p.select(*OUT, F.coalesce("got", "med", F.lit(0.0)).alias("value"))


def multi_week(g: DataFrame, r: DataFrame, weekly: DataFrame, hour_tpl: DataFrame) -> DataFrame:
    """The weekly template's number, else the median of the hour; anchored, clipped, with each slot's confidence (0.5 for the median)."""
    p = datetime_features(points(g)).join(weekly.select(*KEY, "day_of_week", "hour", F.col("tpl").alias("wt"), "std"), [*KEY, "day_of_week", "hour"], "left")
    p = p.join(hour_tpl.withColumnRenamed("tpl", "ht"), [*KEY, "hour"], "left")
    c = F.when(F.col("wt").isNotNull(), F.when(F.col("std") == 0, 1.0).otherwise(1 / (1 + F.col("std") / (F.col("wt") + 1e-6)))).when(F.col("ht").isNotNull(), 0.5).otherwise(0.0)
    p = p.select(*OUT, F.coalesce("wt", "ht").alias("value"), c.alias("point_confidence"))
    w = weekly.select(*KEY, "day_of_week", "hour", "tpl")
    return clipped(anchored(g, p.where("value is not null").select(*OUT, "value"), r, w, ["day_of_week", "hour"]), r).join(p.select(*OUT, "point_confidence"), OUT)


def peer(g: DataFrame, r: DataFrame, ratios: DataFrame) -> DataFrame:
    """Gaps of sub-meters (g with hierarchy): the parent's number times the ratio, else the median; clipped."""
    p = points(g.where("tier = 'sub' and parent is not null")).join(r.select("poste_id", F.col("site").alias("parent"), "slot", F.col("value").alias("pv")), ["poste_id", "parent", "slot"], "left")
    return clipped(p.join(ratios.select(*KEY, "ratio"), KEY).select(*OUT, (F.col("pv") * F.col("ratio")).alias("value")), r)


def mean_fill(g: DataFrame, r: DataFrame) -> DataFrame:
    """Chained regression with a single column: its mean."""
    return points(g).join(r.groupBy(*KEY).agg(F.round(F.avg("value"), 3).alias("value")), KEY).select(*OUT, "value")


def zero(g: DataFrame) -> DataFrame:
    return points(g).select(*OUT, F.lit(0.0).alias("value"))


def prior_week(g: DataFrame, r: DataFrame) -> DataFrame:
    """The reading of the same slot a week before; null where there is none."""
    w = r.select(*KEY, (F.col("slot") + 1008).alias("slot"), "value")
    return points(g).join(w, [*KEY, "slot"], "left").select(*OUT, "value")


def smoother_gains(n: int) -> tuple[list[float], list[float]]:
    """Of a random walk's smoother with all variances 1 the filter's gain at each of n cells and the share by which a cell follows the one after it; they don't depend on the readings."""
    gain, back, p = [], [], None
    for _ in range(n + 1):
        ahead = 1.0 if p is None else p + 1
        if p is not None:
            back.append(p / ahead)
        k = ahead / (ahead + 1)
        p = (1 - k) * ahead
        gain.append(k)
    return gain, back


def smooth_cells(y: list[float]) -> list[float]:
    gain, back = smoother_gains(len(y))
    out, f = [], 0.0
    for v, k in zip(y, gain):
        f += k * (v - f)
        out.append(f)
    for i in range(len(y) - 2, -1, -1):
        out[i] += back[i] * (out[i + 1] - out[i])
    return out


def kalman(r: DataFrame, g: DataFrame, block: int = 1008, halo: int = 64) -> DataFrame:
    """Random-walk smoother (all variances 1, start 0) over a series in which empty cells count as 0; its numbers at the empty cells.

    A cell's smoothed number depends on cells d away by less than 0.4**d, so blocks with a halo of 64 cells on each side give the same double as
    the whole series, and no task holds a series.
    """
    cells = r.select(*KEY, "slot", "value", F.lit(None).cast("bigint").alias("gap_start")).unionByName(points(g).select(*KEY, "slot", F.lit(None).cast("double").alias("value"), "gap_start"))
    first = r.groupBy(*KEY).agg(F.min("slot").alias("first_slot"))
    x = cells.join(first, KEY).withColumn("block", F.explode(F.sequence(floordiv(F.col("slot") - halo, block), floordiv(F.col("slot") + halo, block))))

    def smooth(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("slot")
        # before a block's first cell the filter has long forgotten its start
        m = np.array(smooth_cells(rows["value"].fillna(0.0).tolist()))
        lo = int(key[2]) * block
        keep = (rows["value"].isna() & (rows["slot"] >= lo) & (rows["slot"] < lo + block)).to_numpy()
        out = rows.loc[keep, ["poste_id", "site", "gap_start", "slot"]].copy()
        out["gap_start"] = out["gap_start"].astype("int64")
        out["value"] = m[keep]
        return out

    return x.groupBy(*KEY, "block").applyInPandas(smooth, "poste_id int, site string, gap_start bigint, slot bigint, value double")


def knn(w: DataFrame, g: DataFrame, sites: tuple[str, ...] = SITES, k: int = 5, block: int = 4096, queries: int = 2048) -> DataFrame:
    """The mean over the k rows of the same station that are nearest in the other sites (earlier slot on ties), for empty cells whose other sites all have numbers.

    The empty cells are the query set. Rows and queries of a station are cut in blocks; a task meets one block of either and keeps each query's k best, so
    no pair leaves a task, and a last pass merges k candidates a block. Series with fewer than k complete rows give nothing.
    """
    outs = []
    for target in sites:
        others = [s for s in sites if s != target]
        full = w.where(" and ".join(f"{c} is not null" for c in others)).select("poste_id", "slot", *[F.col(c).alias(f"x{i}") for i, c in enumerate(others)], F.col(target).alias("y"))
        xs = [f"x{i}" for i in range(len(others))]
        rows = full.where("y is not null").withColumn("rb", F.pmod(F.xxhash64("slot"), F.lit(16)).cast("int"))
        holes = points(g.where(F.col("site") == target)).select(F.col("poste_id").alias("qp"), "gap_start", F.col("slot").alias("qs"))
        ask = holes.join(full.where("y is null").select(F.col("poste_id").alias("qp"), F.col("slot").alias("qs"), *[F.col(c).alias(f"z{c}") for c in xs]), ["qp", "qs"]).withColumn("rb2", F.explode(F.sequence(F.lit(0), F.lit(15))))

        def nearest(key: tuple, a: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
            xs = [c for c in a.columns if c[0] == "x"]
            out = {"poste_id": [], "gap_start": [], "slot": [], "d": [], "s": [], "y": []}
            if len(a) and len(q):
                a = a.sort_values("slot")
                x, y, s = a[xs].to_numpy(float), a["y"].to_numpy(float), a["slot"].to_numpy(np.int64)
                for at in range(0, len(q), queries):
                    part = q.iloc[at : at + queries]
                    z, m = part[[f"z{c}" for c in xs]].to_numpy(float), min(k, len(x))
                    best_d, best_i = np.full((len(z), 0), np.inf), np.empty((len(z), 0), np.int64)
                    for b in range(0, len(x), block):
                        d = ((z[:, None, :] - x[None, b : b + block, :]) ** 2).sum(2)
                        d, i = np.concatenate([best_d, d], 1), np.concatenate([best_i, np.broadcast_to(np.arange(b, min(b + block, len(x))), d.shape)], 1)
                        order = np.argsort(d, 1, kind="stable")[:, :m]
                        best_d, best_i = np.take_along_axis(d, order, 1), np.take_along_axis(i, order, 1)
                    n = best_d.shape[1]
                    out["poste_id"] += [int(key[0])] * (len(z) * n)
                    out["gap_start"] += np.repeat(part["gap_start"].to_numpy(np.int64), n).tolist()
                    out["slot"] += np.repeat(part["qs"].to_numpy(np.int64), n).tolist()
                    out["d"] += best_d.ravel().tolist()
                    out["s"] += s[best_i.ravel()].tolist()
                    out["y"] += y[best_i.ravel()].tolist()
            return pd.DataFrame(out)

        near = rows.groupBy("poste_id", "rb").cogroup(ask.groupBy("qp", "rb2")).applyInPandas(nearest, "poste_id int, gap_start bigint, slot bigint, d double, s bigint, y double")
        top = near.groupBy("poste_id", "gap_start", "slot").agg(F.slice(F.sort_array(F.collect_list(F.struct("d", "s", "y"))), 1, k).alias("n")).where(F.size("n") == k)
        mean = F.aggregate("n", F.lit(0.0), lambda acc, v: acc + v["y"]) / k
        outs.append(top.select("poste_id", F.lit(target).alias("site"), "gap_start", "slot", F.round(mean, 3).alias("value")))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


def mice(w: DataFrame, sites: tuple[str, ...] = SITES, rounds: int = 3, ridge: float = 1e-3, missing_only: bool = False) -> DataFrame:
    """wide with the empty cells of each site filled by chained ridge regressions on the other sites of the station.

    A round needs one partial aggregation to a station's sums of products (some dozen numbers a station); the regressions are solved from those, a station a row, and joined back. All
    sites of a round start from the round before. A station without any number in a site keeps it empty; only slots of the wide frame are filled (mice_gaps fills the others).
    missing_only: null where a number was read. What is joined back is a row a station and broadcast, so the readings are not shuffled again.
    """
    scale = w.groupBy("poste_id").agg(*[F.avg(c).alias(f"m_{c}") for c in sites], *[F.coalesce(F.stddev_pop(c), F.lit(0.0)).alias(f"d_{c}") for c in sites])
    x = w.join(F.broadcast(scale), "poste_id")
    z = {c: F.when(F.col(f"d_{c}") > 0, (F.col(c) - F.col(f"m_{c}")) / F.col(f"d_{c}")).when(F.col(c).isNotNull(), F.lit(0.0)) for c in sites}
    x = x.withColumns({f"z_{c}": z[c] for c in sites})
    x = x.withColumns({f"f_{c}": F.coalesce(F.col(f"z_{c}"), F.lit(0.0)) for c in sites})
    n = len(sites)

    def solve(s: pd.Series, t: int) -> list[float]:
        others = [i for i in range(n) if i != t]
        a = np.array([[s[f"p{t}_{min(i, j)}_{max(i, j)}"] for j in others] for i in others]) + ridge * (1 + s[f"c{t}"]) * np.eye(n - 1)
        b = np.array([s[f"q{t}_{i}"] for i in others])
        out = np.zeros(n)
        out[others] = np.linalg.solve(a, b)
        return out.tolist()

    def fit(batches):
        for b in batches:
            yield pd.DataFrame({"poste_id": b["poste_id"], **{f"w{t}": [solve(r, t) for _, r in b.iterrows()] for t in range(n)}})

    for _ in range(rounds):
        aggs = []
        for t, c in enumerate(sites):
            has = F.col(f"z_{c}").isNotNull()
            aggs.append(F.count(F.when(has, 1)).alias(f"c{t}"))
            for i in range(n):
                if i != t:
                    aggs.append(F.coalesce(F.sum(F.when(has, F.col(f"f_{sites[i]}") * F.col(f"z_{c}"))), F.lit(0.0)).alias(f"q{t}_{i}"))
                    aggs += [F.coalesce(F.sum(F.when(has, F.col(f"f_{sites[i]}") * F.col(f"f_{sites[j]}"))), F.lit(0.0)).alias(f"p{t}_{i}_{j}") for j in range(i, n) if j != t]
        coef = x.groupBy("poste_id").agg(*aggs).mapInPandas(fit, "poste_id int, " + ", ".join(f"w{t} array<double>" for t in range(n)))
        x = x.join(F.broadcast(coef), "poste_id")
        new = {f"f_{c}": F.coalesce(F.col(f"z_{c}"), sum((F.col(f"f_{sites[i]}") * F.col(f"w{t}")[i] for i in range(n) if i != t), F.lit(0.0))) for t, c in enumerate(sites)}
        x = x.withColumns(new).drop(*[f"w{t}" for t in range(n)])
    made = {c: F.col(f"f_{c}") * F.col(f"d_{c}") + F.col(f"m_{c}") for c in sites}
    return x.select("poste_id", "slot", *[(F.when(F.col(c).isNull(), made[c]) if missing_only else F.coalesce(F.col(c), made[c])).alias(c) for c in sites])


def mice_gaps(w: DataFrame, g: DataFrame, sites: tuple[str, ...] = SITES) -> DataFrame:
    """Chained regression on the regular grid: a number for every missing slot, also for those of which wide has no row.

    A slot without a number in any other site adds nothing to a regression, and all its terms but the mean are 0; so it takes the mean without being in the frame.
    """
    done = mice(w, sites, missing_only=True).unpivot(["poste_id", "slot"], list(sites), "site", "got").where("got is not null")
    mean = long(w, sites).groupBy(*KEY).agg(F.avg("value").alias("mean"))
    return points(g).select(*OUT).join(done, [*KEY, "slot"], "left").join(mean, KEY).select(*OUT, F.round(F.coalesce("got", "mean"), 3).alias("value"))


def savgol(r: DataFrame, width: int = 21, degree: int = 3) -> DataFrame:
    """(poste_id, site, slot, value, smooth): least-squares polynomial smoothing where all `width` slots around have readings."""
    h = width // 2
    coef = np.linalg.pinv(np.vander(np.arange(-h, h + 1), degree + 1, increasing=True))[0]
    x = r.withColumn("i", F.explode(F.sequence(F.lit(-h), F.lit(h))))
    weight = F.element_at(F.array(*[F.lit(float(c)) for c in coef]), h + 1 - F.col("i"))
    s = x.groupBy(*KEY, (F.col("slot") + F.col("i")).alias("slot")).agg(F.sum(F.col("value") * weight).alias("smooth"), F.count("*").alias("n"), F.max(F.when(F.col("i") == 0, F.col("value"))).alias("value"))
    return s.where(F.col("n") == width).select(*KEY, "slot", "value", "smooth")
