"""The whole reconstruction as one plan: readings, look-ups, gaps, routing, fills, flags."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmend.operators import anomaly, features, fills, lookups, router, series
from gridmend.operators.router import GAP
from gridmend.operators.series import KEY
from gridmend.sources.tables import checkpoint_dir


@dataclass(frozen=True)
class Config:
    routing: router.Routing = router.Routing()
    mask_anomalies: bool = True


@dataclass
class Reconstruction:
    values: DataFrame  # poste_id, site, slot, value, quality, strategy, effective_strategy, anomaly_replaced
    gaps: DataFrame  # the gaps with strategy and confidence
    corrected: DataFrame | None = None  # stretches of filled cells found implausibly near zero and filled anew, with strategy; None if there were none


@dataclass
class Lookups:
    hour: DataFrame
    day: DataFrame
    weekly: DataFrame
    ratio: DataFrame
    med: DataFrame


def _gaps(r: DataFrame, whole: DataFrame) -> DataFrame:
    """series.gaps of r, and what r lacks at the ends of the series of whole, without the reading beyond."""
    ends = r.groupBy(*KEY).agg(F.min(F.struct("slot", "value")).alias("a"), F.max(F.struct("slot", "value")).alias("b"))
    e = whole.groupBy(*KEY).agg(F.min("slot").alias("lo"), F.max("slot").alias("hi")).join(ends, KEY)
    none = F.lit(None).cast("double")
    left = e.where("lo < a.slot").select(*KEY, F.col("lo").alias("gap_start"), F.col("a.slot").alias("gap_end"), (F.col("a.slot") - F.col("lo")).alias("gap_size"), none.alias("y_l"), F.col("a.value").alias("y_r"))
    right = e.where("hi > b.slot").select(*KEY, (F.col("b.slot") + 1).alias("gap_start"), (F.col("hi") + 1).alias("gap_end"), (F.col("hi") - F.col("b.slot")).alias("gap_size"), F.col("b.value").alias("y_l"), none.alias("y_r"))
    return series.gaps(r).unionByName(left).unionByName(right)


def _routed(g: DataFrame, r: DataFrame, meters: DataFrame, how: router.Routing) -> DataFrame:
    """gaps with their strategy. Chained regression and the smoother never fail; where nearest neighbours can't fill a whole gap, the rules after them decide."""
    g = router.route(router.with_hierarchy(router.classify(g), r, meters), how)
    if how.mice or how.kalman or not how.knn:
        return g
    near = fills.knn(series.pivot(r), g.where("strategy = 'KNN_CONTEXT'")).groupBy(*GAP).agg(F.count("*").alias("got"))
    g = router.route(g.withColumnRenamed("strategy", "first"), replace(how, knn=False)).join(near, GAP, "left")
    whole = (F.col("first") == "KNN_CONTEXT") & (F.coalesce("got", F.lit(0)) == F.col("gap_size"))
    return g.withColumn("strategy", F.when(whole, F.col("first")).otherwise(F.col("strategy"))).drop("first", "got")


def _filled(g: DataFrame, r: DataFrame, look: Lookups, how: router.Routing) -> DataFrame:
    """(poste_id, site, gap_start, slot, strategy, value, by): every missing slot of the gaps; by tells what filled it, the median where the strategy has nothing."""
    elsewhere = F.col("strategy").isin("PEER_CORRELATION", "MICE", "KALMAN_FILTER", "KNN_CONTEXT")
    own = fills.template_gaps(g.where(~elsewhere), r, look.hour, look.day, look.weekly, look.med)

    def of(name: str) -> DataFrame:
        return g.where(F.col("strategy") == name)

    parts = {"PEER": fills.peer(of("PEER_CORRELATION"), r, look.ratio)}
    # the first of these that is on takes all gaps of its rule
    if how.mice:
        # every round reads the stations' wide frame anew
        wide = series.pivot(r.join(of("MICE").select("poste_id").distinct(), "poste_id", "left_semi")).checkpoint()
        parts["MICE"] = fills.mice_gaps(wide, of("MICE"))
    elif how.kalman:
        parts["KALMAN"] = fills.kalman(r, of("KALMAN_FILTER"))
    elif how.knn:
        parts["KNN"] = fills.knn(series.pivot(r), of("KNN_CONTEXT"))
    got = reduce(DataFrame.unionByName, [p.select(*KEY, "slot", "value", F.lit(name).alias("by")) for name, p in parts.items()])
    others = series.points(g.where(elsewhere)).select(*GAP, "slot", "strategy").join(got, [*KEY, "slot"], "left").join(look.med.select(*KEY, "med"), KEY, "left")
    p = own.unionByName(others)
    by = F.when(F.col("value").isNotNull(), F.col("by")).otherwise("SAFE_MEDIAN")
    return p.select(*GAP, "slot", "strategy", F.coalesce("value", "med", F.lit(0.0)).alias("value"), by.alias("by"))


def reconstruct(clean: DataFrame, meters: DataFrame, days: DataFrame, cfg: Config = Config()) -> Reconstruction:
    """Every series on its grid from first to last reading, without an empty cell.

    Implausible readings (standing still, near 0 in occupied or evening hours, beyond 3 deviations) are masked first if asked for, and replaced like missing ones, also at the ends of a
    series; a reading of the input keeps flag 0, also where it was replaced (anomaly_replaced tells). Look-ups are a snapshot of the masked readings. What a strategy leaves empty gets the
    median. Filled cells implausibly near zero are then emptied and routed once more (once only, as the reference does), unchunked and over the filled columns; strategy, quality and effective_strategy are those of that pass.
    """
    cal = features.calendar(days)
    # what every branch below reads is cut from its lineage in the shared checkpoint folder
    checkpoint_dir(clean.sparkSession)
    raw = series.readings(clean)
    r = raw = raw.checkpoint()
    if cfg.mask_anomalies:
        st = anomaly.series_stats(raw).checkpoint()  # a row a series
        found = (anomaly.stuck(raw, stats=st), anomaly.near_zero(features.full_features(raw, cal), stats=st), anomaly.zscores(raw, stats=st))
        bad = reduce(DataFrame.unionByName, [x.select(*KEY, "slot") for x in found]).distinct()
        r = raw.join(bad, [*KEY, "slot"], "left_anti")
    r = r.checkpoint() if cfg.mask_anomalies else raw
    g = router.with_confidence(_routed(_gaps(r, raw), r, meters, cfg.routing), cal).checkpoint()
    f = features.day_flags(features.datetime_features(r), cal)
    # some rows a series each, read by every fill
    look = Lookups(*[x.checkpoint() for x in (lookups.hour_template(f), lookups.day_templates(f), lookups.weekly_templates(f), lookups.peer_ratio(r, meters), fills.medians(r))])
    filled, corrected = _filled(g, r, look, cfg.routing).checkpoint(), None
    low = anomaly.zero_fills(r, filled).checkpoint()
    if not low.isEmpty():
        kept = filled.join(low.select(*KEY, "slot"), [*KEY, "slot"], "left_anti")
        col = r.unionByName(kept.select(*KEY, "slot", "value")).checkpoint()
        of = low.select(*KEY).distinct()
        again = _gaps(col.join(of, KEY, "left_semi"), raw.join(of, KEY, "left_semi"))
        corrected = _routed(again, col, meters, replace(cfg.routing, chunked=False)).checkpoint()
        filled = kept.unionByName(_filled(corrected, col, replace(look, med=fills.medians(col).checkpoint()), cfg.routing))
    none = F.lit(None).cast("string")
    out = r.select(*KEY, "slot", "value", none.alias("strategy"), F.lit("READ").alias("by")).unionByName(filled.select(*KEY, "slot", "value", "strategy", "by"))
    out = out.join(raw.select(*KEY, "slot", F.lit(True).alias("was_read")), [*KEY, "slot"], "left")
    read = F.coalesce("was_read", F.lit(False))
    out = out.select(
        *KEY, "slot", F.round("value", 3).alias("value"), F.when(read, 0).otherwise(router.by_strategy(1, F.col("strategy"))).alias("quality"), "strategy",
        F.col("by").alias("effective_strategy"), (read & (F.col("by") != "READ")).alias("anomaly_replaced"),
    )
    return Reconstruction(out, g, corrected)
