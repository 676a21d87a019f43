"""Statistics that the fills look up: templates, peer ratios, correlations, bounds."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmend.operators.series import DAY, KEY, SITES, median


def null_counts(r: DataFrame) -> DataFrame:
    """Per series the first and last slot, readings, cells of the grid and empty ones."""
    s = r.groupBy(*KEY).agg(F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"), F.count("*").alias("n_readings"))
    s = s.withColumn("n_cells", F.col("last_slot") - F.col("first_slot") + 1)
    return s.withColumn("n_null", F.col("n_cells") - F.col("n_readings"))


def hour_template(featured: DataFrame) -> DataFrame:
    """(poste_id, site, hour, tpl): median by hour of the day."""
    return featured.groupBy(*KEY, "hour").agg(median("value").alias("tpl"))


def day_templates(featured: DataFrame) -> DataFrame:
    """(poste_id, site, day_type, hour, tpl) for saturdays, sundays and holidays; a holiday on a weekend counts for both."""
    kinds = F.array_compact(F.array(F.when(F.col("day_of_week") == "Saturday", "saturday"), F.when(F.col("day_of_week") == "Sunday", "sunday"), F.when(F.col("is_holiday"), "holiday")))
    return featured.withColumn("day_type", F.explode(kinds)).groupBy(*KEY, "day_type", "hour").agg(median("value").alias("tpl"))


def seasonal_templates(featured: DataFrame) -> DataFrame:
    return featured.groupBy(*KEY, "season", "hour").agg(median("value").alias("tpl"))


def weekly_templates(featured: DataFrame, lookback: int = 28, bias: float = 0.7) -> DataFrame:
    """(poste_id, site, day_of_week, hour, ...): statistics of the last `lookback` days of each series.

    recent are the readings of the last int(lookback * bias) days, historical those before; tpl blends their medians by bias where both exist.
    One pass with filtered aggregates.
    """
    last = featured.groupBy(*KEY).agg(F.max("slot").alias("last_slot"))
    x = featured.join(last, KEY).where(F.col("slot") >= F.col("last_slot") - lookback * DAY)
    recent = F.col("slot") >= F.col("last_slot") - int(lookback * bias) * DAY
    g = x.groupBy(*KEY, "day_of_week", "hour").agg(
        median(F.when(recent, F.col("value"))).alias("m_recent"), median(F.when(~recent, F.col("value"))).alias("m_hist"),
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
        F.percentile("value", F.lit(0.25)).alias("q25"), F.percentile("value", F.lit(0.75)).alias("q75"),
        F.count(F.when(recent, 1)).alias("recent_count"), F.count(F.when(~recent, 1)).alias("historical_count"),
    )
    blend = F.round(bias * F.col("m_recent") + (1 - bias) * F.col("m_hist"), 6)
    return g.withColumn("tpl", F.coalesce(blend, "m_recent", "m_hist")).drop("m_recent", "m_hist")


def day_variance(templates: DataFrame) -> DataFrame:
    return templates.groupBy(*KEY, "day_of_week").agg(F.stddev_pop("tpl").alias("day_std"))


def uncertainty_bounds(r: DataFrame) -> DataFrame:
    """(poste_id, site, lower, upper): mean -+ 2 sample deviations, not below 0; with fewer than 10 readings 0 and 1.5 times the greatest."""
    g = r.groupBy(*KEY).agg(F.count("*").alias("n"), F.avg("value").alias("m"), F.stddev_samp("value").alias("s"), F.max("value").alias("top"))
    few = F.col("n") < 10
    low = F.when(few, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.col("m") - 2 * F.col("s")))
    high = F.when(few, 1.5 * F.col("top")).otherwise(F.col("m") + 2 * F.col("s"))
    return g.select(*KEY, low.alias("lower"), high.alias("upper"))


def peers(r: DataFrame, meters: DataFrame) -> DataFrame:
    """Slots where a sub-meter and its parent both have a number: (poste_id, site, slot, child, parent_value)."""
    subs = meters.where("tier = 'sub' and parent is not null and parent <> site").select("site", "parent").distinct()
    child = r.join(F.broadcast(subs), "site").select("poste_id", "site", "parent", "slot", F.col("value").alias("child"))  # one row a meter
    parent = r.select("poste_id", F.col("site").alias("parent"), "slot", F.col("value").alias("parent_value"))
    return child.join(parent, ["poste_id", "parent", "slot"])


def peer_ratio(r: DataFrame, meters: DataFrame, latest: int = 144, default: float = 0.5) -> DataFrame:
    """(poste_id, site, n_pairs, ratio) for each series of a sub-meter: the median of child / parent over the latest pairs with parent > 1."""
    subs = meters.where("tier = 'sub'").select("site").distinct()
    w = Window.partitionBy(*KEY).orderBy(F.col("slot").desc())
    p = peers(r, meters).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= latest).where("parent_value > 1")
    g = p.groupBy(*KEY).agg(F.count("*").alias("n_pairs"), median(F.round(F.col("child") / F.col("parent_value"), 9)).alias("ratio"))
    every = r.join(F.broadcast(subs), "site").select(*KEY).distinct()
    return every.join(g, KEY, "left").select(*KEY, F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"), F.coalesce("ratio", F.lit(default)).alias("ratio"))


def correlations(w: DataFrame, sites: tuple[str, ...] = SITES, least: int = 10) -> DataFrame:
    """(poste_id, s1, s2, n, r) for ordered pairs of sites with more than `least` slots in common; one pass over the wide frame, no join."""
    pairs = list(permutations(sites, 2))
    aggs = [F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1)).alias(f"n{i}") for i, (a, b) in enumerate(pairs)]
    aggs += [F.corr(F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]
    g = w.groupBy("poste_id").agg(*aggs)
    each = F.array(*[F.struct(F.lit(a).alias("s1"), F.lit(b).alias("s2"), F.col(f"n{i}").alias("n"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)])
    r = F.round(F.coalesce(F.nanvl("r", F.lit(0.0)), F.lit(0.0)), 4)
    return g.select("poste_id", F.explode(each).alias("x")).select("poste_id", "x.*").where(F.col("n") > least).withColumn("r", r)
