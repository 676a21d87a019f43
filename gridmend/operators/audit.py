"""Tables that tell what was repaired and how."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmend.functions.cols import fixed
from gridmend.operators.features import full_features
from gridmend.operators.router import GAP, by_strategy
from gridmend.operators.series import KEY, local, points


def quality(cells: DataFrame, logged: DataFrame) -> DataFrame:
    """cells (poste_id, site, slot, value of the input) with their flag: 0 where a number was read, else that of the gap's strategy, 2 without one."""
    p = points(logged).select(*KEY, "slot", "strategy")
    flag = F.when(F.col("value").isNotNull(), 0).when(F.col("strategy").isNull(), 2).otherwise(by_strategy(1, F.col("strategy")))
    return cells.join(p, [*KEY, "slot"], "left").withColumn("quality", flag.cast("int"))


def gap_log(confident: DataFrame, cal: DataFrame) -> DataFrame:
    """The log's lines: bounds, strategy, confidence, and the days and occupancies met, joined in order of first appearance."""
    f = full_features(points(confident.select(*GAP, "gap_end", "gap_size", "y_l", "y_r")), cal)
    seen = f.groupBy(*GAP).agg(F.sort_array(F.collect_set(F.struct("local_date", "day_of_week"))).alias("d"), F.bool_or("is_holiday").alias("has_holiday"))
    # an occupancy's first slot in the gap gives its place
    o = f.groupBy(*GAP, "occupancy_type").agg(F.min("slot").alias("s")).groupBy(*GAP).agg(F.sort_array(F.collect_list(F.struct("s", "occupancy_type"))).alias("o"))
    seen = seen.join(o.select(*GAP, F.transform("o", lambda x: x["occupancy_type"]).alias("o")), GAP)
    days = F.array_join(F.array_distinct(F.transform("d", lambda x: x["day_of_week"])), ", ")
    return confident.select(*GAP, "gap_end", "gap_size", "strategy", "confidence").join(seen, GAP).select(*GAP, "gap_end", "gap_size", "strategy", "confidence", days.alias("days"), F.array_join("o", ", ").alias("occupancies"), "has_holiday")


def iso(slot: Column, tz: str = "Europe/Paris") -> Column:
    """A slot's start as text with the zone's offset: 2025-01-06T00:00:00+0100."""
    t = local(slot, tz)
    minutes = ((F.unix_seconds(t) - slot * 600) / 60).cast("int")
    offset = F.concat(F.when(minutes < 0, "-").otherwise("+"), F.format_string("%02d%02d", (F.abs(minutes) / 60).cast("int"), F.abs(minutes) % 60))
    return F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), offset)


def routing_trace() -> Column:
    """The router's decisions on a gap, in order; for gaps with strategy, tier, parent_present, day_type and confidence."""
    s, peer = F.col("strategy"), F.col("strategy") == "PEER_CORRELATION"
    early = s.isin("MULTI_WEEK_TEMPLATE", "MICE", "KALMAN_FILTER", "KNN_CONTEXT")
    last = (
        F.when(s == "LINEAR_MICRO", "BRANCH: LINEAR_MICRO (size<=3)").when(s == "LINEAR_SHORT", "BRANCH: LINEAR_SHORT (size<=18)")
        .when(s.startswith("WEEKEND"), F.concat(F.lit("BRANCH: WEEKEND_TEMPLATE ("), "day_type", F.lit(")"))).when(s == "THERMAL_TEMPLATE", "BRANCH: THERMAL_TEMPLATE (non-entry, <=1 day)")
        .when(s == "ENHANCED_TEMPLATE", "BRANCH: ENHANCED_TEMPLATE (non-entry, >1 day)").when(s == "SAFE_LINEAR_MEDIAN", "BRANCH: SAFE_LINEAR_MEDIAN (entry meter fallback)")
    )
    steps = [
        F.concat(F.lit("START: size="), F.col("gap_size").cast("string"), F.lit(", tier="), "tier"),
        F.when(s == "MULTI_WEEK_TEMPLATE", "BRANCH: MULTI_WEEK_TEMPLATE (longer than a chunk)"),
        F.when(s.isin("MICE", "KALMAN_FILTER", "KNN_CONTEXT"), "BRANCH: ML_CASCADE (size>50, non-entry)"),
        F.when(s.isin("MICE", "KALMAN_FILTER", "KNN_CONTEXT"), F.concat(F.lit("TRY: "), s)),
        F.when(~early & (F.col("tier") == "sub"), "BRANCH: PEER_CORRELATION (sub-meter)"),
        F.when(~early & (F.col("tier") == "sub") & ~peer, "SKIP: parent has no data in gap window"),
        last,
        F.concat(F.lit("SELECTED: "), s, F.lit(" (confidence="), fixed("confidence", 3).cast("string"), F.lit(")")),
    ]
    return F.array_compact(F.array(*steps))


def gap_details(confident: DataFrame, cal: DataFrame, ratios: DataFrame, bounds: DataFrame) -> DataFrame:
    """Per gap its first and last missing time as text, length in minutes, days in order of appearance, holiday slots, routing trace, peer ratio (of PEER_CORRELATION only) and the series' bounds (null without)."""
    f = full_features(points(confident.select(*GAP, "gap_end", "gap_size", "y_l", "y_r")), cal)
    seen = f.groupBy(*GAP, "local_date", "day_of_week").agg(F.count(F.when(F.col("is_holiday"), 1)).alias("h")).groupBy(*GAP).agg(F.sort_array(F.collect_list(F.struct("local_date", "day_of_week"))).alias("d"), F.sum("h").alias("holiday_slots"))
    x = confident.join(seen, GAP).join(ratios.select(*KEY, "ratio"), KEY, "left").join(bounds.select(*KEY, "lower", "upper"), KEY, "left")
    days = F.array_join(F.array_distinct(F.transform("d", lambda v: v["day_of_week"])), ", ")
    return x.select(
        *GAP, "gap_end", (F.col("gap_size") * 10).alias("gap_size_minutes"), iso(F.col("gap_start")).alias("first_missing"), iso(F.col("gap_end") - 1).alias("last_missing"), days.alias("unique_days"), "holiday_slots",
        "strategy", "confidence", F.array_join(routing_trace(), " -> ").alias("routing_trace"), F.when(F.col("strategy") == "PEER_CORRELATION", F.col("ratio")).alias("peer_ratio"), "lower", "upper",
    )


def gap_records(confident: DataFrame, cal: DataFrame, weekly: DataFrame, ratios: DataFrame, bounds: DataFrame) -> DataFrame:
    """One JSON document a gap, for the audit file: gap_details, every missing slot with its time, day, hour, occupancy and holiday flag, and the weekly template's cells that the gap meets.

    A document is as long as its gap; a row a slot is brought together by gap.
    """
    f = full_features(points(confident.select(*GAP, "gap_end", "gap_size", "y_l", "y_r")), cal)
    slots = f.groupBy(*GAP).agg(F.sort_array(F.collect_list(F.struct("slot", iso(F.col("slot")).alias("timestamp"), F.col("local_date").cast("string").alias("date"), "day_of_week", "hour", "occupancy_type", "is_holiday"))).alias("missing"))
    cells = f.select(*GAP, "day_of_week", "hour").distinct().join(weekly, [*KEY, "day_of_week", "hour"])
    cell = F.struct(F.concat("day_of_week", F.lit("_h"), F.format_string("%02d", "hour")).alias("cell"), F.round("tpl", 4).alias("median"), F.round("std", 4).alias("std"), "recent_count", "historical_count")
    cells = cells.groupBy(*GAP).agg(F.sort_array(F.collect_list(cell)).alias("template_values"))
    d = gap_details(confident, cal, ratios, bounds).join(slots, GAP).join(cells, GAP, "left")
    inputs = F.struct("template_values", "peer_ratio", F.struct("lower", "upper").alias("uncertainty_bounds"))
    doc = F.struct(*GAP, "gap_end", "gap_size_minutes", "first_missing", "last_missing", "unique_days", "holiday_slots", F.col("strategy").alias("method"), "confidence", F.split("routing_trace", " -> ").alias("routing_trace"), "missing", inputs.alias("inputs_used"))
    return d.select(*GAP, F.to_json(doc).alias("record"))


def run_summary(confident: DataFrame, low: float = 0.5) -> DataFrame:
    """Per series the gaps, missing slots, strategies in order, mean and least confidence, and how many are low."""
    return confident.groupBy(*KEY).agg(
        F.count("*").alias("gaps"), F.sum("gap_size").alias("missing_slots"), F.array_join(F.sort_array(F.collect_set("strategy")), ", ").alias("methods"),
        fixed(F.avg("confidence"), 4).alias("mean_confidence"), F.min("confidence").alias("min_confidence"), F.count(F.when(F.col("confidence") < low, 1)).alias("low_confidence"),
    )


def low_confidence(confident: DataFrame, below: float = 0.5) -> DataFrame:
    return confident.where(F.col("confidence") < below).select(*GAP, "gap_end", "gap_size", "strategy", "confidence")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """target with the batch's columns taken where the batch has a row, other columns untouched, new rows added; keys are unique in both."""
    new = batch.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in batch.columns if c not in keys], F.lit(True).alias("_hit"))
    both = target.join(new, keys, "full")
    cols = [F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in batch.columns and c not in keys else F.col(c) for c in target.columns]
    return both.select(*cols)
