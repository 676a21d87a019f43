"""The canonical long frame (poste_id, site, slot, value), its regular grid, and its gaps.

A series is one site (channel) of one station. slot counts steps of ten minutes since 1970 UTC; value is never null or NaN in
readings and null for an empty cell of a grid. Gaps come from consecutive readings, not from the grid: one window of blocks instead of a
sort of every cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmend.functions.cols import epoch_us, floordiv, number
from gridmend.operators.blocks import carry

SITES = ("Ptot_HA", "Ptot_HEI", "Ptot_HEI_13RT", "Ptot_HEI_5RNS", "Ptot_RIZOMM")
#: What the virtual meter of the campus adds up.
CAMPUS = ("Ptot_HA", "Ptot_HEI_13RT", "Ptot_HEI_5RNS", "Ptot_RIZOMM")
KEY = ["poste_id", "site"]
STEP_US, DAY, WEEK = 600_000_000, 144, 1008
BLOCK = 2016


def wide(clean: DataFrame, sites: tuple[str, ...] = SITES) -> DataFrame:
    """(poste_id, slot, sites...): per station and slot the number of the latest row (greatest reading_id) that has one."""
    slot = floordiv(epoch_us(F.col("Date")) + STEP_US // 2, STEP_US)
    t = clean.select("poste_id", slot.alias("slot"), "reading_id", *[number(F.col(c)).alias(c) for c in sites]).where("poste_id is not null and slot is not null")
    return t.groupBy("poste_id", "slot").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("reading_id"))).alias(c) for c in sites])


def long(w: DataFrame, sites: tuple[str, ...] = SITES) -> DataFrame:
    """wide to (poste_id, site, slot, value), without empty cells."""
    return w.unpivot(["poste_id", "slot"], list(sites), "site", "value").where("value is not null").select(*KEY, "slot", "value")


def pivot(r: DataFrame, sites: tuple[str, ...] = SITES) -> DataFrame:
    """long to wide; the sites are given, so no pass looks for them."""
    return r.groupBy("poste_id", "slot").pivot("site", list(sites)).agg(F.first("value", True))


def readings(clean: DataFrame) -> DataFrame:
    return long(wide(clean))


def neighbours(r: DataFrame, block: int = BLOCK) -> DataFrame:
    """readings with prev and next: struct(slot, value) of the readings around, null at the ends of a series."""
    x = r.select(*KEY, "slot", "value", floordiv(F.col("slot"), block).alias("block"), F.struct("slot", "value").alias("here"))
    ends = x.groupBy(*KEY, "block").agg(F.min("here").alias("first"), F.max("here").alias("last"))
    w = Window.partitionBy(*KEY, "block").orderBy("slot")
    x = x.join(carry(ends, KEY, "block", "first", "last"), [*KEY, "block"])
    x = x.withColumns({"prev": F.coalesce(F.lag("here").over(w), "before"), "next": F.coalesce(F.lead("here").over(w), "after")})
    return x.select(*KEY, "slot", "value", "prev", "next")


def gaps(r: DataFrame) -> DataFrame:
    """(poste_id, site, gap_start, gap_end, gap_size, y_l, y_r): maximal runs of slots without a reading, gap_end excluded; the readings beside them."""
    n = neighbours(r).where(F.col("next.slot") > F.col("slot") + 1)
    return n.select(*KEY, (F.col("slot") + 1).alias("gap_start"), F.col("next.slot").alias("gap_end"), (F.col("next.slot") - F.col("slot") - 1).alias("gap_size"), F.col("value").alias("y_l"), F.col("next.value").alias("y_r"))


def points(g: DataFrame) -> DataFrame:
    """One row per missing slot: the gap's columns, slot and k = 1..gap_size."""
    return g.withColumn("slot", F.explode(F.sequence("gap_start", F.col("gap_end") - 1))).withColumn("k", F.col("slot") - F.col("gap_start") + 1)


def grid(r: DataFrame) -> DataFrame:
    """readings and the empty cells between a series' first and last."""
    return r.unionByName(points(gaps(r)).select(*KEY, "slot", F.lit(None).cast("double").alias("value")))


def slot_time(slot: Column) -> Column:
    return F.timestamp_seconds(slot * 600)


def local(slot: Column, tz: str = "Europe/Paris") -> Column:
    """Wall-clock time of a slot, as a timestamp whose fields (in a UTC session) are the zone's."""
    return F.from_utc_timestamp(slot_time(slot), tz)


def median(c: str | Column) -> Column:
    return F.round(F.percentile(c, F.lit(0.5)), 6)
