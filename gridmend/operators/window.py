"""Windows of a week before a target day, and the history put in front of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmend.operators.series import DAY, KEY, WEEK, local


def targets(r: DataFrame, tz: str = "Europe/Paris") -> DataFrame:
    """(poste_id, target): the slot of local midnight on the day of each station's last reading."""
    last = r.groupBy("poste_id").agg(F.max("slot").alias("last"))
    midnight = F.to_utc_timestamp(F.date_trunc("day", local(F.col("last"), tz)), tz)
    return last.select("poste_id", (F.unix_seconds(midnight) / 600).cast("bigint").alias("target"))


def extract(r: DataFrame, t: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """(poste_id, site, slot, idx, value): the 1008 slots before the target of every series of the station (those of r, or the given ones), idx from 0."""
    every = (r.select(*KEY).distinct() if every is None else every).join(t, "poste_id").withColumn("idx", F.explode(F.sequence(F.lit(0), F.lit(WEEK - 1)))).withColumn("slot", F.col("target") - WEEK + F.col("idx"))
    return every.join(r, [*KEY, "slot"], "left").select(*KEY, "slot", "idx", "value")


def prepend_history(window: DataFrame, r: DataFrame, t: DataFrame, days: int = 56) -> DataFrame:
    """The window's cells and the readings of the `days` before it; of a slot in both the window's counts."""
    start = F.col("target") - WEEK
    history = r.join(t, "poste_id").where((F.col("slot") < start) & (F.col("slot") >= start - days * DAY)).select(*KEY, "slot", "value", F.lit(0).alias("prio"))
    both = history.unionByName(window.select(*KEY, "slot", "value", F.lit(1).alias("prio")))
    return both.groupBy(*KEY, "slot").agg(F.max_by("value", "prio").alias("value"), F.max(F.col("prio") == 1).alias("in_window"))
