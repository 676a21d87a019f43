"""Wall-clock times to instants, and where a clock was put forward or back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmend.operators.series import KEY, STEP_US, local, neighbours


def localise(wall: Column, tz: str = "Europe/Paris", ambiguous: str = "last") -> Column:
    """The instant of a wall-clock time (both as UTC timestamps): the later one (or `first`) where it occurred twice; a skipped one moves to the change."""
    z = F.to_utc_timestamp(wall.cast("timestamp"), tz)
    later = z + F.expr("INTERVAL 1 HOUR")
    twice, real = F.from_utc_timestamp(later, tz) == wall, F.from_utc_timestamp(z, tz) == wall
    return F.when(twice, later if ambiguous == "last" else z).when(real, z).otherwise(F.date_trunc("hour", z))


def dst_events(r: DataFrame, tz: str = "Europe/Paris") -> DataFrame:
    """(poste_id, site, slot, minutes, kind): where successive wall-clock times are 60 to 90 minutes apart (spring_forward), go back, or are nearly the same (fall_back)."""
    n = neighbours(r).where("prev is not null")
    d = ((F.unix_seconds(local(F.col("slot"), tz)) - F.unix_seconds(local(F.col("prev.slot"), tz))) / 60).cast("bigint")
    kind = F.when((d > 60) & (d < 90), "spring_forward").when((d < 0) | ((d > -60) & (d < 5) & (d != STEP_US // 60_000_000)), "fall_back")
    return n.select(*KEY, "slot", d.alias("minutes"), kind.alias("kind")).where("kind is not null")
