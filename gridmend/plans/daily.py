"""The nightly batch: every station's last week, in one job instead of one process a building."""

from __future__ import annotations

import os
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmend.functions.cols import epoch_us, floordiv, number
from gridmend.operators import series, window
from gridmend.plans.engine import Config, reconstruct
from gridmend.sources.tables import checkpoint_dir


def env_int(name: str, default: int, low: int, high: int) -> int:
    """An integer of the environment between low and high, else an error that names it."""
    raw = os.environ.get(name, str(default))
    if not raw.lstrip("-").isdigit() or not low <= int(raw) <= high:
        raise ValueError(f"{name}={raw!r} is not an integer from {low} to {high}")
    return int(raw)


def tomorrow(tz: str = "Europe/Paris", now: datetime | None = None) -> date:
    return ((now or datetime.now(ZoneInfo(tz))).astimezone(ZoneInfo(tz)) + timedelta(days=1)).date()


def parse_gap(start: str, end: str) -> tuple[datetime, datetime]:
    """Bounds of a test gap, both included; ValueError if unreadable or reversed."""
    a, b = datetime.fromisoformat(start), datetime.fromisoformat(end)
    if a > b:
        raise ValueError(f"gap ends before it starts: {start} > {end}")
    return a, b


@dataclass
class Daily:
    windows: DataFrame  # poste_id, site, slot, idx, value, quality
    status: DataFrame  # poste_id, site, state: ok, or what the window lacks


#: Days before the window that the look-ups and templates draw on.
HISTORY_DAYS = 56


def run(clean: DataFrame, meters: DataFrame, days: DataFrame, cfg: Config = Config(), target: date | None = None) -> Daily:
    """The reconstructed last week of every series; a series without a number in it is reported instead of failing the others.

    target: the local day that the windows end before; None: the day of each station's last reading. Only the window and the HISTORY_DAYS before it are worked on: with a target the scan itself
    is bounded (dates push down to the files), else each station's rows are cut to its own span before everything else.
    """
    if target is not None:
        end = datetime(target.year, target.month, target.day, tzinfo=ZoneInfo("Europe/Paris")).astimezone(ZoneInfo("UTC"))
        lo, hi = (F.lit((end - timedelta(days=d)).replace(tzinfo=None).isoformat(" ")).cast(clean.schema["Date"].dataType) for d in (HISTORY_DAYS + 7 + 1, 0))
        clean = clean.where((F.col("Date") >= lo) & (F.col("Date") < hi))
        every, ends = None, clean.select("poste_id").distinct().withColumn("target", F.lit(int(end.timestamp()) // 600))
    else:
        slot = floordiv(epoch_us(F.col("Date")) + series.STEP_US // 2, series.STEP_US)
        sites = F.explode(F.array_compact(F.array(*[F.when(number(F.col(c)).isNotNull(), F.lit(c)) for c in series.SITES])))
        checkpoint_dir(clean.sparkSession)
        every = clean.select("poste_id", slot.alias("slot"), sites.alias("site")).where("poste_id is not null and slot is not null").groupBy(*series.KEY).agg(F.max("slot").alias("slot")).checkpoint()  # a row a series
        ends = window.targets(every).checkpoint()  # a row a station
        first = F.col("target") - series.WEEK - HISTORY_DAYS * series.DAY
        clean = clean.join(ends, "poste_id").where(slot >= first).drop("target")
    r = series.readings(clean)
    w = window.extract(r, ends, every.select(*series.KEY) if every is not None else None)
    status = w.groupBy(*series.KEY).agg(F.when(F.count("value") == 0, "no number in the window").when(F.count("*") != series.WEEK, "window incomplete").otherwise("ok").alias("state"))
    done = reconstruct(clean, meters, days, cfg).values
    full = w.join(status.where("state = 'ok'"), series.KEY).drop("value", "state").join(done.select(*series.KEY, "slot", "value", "quality"), [*series.KEY, "slot"], "left")
    return Daily(full, status)
