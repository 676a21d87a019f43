"""Calendar, occupancy and weather features of slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmend.functions.cols import fixed, floordiv, number
from gridmend.operators.blocks import carry
from gridmend.operators.series import BLOCK, KEY, local


def calendar(days: DataFrame) -> DataFrame:
    """(cal_date, kind) once each, kind in lower case; rows with nulls dropped."""
    return days.select("cal_date", F.lower(F.trim("kind")).alias("kind")).where("cal_date is not null and kind is not null").distinct()


def day_name(c: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")]), F.dayofweek(c))


def datetime_features(slots: DataFrame, tz: str = "Europe/Paris") -> DataFrame:
    t = local(F.col("slot"), tz)
    return slots.withColumns({"hour": F.hour(t), "day_of_week": day_name(t), "local_date": F.to_date(t)})


def season(month: Column) -> Column:
    return F.when(month.isin(12, 1, 2), "winter").when(month.isin(3, 4, 5), "spring").when(month.isin(6, 7, 8), "summer").otherwise("fall")


def thermal_regime(temp: Column) -> Column:
    """Up to 10 Cold, up to 20 Mild, above Hot; null stays null."""
    return F.when(temp <= 10, "Cold").when(temp <= 20, "Mild").when(temp > 20, "Hot")


def _dates(cal: DataFrame, kinds: list[str], name: str, around: int = 0) -> DataFrame:
    d = cal.where(F.col("kind").isin(kinds)).select(F.explode(F.sequence(F.date_sub("cal_date", around), F.date_add("cal_date", around))).alias("local_date"))
    return d.distinct().withColumn(name, F.lit(True))


def day_flags(f: DataFrame, cal: DataFrame) -> DataFrame:
    """is_holiday, is_special_day (close or special), is_holiday_close (within a day of a holiday). cal: a few days a year."""
    for name, kinds, around in (("is_holiday", ["holiday"], 0), ("is_special_day", ["close", "special"], 0), ("is_holiday_close", ["holiday"], 1)):
        f = f.join(_dates(cal, kinds, name, around), "local_date", "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return f


def occupancy(f: DataFrame) -> DataFrame:
    """occupancy_type and is_occupied from hour, day_of_week and is_holiday."""
    weekend = F.col("day_of_week").isin("Saturday", "Sunday")
    kind = F.when(F.col("is_holiday"), "holiday").when(weekend, "weekend").when((F.col("hour") >= 18) | (F.col("hour") < 6), "evening").otherwise("work_hours")
    return f.withColumns({"occupancy_type": kind, "is_occupied": kind == "work_hours"})


def full_features(slots: DataFrame, cal: DataFrame) -> DataFrame:
    return occupancy(day_flags(datetime_features(slots), cal)).withColumn("season", season(F.month("local_date")))


def event_days(r: DataFrame) -> DataFrame:
    """(poste_id, site, local_date, daily_std, threshold): days whose sample deviation exceeds the series' 75th percentile of daily ones."""
    d = datetime_features(r).groupBy(*KEY, "local_date").agg(fixed(F.stddev_samp("value"), 3).alias("daily_std")).where("daily_std is not null")
    t = d.groupBy(*KEY).agg(fixed(F.percentile("daily_std", F.lit(0.75)), 3).alias("threshold"))
    return d.join(t, KEY).where("daily_std > threshold")


def weather(meteo: DataFrame) -> DataFrame:
    """(station_id, slot, air_temp): per slot the latest row's temperature (greatest meteo_id with one), null if none has one."""
    from gridmend.functions.cols import epoch_us

    slot = floordiv(epoch_us(F.col("Date")) + 300_000_000, 600_000_000)
    t = meteo.select("station_id", slot.alias("slot"), "meteo_id", number(F.col("AirTemp")).alias("v")).where("station_id is not null and slot is not null")
    return t.groupBy("station_id", "slot").agg(F.max_by("v", F.when(F.col("v").isNotNull(), F.col("meteo_id"))).alias("air_temp"))


def fill_forward_backward(df: DataFrame, source: str, order: str, value: str, block: int = BLOCK) -> DataFrame:
    """value where null from the nearest earlier row of its source, else from the nearest later one; in blocks, for sources of any size."""
    x = df.withColumn("_block", floordiv(F.col(order), block))
    w = Window.partitionBy(source, "_block").orderBy(order)
    ends = x.groupBy(source, "_block").agg(F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_first"), F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_last"))
    x = x.join(carry(ends, source, "_block", "_first", "_last"), [source, "_block"])
    back = F.last(value, True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(value, True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return x.withColumn(value, F.coalesce(back, "before", ahead, "after")).drop("_block", "before", "after")


def weather_spikes(wx: DataFrame) -> DataFrame:
    """(station_id, local_date, temp_range): days whose range exceeds the station's 80th percentile of ranges."""
    d = datetime_features(wx).groupBy("station_id", "local_date").agg(F.round(F.max("air_temp") - F.min("air_temp"), 6).alias("temp_range")).where("temp_range is not null")
    t = d.groupBy("station_id").agg(F.round(F.percentile("temp_range", F.lit(0.8)), 6).alias("threshold"))
    return d.join(t, "station_id").where("temp_range > threshold")
