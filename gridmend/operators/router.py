"""Which strategy repairs which gap, how sure it is, and the quality flag it leaves."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmend.functions.cols import fixed
from gridmend.operators.series import DAY, KEY, points

GAP = [*KEY, "gap_start"]
#: Confidence and quality flag by strategy; the default is for names not listed.
STRATEGIES = {
    "MULTI_WEEK_TEMPLATE": (0.90, 3), "MICE": (0.85, 3), "KNN_CONTEXT": (0.80, 3), "KALMAN_FILTER": (0.75, 3), "PEER_CORRELATION": (0.75, 2), "THERMAL_TEMPLATE": (0.70, 2),
    "ENHANCED_TEMPLATE": (0.65, 2), "LINEAR_SHORT": (0.50, 1), "SAFE_LINEAR_MEDIAN": (0.45, 2), "LINEAR_MICRO": (0.40, 1), "SAFE_MEDIAN": (0.30, 3),
}
DEFAULT = (0.5, 2)


@dataclass(frozen=True)
class Routing:
    chunked: bool = True
    chunk: int = 96
    mice: bool = True
    kalman: bool = True
    knn: bool = True


def classify(g: DataFrame) -> DataFrame:
    """gaps with any_weekend, pure_weekend and day_type (saturday, sunday, mixed; null unless purely weekend), by local days."""
    from gridmend.operators.series import local

    # by the local days that a gap touches, not by its slots
    days = F.sequence(F.to_date(local(F.col("gap_start"))), F.to_date(local(F.col("gap_end") - 1)))
    saturday, sunday = (lambda d: F.dayofweek(d) == 7), (lambda d: F.dayofweek(d) == 1)
    g = g.withColumn("_days", days)
    pure = F.forall("_days", lambda d: saturday(d) | sunday(d))
    kind = F.when(F.forall("_days", saturday), "saturday").when(F.forall("_days", sunday), "sunday").when(pure, "mixed")
    return g.withColumns({"any_weekend": F.exists("_days", lambda d: saturday(d) | sunday(d)), "pure_weekend": pure, "day_type": kind}).drop("_days")


def with_hierarchy(g: DataFrame, r: DataFrame, meters: DataFrame) -> DataFrame:
    """gaps with tier ('unknown' where no meter says), parent, and whether a sub-meter's parent has a number inside the gap."""
    m = meters.groupBy("site").agg(F.min("tier").alias("tier"), F.min("parent").alias("parent"))
    g = g.join(F.broadcast(m), "site", "left").withColumn("tier", F.coalesce("tier", F.lit("unknown")))
    p = points(g.where("tier = 'sub' and parent is not null").select(*GAP, "gap_end", "parent"))
    seen = p.join(r.select("poste_id", F.col("site").alias("parent"), "slot"), ["poste_id", "parent", "slot"]).select(*GAP).distinct().withColumn("parent_present", F.lit(True))
    return g.join(seen, GAP, "left").withColumn("parent_present", F.coalesce("parent_present", F.lit(False)))


def route(g: DataFrame, how: Routing = Routing()) -> DataFrame:
    """gaps (classified, with hierarchy) with their strategy; the first rule that holds decides."""
    n, entry = F.col("gap_size"), F.col("tier") == "entry"
    long_gap = (n > 50) & ~entry
    rules: list[tuple[Column, str | Column]] = [(n > how.chunk, "MULTI_WEEK_TEMPLATE")] if how.chunked else []
    rules += [(long_gap, name) for on, name in ((how.mice, "MICE"), (how.kalman, "KALMAN_FILTER"), (how.knn, "KNN_CONTEXT")) if on]
    rules += [
        ((F.col("tier") == "sub") & F.col("parent_present"), "PEER_CORRELATION"),
        (n <= 3, "LINEAR_MICRO"),
        (n <= 18, "LINEAR_SHORT"),
        (F.col("pure_weekend"), F.concat(F.lit("WEEKEND_TEMPLATE_"), F.upper("day_type"))),
        (~entry & (n <= DAY), "THERMAL_TEMPLATE"),
        (~entry, "ENHANCED_TEMPLATE"),
    ]
    strategy = reduce(lambda c, x: c.when(x[0], x[1]), rules, F.when(F.lit(False), F.lit(""))).otherwise("SAFE_LINEAR_MEDIAN")
    return g.withColumn("strategy", strategy)


def by_strategy(which: int, c: Column) -> Column:
    return reduce(lambda x, s: x.when(c == s, F.lit(STRATEGIES[s][which])), STRATEGIES, F.when(F.lit(False), F.lit(DEFAULT[which]))).otherwise(F.lit(DEFAULT[which]))


def confidence(strategy: Column, n: Column, occupancy: Column, holiday: Column) -> Column:
    size = F.when(n < 10, 1.0).when(n < 50, 0.9).when(n < 144, 0.7).when(n < 1008, 0.5).otherwise(0.3)
    hours = F.when(occupancy == "work_hours", 1.0).when(occupancy == "evening", 0.8).when(occupancy == "weekend", 0.7).when(occupancy == "holiday", 0.5).otherwise(0.6)
    return fixed(F.least(F.greatest(by_strategy(0, strategy) * size * hours * F.when(holiday, 0.7).otherwise(1.0), F.lit(0.0)), F.lit(1.0)), 4)


def with_confidence(routed: DataFrame, cal: DataFrame) -> DataFrame:
    """routed gaps with occupancy and holiday at their first slot, and confidence."""
    from gridmend.operators.features import full_features

    f = full_features(routed.withColumn("slot", F.col("gap_start")), cal)
    return f.withColumn("confidence", confidence(F.col("strategy"), F.col("gap_size"), F.col("occupancy_type"), F.col("is_holiday")))


def fixed_chunks(g: DataFrame, size: int = 96) -> DataFrame:
    """(poste_id, site, gap_start, chunk_index, chunk_start, chunk_end): gaps longer than size in slices of size, chunk_end excluded."""
    c = g.where(F.col("gap_size") > size).withColumn("chunk_index", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("gap_size") / size) - 1).cast("int"))))
    start = F.col("gap_start") + F.col("chunk_index") * size
    return c.select(*GAP, "chunk_index", start.alias("chunk_start"), F.least(start + size, F.col("gap_end")).alias("chunk_end"))


def smart_chunks(g: DataFrame, variance: DataFrame, size: int = 96) -> DataFrame:
    """(poste_id, site, gap_start, chunk_index, chunk_start, chunk_end): slices that end at midnight or on volatile days.

    Steps are counted from 0 at a slice's first slot. A slice ends before a slot at which the count has reached 1.5 times size, or exceeds 0.8 times size on
    a volatile day, or at local midnight has reached size; the count is 0 again at that slot. A day of the week is volatile
    for a station if its template deviation exceeds 1.3 times the median of those of the station's first site that has any.
    """
    from gridmend.operators.series import local

    first = variance.groupBy("poste_id").agg(F.min("site").alias("site"))
    v = variance.join(first, KEY)
    med = v.groupBy("poste_id").agg(F.percentile("day_std", F.lit(0.5)).alias("med"))
    volatile = v.join(med, "poste_id").where(F.col("day_std") > 1.3 * F.col("med")).groupBy("poste_id").agg(F.collect_set("day_of_week").alias("volatile"))
    x = g.where(F.col("gap_size") > size).join(volatile, "poste_id", "left").withColumn("volatile", F.coalesce("volatile", F.array().cast("array<string>")))
    zero = F.struct(F.lit(-1).cast("bigint").alias("count"), F.array().cast("array<bigint>").alias("cuts"))

    def step(acc: Column, s: Column) -> Column:
        n, t = acc["count"] + 1, local(s)
        cut = (s > F.col("gap_start")) & ((n >= int(1.5 * size)) | (F.array_contains(F.col("volatile"), F.date_format(t, "EEEE")) & (n > 0.8 * size)) | ((F.hour(t) == 0) & (F.minute(t) == 0) & (n >= size)))
        return F.struct(F.when(cut, F.lit(0)).otherwise(n).cast("bigint").alias("count"), F.when(cut, F.concat(acc["cuts"], F.array(s))).otherwise(acc["cuts"]).alias("cuts"))

    cuts = F.aggregate(F.sequence("gap_start", F.col("gap_end") - 1), zero, step)["cuts"]
    x = x.withColumn("starts", F.concat(F.array("gap_start"), cuts)).withColumn("ends", F.concat(cuts, F.array("gap_end")))
    x = x.select(*GAP, F.posexplode(F.arrays_zip("starts", "ends")).alias("chunk_index", "c"))
    return x.select(*GAP, "chunk_index", F.col("c.starts").alias("chunk_start"), F.col("c.ends").alias("chunk_end"))
