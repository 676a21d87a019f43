"""Percentiles of very large numeric columns from mergeable log-bucket sketches (problem 2)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Numbers nearer to zero than this share the zero bucket; their answer is 0 (absolute error below TINY).
TINY = 1e-9
#: Infinite numbers get buckets of their own beyond all finite ones.
INF_BUCKET = 1 << 40


def bucket(v: Column, error: float) -> Column:
    """The signed bucket of a number: k > 0 holds (g**(k-1), g**k] times TINY, -k the same below zero, 0 what is nearer to zero than TINY.

    g = (1 + error) / (1 - error), so that the bucket's middle is within `error` of all its numbers, relative to each.
    """
    log_g = math.log((1 + error) / (1 - error))
    k = F.greatest(F.ceil((F.log(F.abs(v)) - math.log(TINY)) / log_g), F.lit(1)).cast("bigint")
    k = F.when(F.abs(v) == math.inf, F.lit(INF_BUCKET)).when(F.abs(v) < TINY, F.lit(0)).otherwise(k)
    return k * F.signum(v).cast("bigint")


def middle(k: Column, error: float) -> Column:
    g = (1 + error) / (1 - error)
    size = F.exp((F.abs(k) - 1) * math.log(g) + math.log(TINY)) * (2 * g / (1 + g))
    return F.when(k == 0, F.lit(0.0)).when(F.abs(k) == INF_BUCKET, F.signum(k) * F.lit(math.inf)).otherwise(F.signum(k) * size)


def sketch(df: DataFrame, groups: dict[str, Column], value: Column, error: float = 0.01) -> DataFrame:
    """(groups, bucket, n): how many numbers of each group lie in each bucket. Null and NaN are left out; a null group is a group.

    One partial aggregation: a group's share of the rows doesn't matter, at most some thousand counts a group and task are shuffled.
    """
    v = value.cast("double")
    r = df.select(*[c.alias(k) for k, c in groups.items()], F.when(~F.isnan(v), v).alias("v")).where("v is not null")
    return r.groupBy(*groups, bucket(F.col("v"), error).alias("bucket")).agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """The sketch of coarser groups (or of several partitions, days or runs in one frame): matching counts are added."""
    return sketches.groupBy(*groups, "bucket").agg(F.sum("n").alias("n"))


def percentiles(sketches: DataFrame, groups: list[str], at: list[float], error: float = 0.01) -> DataFrame:
    """(groups, p, n, value): value is within `error`, relatively, of the number at rank ceil(p * n) (the least for p = 0) of the group's n in order.

    Groups without a number give no row. The windows run over a group's buckets: some thousand, whatever its rows.
    """
    if not all(0 <= p <= 1 for p in at):
        raise ValueError("percentiles lie between 0 and 1")
    w = Window.partitionBy(*groups)
    s = sketches.withColumns({"upto": F.sum("n").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)), "all": F.sum("n").over(w)})
    ranks = F.array(*[F.struct(F.lit(p).alias("p"), F.greatest(F.ceil(F.lit(p) * F.col("all") - 1e-9), F.lit(1)).alias("rank")) for p in at])
    hit = F.filter(ranks, lambda x: (x["rank"] <= F.col("upto")) & (x["rank"] > F.col("upto") - F.col("n")))
    return s.select(*groups, "all", "bucket", F.explode(hit).alias("h")).select(*groups, F.col("h.p").alias("p"), F.col("all").alias("n"), middle(F.col("bucket"), error).alias("value"))
