"""Masking known readings, repairing them, and measuring the error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmend.operators.series import KEY


def apply_test_gaps(r: DataFrame, ranges: DataFrame) -> DataFrame:
    """readings with masked: whether one of the ranges (poste_id, site, mask_start, mask_end; both ends included) of the series holds the slot.

    The ranges are spread to slots, so that the join is an equality.
    """
    m = ranges.select(*KEY, F.explode(F.sequence("mask_start", "mask_end")).alias("slot")).distinct().withColumn("masked", F.lit(True))
    return r.join(m, [*KEY, "slot"], "left").withColumn("masked", F.coalesce("masked", F.lit(False)))


def report_points(masked: DataFrame, filled: DataFrame) -> DataFrame:
    """Per masked reading the truth, the filled number and the absolute error."""
    t = masked.where("masked").select(*KEY, "slot", F.col("value").alias("ground_truth"))
    return t.join(filled.select(*KEY, "slot", F.col("value").alias("imputed")), [*KEY, "slot"], "left").withColumn("abs_error", F.abs(F.col("imputed") - F.col("ground_truth")))


def report_metrics(points: DataFrame) -> DataFrame:
    e = F.col("abs_error")
    return points.groupBy(*KEY).agg(F.avg(e).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.max(e).alias("max_err"), F.count("*").alias("n_points"), F.count("ground_truth").alias("n_ground_truth"))
