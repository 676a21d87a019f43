import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmend.llm import quantiles


def frame(spark, xs):
    return spark.createDataFrame([(g, v, 1.0) for g, v in xs], "g string, v double, bucket double")


@pytest.mark.parametrize("error", [0.01, 0.05])
def test_error_is_bounded_for_any_sign_and_size(spark, error):
    rng = np.random.default_rng(0)
    xs = [*(rng.normal(0, 1, 500) * 10.0 ** rng.integers(-6, 9, 500)), 0.0, 0.0, -5.0, -5.0]
    s = quantiles.sketch(frame(spark, [("a", float(x)) for x in xs]), {"g": F.col("g")}, F.col("v"), error)
    at = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r["p"]: r["value"] for r in quantiles.percentiles(s, ["g"], at, error).collect()}
    ordered = sorted(xs)
    for p in at:
        want = ordered[max(1, math.ceil(p * len(xs) - 1e-9)) - 1]
        assert abs(got[p] - want) <= error * abs(want) * (1 + 1e-9)


def test_parts_combine_into_the_whole(spark):
    rng = np.random.default_rng(1)
    df = frame(spark, [(str(i % 3), float(x)) for i, x in enumerate(rng.lognormal(8, 2, 900))])
    whole = quantiles.sketch(df.withColumn("g", F.lit("all")), {"g": F.col("g")}, F.col("v"))
    parts = quantiles.merge(quantiles.sketch(df, {"g": F.col("g")}, F.col("v")).withColumn("g", F.lit("all")), ["g"])
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))


def test_nulls_nans_infinities_and_nothing(spark):
    df = frame(spark, [("a", None), ("a", float("nan")), ("b", float("inf")), ("b", float("-inf")), (None, 3.0)])
    s = quantiles.sketch(df, {"g": F.col("g")}, F.col("v"))
    got = {(r["g"], r["p"]): (r["n"], r["value"]) for r in quantiles.percentiles(s, ["g"], [0.0, 1.0]).collect()}
    assert got["b", 0.0] == (2, -math.inf) and got["b", 1.0] == (2, math.inf) and got[None, 1.0][0] == 1 and got[None, 1.0][1] == pytest.approx(3, rel=0.01) and ("a", 0.0) not in got
    assert quantiles.percentiles(quantiles.sketch(df.limit(0), {"g": F.col("g")}, F.col("v")), ["g"], [0.5]).count() == 0
    with pytest.raises(ValueError):
        quantiles.percentiles(s, ["g"], [1.5])
