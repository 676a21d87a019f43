"""Irregular readings onto a regular grid (problem 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmend.functions.cols import epoch_us, floordiv, number, ref
from gridmend.operators.blocks import carry


def to_grid(
    df: DataFrame,
    source: str,
    time: str,
    value: str,
    latest: list[str],
    step_s: int = 600,
    kind: str = "gauge",
    max_gap_s: int = 3 * 3600,
    block_slots: int = 1008,
) -> DataFrame:
    """One row per source and slot between the source's first and last slot with a number.

    A slot's cell reaches from half a step before its start to half a step after it, so that a reading belongs to the
    nearest slot. Between two consecutive readings lies an increment: for ``kind="counter"`` the difference of the two
    numbers, or the later number alone where the counter has fallen (a reset); for ``kind="gauge"`` (a rate such as
    power) the trapezoid below the two numbers, which is the difference of the rate's running integral. Increments are
    spread over the cells in proportion to overlap. Intervals longer than max_gap_s are uncovered: their cells get no
    increment from them.

    Result: source, slot_s (bigint seconds), n_readings (bigint), reading (mean of the slot's own numbers), increment
    (of the counter, or of the integral in value times seconds), covered_share (0 to 1), value (gauge: mean rate over the
    covered part; counter: the increment; null if nothing is covered and no number was read), is_reset (a reset fell into the
    cell), status: ``read``, ``filled`` or ``uncovered``.

    Rows without source, time or number (null or NaN) count as absent; an infinite number is a number. Of several rows with the same
    source and time the one greatest by `latest` (nulls first, value last) is taken. Empty input gives an empty result. Other
    columns are ignored, whatever their names.

    Plan: one shuffle of the readings by (source, block of time). Cells of the border between blocks are emitted by the
    side they lie on, so the sum per cell needs no second shuffle, and no task holds more of a source than its blocks.
    """
    us, half, blk = step_s * 1_000_000, step_s * 500_000, block_slots
    r = df.select(
        ref(source).alias("src"), epoch_us(ref(time)).alias("t"), number(ref(value)).alias("v"), F.struct(*[ref(c).alias(f"k{i}") for i, c in enumerate(latest)], number(ref(value)).alias("v")).alias("k")
    ).where("src is not null and t is not null and v is not null")
    r = r.withColumn("cell", floordiv(F.col("t") + half, us)).withColumn("block", floordiv(F.col("cell"), blk))
    r = r.repartition("src", "block").groupBy("src", "block", "t", "cell").agg(F.max_by("v", "k").alias("v"))
    here = F.struct("t", "v").alias("p")
    ends = r.select("src", "block", here).groupBy("src", "block").agg(F.min("p").alias("first"), F.max("p").alias("last"))
    r = r.join(carry(ends, "src", "block", "first", "last"), ["src", "block"])
    w = Window.partitionBy("src", "block").orderBy("t")
    r = r.withColumns({"n": F.lead(F.struct("t", "v")).over(w), "is_first": F.row_number().over(w) == 1})
    r = r.withColumns({"far": F.col("n").isNull(), "n": F.coalesce("n", "after")})

    def increment(a: str, b: str):
        """Between the numbers a and b, b's row being `to` and a's `frm` (structs t, v)."""
        d = F.col(f"{b}.v") - F.col(f"{a}.v")
        if kind == "counter":
            return F.when(d >= 0, d).otherwise(F.col(f"{b}.v"))
        return (F.col(f"{a}.v") + F.col(f"{b}.v")) / 2 * ((F.col(f"{b}.t") - F.col(f"{a}.t")) / 1e6)

    # forward: the row's own cell and all cells up to the next reading, but for those in the next reading's block
    fwd_hi = F.when(F.col("n").isNull(), F.col("cell")).when(
        F.col("far"), F.greatest(F.col("cell"), floordiv(floordiv(F.col("n.t") + half, us), blk) * blk - 1)
    ).otherwise(floordiv(F.col("n.t") + half, us))
    fwd = F.struct(F.struct("t", "v").alias("a"), F.col("n").alias("b"), F.col("cell").alias("lo"), fwd_hi.alias("hi"), F.col("cell").alias("own"))
    back = F.struct(F.col("before").alias("a"), F.struct("t", "v").alias("b"), (F.col("block") * blk).alias("lo"), F.col("cell").alias("hi"), F.lit(None).cast("bigint").alias("own"))
    both = F.when(F.col("is_first") & F.col("before").isNotNull(), F.array(fwd, back)).otherwise(F.array(fwd))
    s = r.select("src", "block", "v", F.explode(both).alias("s")).select("src", "block", F.col("v").alias("own_v"), "s.*")
    s = s.withColumn("covered", F.coalesce(F.col("b.t") - F.col("a.t") <= max_gap_s * 1_000_000, F.lit(False)))
    s = s.select("src", "block", "own", "own_v", "covered", F.col("a.t").alias("at"), F.col("b.t").alias("bt"), increment("a", "b").alias("inc"), (F.col("b.v") < F.col("a.v")).alias("fell"), F.explode(F.sequence("lo", "hi")).alias("cell"))
    lap = F.greatest(F.least(F.col("bt"), F.col("cell") * us + half) - F.greatest(F.col("at"), F.col("cell") * us - half), F.lit(0))
    s = s.withColumn("lap", F.when(F.col("covered"), lap).otherwise(0))
    mine = F.col("own") == F.col("cell")
    g = s.groupBy("src", "block", "cell").agg(
        F.count(F.when(mine, 1)).alias("n_readings"),
        F.avg(F.when(mine, F.col("own_v"))).alias("reading"),
        F.sum(F.when(F.col("lap") > 0, F.col("inc") * F.col("lap") / (F.col("bt") - F.col("at")))).alias("increment"),
        F.sum("lap").alias("lap"),
        F.coalesce(F.max(F.when((F.col("lap") > 0), F.col("fell"))), F.lit(False)).alias("fell"),
    )
    rate = F.col("increment") if kind == "counter" else F.coalesce(F.col("increment") / (F.col("lap") / 1e6), F.col("reading"))
    return g.select(
        F.col("src").alias(source),
        (F.col("cell") * step_s).alias("slot_s"),
        "n_readings",
        "reading",
        "increment",
        (F.col("lap") / us).alias("covered_share"),
        rate.alias("value"),
        (F.col("fell") if kind == "counter" else F.lit(False)).alias("is_reset"),
        F.when(F.col("n_readings") > 0, "read").when(F.col("lap") > 0, "filled").otherwise("uncovered").alias("status"),
    )


def meter_register(df: DataFrame, source: str, time: str, value: str, latest: list[str], digits: int = 8, block_slots: int = 1008) -> DataFrame:
    """(source, time, register): the running total of a source's whole numbers in order of time, as a register of so many digits shows it; it starts again from its remainder when it is full.

    One row per source and time; of several the one greatest by `latest` (value last) is taken. Numbers count from 0 to 1e9, what lies beyond as the nearer of these; rows without source,
    time or number are absent. time comes back as a timestamp in UTC. Empty input gives an empty result.

    Plan: totals run within blocks of time, and a row a block carries them on, so no window holds a source's readings.
    """
    blk = block_slots * 600_000_000
    k = F.struct(*[ref(c).alias(f"k{i}") for i, c in enumerate(latest)], number(ref(value)).alias("v"))
    r = df.select(ref(source).alias("src"), epoch_us(ref(time)).alias("t"), number(ref(value)).alias("v"), k.alias("k")).where("src is not null and t is not null and v is not null")
    r = r.withColumn("block", floordiv(F.col("t"), blk)).repartition("src", "block").groupBy("src", "block", "t").agg(F.max_by("v", "k").alias("v"))
    r = r.withColumn("v", F.round(F.greatest(F.least(F.col("v"), F.lit(1e9)), F.lit(0.0))).cast("bigint"))
    total = r.groupBy("src", "block").agg(F.sum("v").alias("v"))
    before = total.select("src", "block", F.coalesce(F.sum("v").over(Window.partitionBy("src").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    upto = F.sum("v").over(Window.partitionBy("src", "block").orderBy("t"))
    out = r.withColumn("upto", upto).join(before, ["src", "block"])
    return out.select(F.col("src").alias(source), F.timestamp_micros("t").alias(time), ((F.col("upto") + F.col("before")) % 10**digits).cast("double").alias("register"))
