"""Rolling totals over trailing periods, from segment trees (problem 5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmend.functions.cols import epoch_us, floordiv, number, ref

DAY_US = 86_400_000_000
#: A tree covers 2**TOP days of one entity, its time shard; trees are aligned to day 0 = 1970-01-01.
TOP = 6


def daily(df: DataFrame, entity: str, time: str, value: str, latest: list[str]) -> DataFrame:
    """(entity, day, total, n) of the UTC days with a number; of rows with the same entity and time the greatest by `latest` counts.

    Rows without entity, time or number (null, NaN) are absent. One shuffle, by (entity, day).
    """
    r = df.select(ref(entity).alias("entity"), epoch_us(ref(time)).alias("t"), number(ref(value)).alias("v"), F.struct(*[ref(c).alias(f"k{i}") for i, c in enumerate(latest)], number(ref(value)).alias("v")).alias("k"))
    r = r.where("entity is not null and t is not null and v is not null").withColumn("day", floordiv(F.col("t"), DAY_US))
    r = r.repartition("entity", "day").groupBy("entity", "day", "t").agg(F.max_by("v", "k").alias("v"))
    return r.groupBy("entity", "day").agg(F.sum("v").alias("total"), F.count("v").alias("n"))


def build_tree(days: DataFrame) -> DataFrame:
    """Nodes (entity, level, idx, total, n): a node holds the days [idx * 2**level, (idx + 1) * 2**level) of its entity.

    Only nodes above a day with a number exist. Each (entity, idx >> (TOP - level)) is one tree of its own.
    """
    levels = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright("day", k).alias("idx")) for k in range(TOP + 1)]))
    return days.select("entity", "total", "n", levels.alias("x")).groupBy("entity", "x.level", "x.idx").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def correct_tree(nodes: DataFrame, changes: DataFrame) -> DataFrame:
    """nodes after late corrections; changes: (entity, day, total, n) to be added (negative to take away).

    Only the TOP + 1 ancestors of each changed day get another number; all other nodes pass unchanged. A node left with n = 0 goes.
    """
    d = build_tree(changes).withColumnsRenamed({"total": "d_total", "n": "d_n"})
    both = nodes.join(d, ["entity", "level", "idx"], "full")
    return both.select(
        "entity", "level", "idx",
        (F.coalesce("total", F.lit(0.0)) + F.coalesce("d_total", F.lit(0.0))).alias("total"),
        (F.coalesce("n", F.lit(0)) + F.coalesce("d_n", F.lit(0))).alias("n"),
    ).where("n <> 0")


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What correct_tree is to add where the days (entity, day, total, n) of before have become those of after: only days that differ."""
    b = before.withColumnsRenamed({"total": "b_total", "n": "b_n"})
    d = after.join(b, ["entity", "day"], "full")
    total, n = F.coalesce("total", F.lit(0.0)) - F.coalesce("b_total", F.lit(0.0)), F.coalesce("n", F.lit(0)) - F.coalesce("b_n", F.lit(0))
    return d.select("entity", "day", total.alias("total"), n.alias("n")).where("total <> 0 or n <> 0")


def cover(lo: Column, hi: Column) -> Column:
    """The nodes whose days are exactly lo..hi, at most two a level below the top: array<struct<level, idx>>."""
    parts = []
    for k in range(TOP):
        left, right = F.shiftright(lo + ((1 << k) - 1), k), F.shiftright(hi + 1, k)
        node = lambda i, k=k: F.struct(F.lit(k).alias("level"), i.alias("idx"))
        parts.append(F.when((left < right) & (F.pmod(left, F.lit(2)) == 1), node(left)))
        parts.append(F.when((left < right) & (F.pmod(right, F.lit(2)) == 1), node(right - 1)))
    left, right = F.shiftright(lo + ((1 << TOP) - 1), TOP), F.shiftright(hi + 1, TOP)
    top = F.when(left < right, F.transform(F.sequence(left, right - 1), lambda i: F.struct(F.lit(TOP).alias("level"), i.alias("idx"))))
    return F.array_compact(F.concat(F.array(*parts), F.coalesce(top, F.array())))


def calendar(days: DataFrame) -> DataFrame:
    """(entity, day) for every day from an entity's first to its last."""
    span = days.groupBy("entity").agg(F.min("day").alias("a"), F.max("day").alias("b"))
    return span.select("entity", F.explode(F.sequence("a", "b")).alias("day"))


def trailing(nodes: DataFrame, asked: DataFrame, periods: list[int]) -> DataFrame:
    """Range queries: per row (entity, day) of asked the total, count and mean over each trailing period, today included.

    Columns total_P, n_P, mean_P for P in periods; total is 0 and mean null where the period has no number.
    """
    def asks(p: int) -> Column:
        return F.transform(cover(F.col("day") - (p - 1), F.col("day")), lambda x: F.struct(F.lit(p).alias("p"), x["level"].alias("level"), x["idx"].alias("idx")))

    wanted = F.explode(F.concat(*map(asks, periods)))
    q = asked.select("entity", "day", wanted.alias("x")).select("entity", "day", "x.*").join(nodes, ["entity", "level", "idx"], "left")
    aggs = []
    for p in periods:
        has = F.col("p") == p
        aggs += [F.coalesce(F.sum(F.when(has, F.col("total"))), F.lit(0.0)).alias(f"total_{p}"), F.coalesce(F.sum(F.when(has, F.col("n"))), F.lit(0)).alias(f"n_{p}")]
    out = q.groupBy("entity", "day").agg(*aggs)
    return reduce(lambda d, p: d.withColumn(f"mean_{p}", F.when(F.col(f"n_{p}") > 0, F.col(f"total_{p}") / F.col(f"n_{p}"))), periods, out)


def rolling_totals(df: DataFrame, entity: str, time: str, value: str, latest: list[str], periods: tuple[int, ...] = (7, 30)) -> DataFrame:
    """Per entity and UTC day, from its first to its last day with a number, the totals and means over the trailing periods.

    Days without a number are included (n_day = 0); zero is a number; an infinite number makes its totals infinite. Empty input gives an empty
    result; extra columns, whatever their names, are ignored. Columns: entity, day_utc, n_day, total_P, n_P, mean_P.
    """
    days = daily(df, entity, time, value, latest)
    return answers(build_tree(days), days, entity, periods)


def answers(nodes: DataFrame, days: DataFrame, entity: str, periods: tuple[int, ...]) -> DataFrame:
    """The result of rolling_totals from the trees and the days with a number."""
    # a period of one day is the leaf itself and tells whether the day has a number
    out = trailing(nodes, calendar(days), [1, *periods])
    cols = [c for p in periods for c in (f"total_{p}", f"n_{p}", f"mean_{p}")]
    return out.select(F.col("entity").alias(entity), F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.col("day").cast("int")), "yyyy-MM-dd").alias("day_utc"), F.col("n_1").alias("n_day"), *cols)
