"""Neighbours in time for sources of any size.

A window over a whole source would put a hot source into one task. Here every source is cut into blocks of time; windows
run within a block, and a table of block ends (one row a block) carries the nearest reading across block borders. That
table is itself cut into super-blocks, so its windows stay small too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmend.functions.cols import floordiv

FANOUT = 1024


def carry(ends: DataFrame, source: str | list[str], block: str, first: str, last: str, fanout: int = FANOUT) -> DataFrame:
    """ends: one row per (source, block) with any columns `first` and `last`; source is one column or several.

    Returns (source, block, before, after): the nearest earlier `last` and the nearest later `first` that isn't null, null at
    the ends of a source.
    """
    src = [source] if isinstance(source, str) else source
    e = ends.select(*src, block, first, last, floordiv(F.col(block), fanout).alias("_super"))
    inner = Window.partitionBy(*src, "_super").orderBy(block)
    upto, after = (Window.unboundedPreceding, -1), (1, Window.unboundedFollowing)
    e = e.withColumns({"_b": F.last(last, True).over(inner.rowsBetween(*upto)), "_a": F.first(first, True).over(inner.rowsBetween(*after))})
    tops = e.groupBy(*src, "_super").agg(F.min_by(first, F.when(F.col(first).isNotNull(), F.col(block))).alias("_f"), F.max_by(last, F.when(F.col(last).isNotNull(), F.col(block))).alias("_l"))
    outer = Window.partitionBy(*src).orderBy("_super")
    tops = tops.select(*src, "_super", F.last("_l", True).over(outer.rowsBetween(*upto)).alias("_tb"), F.first("_f", True).over(outer.rowsBetween(*after)).alias("_ta"))
    return e.join(tops, [*src, "_super"]).select(
        *src, block, F.coalesce("_b", "_tb").alias("before"), F.coalesce("_a", "_ta").alias("after")
    )
