"""Small column helpers used by every operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ref(name: str) -> Column:
    """A column by its literal name, also where the name holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def number(c: Column) -> Column:
    """A double in which NaN has become null; infinities stay."""
    d = c.cast("double")
    return F.when(~F.isnan(d), d)


def epoch_us(c: Column) -> Column:
    """Microseconds since 1970 UTC of a timestamp (a zone-less one is taken as UTC)."""
    return F.unix_micros(c.cast("timestamp"))


def floordiv(c: Column, by: int) -> Column:
    """Integer division that rounds down for negative numbers as well; exact up to 2**53 quotients."""
    return ((c - F.pmod(c, F.lit(by))) / F.lit(by)).cast("bigint")


def fixed(c: Column | str, digits: int) -> Column:
    """Rounded to digits; a nudge of a ten-thousandth of the last digit first, so that ties fall alike in every engine."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + 10.0 ** -(digits + 4), digits)


def free_name(df: DataFrame, *wanted: str) -> list[str]:
    """Names that clash with no column of df (compared without case, as Spark does)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
