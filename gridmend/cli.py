"""Command line: one week's CSV in, the reconstructed week out, with test gaps and a report if asked for.

    python -m gridmend.cli --input week.csv --output out --column Ptot_HA [--history a.csv b.csv] [--calendar days.parquet] [--test-gap 2025-01-03T10:00 2025-01-03T16:00] [--report report]
"""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmend.operators import fills, series
from gridmend.plans.daily import parse_gap
from gridmend.plans.engine import Reconstruction, reconstruct
from gridmend.sources.files import csv_history, csv_window, write_csv

METERS = "site string, parent string, children array<string>, tier string"


def masks(gaps: list[tuple[str, str]], first: datetime, last: datetime, tz: str = "Europe/Paris") -> tuple[list[tuple[datetime, datetime]], list[str]]:
    """Test gaps as instants in UTC, both bounds included, and warnings. Bounds without an offset are wall-clock time of tz.

    A gap that goes beyond the window is cut to it, with a warning; one wholly outside raises ValueError. first and last: the window's, in UTC.
    """
    out, warnings = [], []
    for start, end in gaps:
        a, b = (x.replace(tzinfo=ZoneInfo(tz)) if x.tzinfo is None else x for x in parse_gap(start, end))
        a, b = a.astimezone(UTC), b.astimezone(UTC)
        if b < first or a > last:
            raise ValueError(f"test gap {start} to {end} lies outside the window")
        if a < first or b > last:
            warnings.append(f"test gap {start} to {end} cut to the window")
        out.append((max(a, first), min(b, last)))
    return out, warnings


def masked(window: DataFrame, gaps: list[tuple[datetime, datetime]]) -> DataFrame:
    """The window (timestamp, ts, value) with truth, the value as read, masked, and value null where a gap lies; ValueError if nothing else is left."""
    hit = F.lit(False)
    for a, b in gaps:
        hit = hit | F.col("ts").between(F.lit(a), F.lit(b))
    w = window.withColumns({"truth": F.col("value"), "masked": hit}).withColumn("value", F.when(~F.col("masked"), F.col("value")))
    if gaps and w.where("value is not null").isEmpty():
        raise ValueError("the test gaps leave no number")
    return w


def repair(w: DataFrame, history: DataFrame, days: DataFrame, column: str) -> tuple[DataFrame, Reconstruction]:
    """(timestamp, ts, truth, masked, value, quality): the week without an empty cell. What lies before its first or after its last reading, history included, gets the median, flag 3."""
    spark = w.sparkSession
    both = w.select("ts", "value").unionByName(history.join(w.select("ts"), "ts", "left_anti").select("ts", "value"))
    other = [F.lit(None).cast("double").alias(c) for c in series.SITES if c != column]
    clean = both.select(F.monotonically_increasing_id().alias("reading_id"), F.lit(0).alias("poste_id"), F.col("ts").alias("Date"), F.col("value").alias(column), *other)
    done = reconstruct(clean, spark.createDataFrame([], METERS), days)
    slot = F.floor((F.unix_micros("ts") + series.STEP_US // 2) / series.STEP_US)
    v = done.values.where(F.col("site") == column).select(F.col("slot").alias("_slot"), F.col("value").alias("_value"), "quality")
    med = fills.medians(series.readings(clean)).where(F.col("site") == column).select("med").first()
    out = w.withColumn("_slot", slot).join(v, "_slot", "left")
    return out.select("timestamp", "ts", "truth", "masked", F.coalesce("_value", F.lit(med["med"] if med else 0.0)).alias("value"), F.coalesce("quality", F.lit(3)).alias("quality")), done


def report_lines(out: DataFrame, gaps: DataFrame, column: str) -> list[str]:
    """The test report: a line for each strategy that met the masked stretch, the masked points, and the errors. One week at most, so a list."""
    bounds = out.where("masked").agg((F.floor(F.unix_seconds(F.min("ts")) / 600)).alias("a"), (F.floor(F.unix_seconds(F.max("ts")) / 600)).alias("b")).first()
    met = gaps.where((F.col("site") == column) & (F.col("gap_start") <= bounds["b"]) & (F.col("gap_end") > bounds["a"])).orderBy("gap_start").collect() if bounds["a"] is not None else []
    rows = out.where("masked").orderBy("ts").collect()
    err = [abs(r["value"] - r["truth"]) for r in rows if r["truth"] is not None]
    head = [f"# strategy {g['strategy']} slots {g['gap_start']}-{g['gap_end'] - 1} confidence {g['confidence']}" for g in met]
    body = [",".join("" if x is None else str(x) for x in (r["timestamp"], r["truth"], r["value"], r["quality"], None if r["truth"] is None else round(abs(r["value"] - r["truth"]), 6))) for r in rows]
    mae, rmse, top = (sum(err) / len(err), (sum(e * e for e in err) / len(err)) ** 0.5, max(err)) if err else ("", "", "")
    return [*head, "timestamp,ground_truth,imputed,quality,abs_error", *body, f"# MAE {mae}", f"# RMSE {rmse}", f"# max_err {top}", f"# n_points {len(rows)}", f"# n_ground_truth {len(err)}"]


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="gridmend", description=__doc__.splitlines()[0])
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--column", default="Ptot_HA", choices=series.SITES)
    p.add_argument("--history", nargs="*", default=[])
    p.add_argument("--calendar", help="a table with cal_date and kind")
    p.add_argument("--test-gap", nargs=2, action="append", default=[], metavar=("START", "END"))
    p.add_argument("--report", help="folder of the test report; needs a test gap")
    a = p.parse_args(argv)
    spark = spark or SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        w = csv_window(spark, a.input)
        edge = w.agg(F.unix_micros(F.min("ts")).alias("a"), F.unix_micros(F.max("ts")).alias("b")).first()
        first, last = (datetime.fromtimestamp(edge[k] / 1e6, UTC) for k in "ab")
        gaps, warnings = masks(a.test_gap, first, last)
        w = masked(w, gaps)
    except ValueError as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    for x in warnings:
        print(f"warning: {x}", file=sys.stderr)
    days = spark.read.parquet(a.calendar) if a.calendar else spark.createDataFrame([], "cal_date date, kind string")
    out, done = repair(w, csv_history(spark, a.history, a.column), days, a.column)
    write_csv(out.orderBy("ts"), a.output)
    if a.report and gaps:
        spark.createDataFrame([(x,) for x in report_lines(out, done.gaps, a.column)], "line string").coalesce(1).write.mode("overwrite").text(a.report)
    return 0


if __name__ == "__main__":
    sys.exit(main())
