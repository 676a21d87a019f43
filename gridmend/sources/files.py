"""Sources and sinks: tables by partition name, CSV windows and histories, templates, audit files, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridmend.functions.cols import number
from gridmend.operators.series import KEY, WEEK


def scan(spark: SparkSession, path: str, name: str | None = None, drop: tuple[str, ...] = ("Quality",), fmt: str = "parquet", **options: str) -> DataFrame:
    """A table of any format Spark reads, one partition name of it if given (pushed to the scan); an error if nothing is left."""
    t = spark.read.format(fmt).options(**options).load(path)
    if name is not None:
        t = t.where(F.col("name") == name)
    if t.isEmpty():
        raise ValueError(f"no rows for {name!r} in {path}")
    return t.drop(*drop)


def csv_window(spark: SparkSession, path: str, rows: int = WEEK, step_s: int = 600, tolerance_s: int = 1) -> DataFrame:
    """(timestamp, ts, value) of a CSV window, the stamps kept as written; raises ValueError with what is wrong with it.

    Right are exactly `rows` rows with readable, strictly increasing stamps `step_s` apart (within tolerance_s), and a number somewhere.
    """
    t = spark.read.csv(path, header=True)
    if lacking := {"timestamp", "value"} - set(t.columns):
        raise ValueError(f"columns missing: {sorted(lacking)}")
    t = t.select("timestamp", F.try_to_timestamp("timestamp").alias("ts"), number(F.expr("try_cast(value AS DOUBLE)")).alias("value"), F.monotonically_increasing_id().alias("n"))
    d = F.unix_micros("ts") - F.unix_micros(F.lag("ts").over(Window.orderBy("n")))  # one file of one week
    s = t.withColumn("d", d).agg(
        F.count("*").alias("rows"), F.count_if(F.col("ts").isNull()).alias("unread"), F.count("value").alias("numbers"),
        F.count_if(F.col("d") <= 0).alias("backward"), F.count_if(F.abs(F.col("d") - step_s * 1_000_000) > tolerance_s * 1_000_000).alias("uneven"),
    ).first()
    for bad, what in ((s["rows"] != rows, f"{s['rows']} rows, not {rows}"), (s["unread"], "unreadable stamps"), (not s["numbers"], "no number"), (s["backward"], "stamps that don't increase"), (s["uneven"], "steps off the grid")):
        if bad:
            raise ValueError(what)
    return t.drop("n")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or anything that its pattern matches, is there, asked of the file system that it names (or the session's default one)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def csv_history(spark: SparkSession, paths: list[str], column: str) -> DataFrame:
    """(ts, value) of several CSV files with Date and the column; of a time in several rows the last file's last row counts. Missing files are skipped, whatever file system their paths name."""
    parts = [spark.read.csv(p, header=True).select(F.try_to_timestamp("Date").alias("ts"), number(F.expr(f"try_cast(`{column}` AS DOUBLE)")).alias("value"), F.struct(F.lit(i).alias("f"), F.monotonically_increasing_id().alias("n")).alias("o")) for i, p in enumerate(paths) if exists(spark, p)]
    if not parts:
        return spark.createDataFrame([], "ts timestamp, value double")
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.where("ts is not null and value is not null").groupBy("ts").agg(F.max_by("value", "o").alias("value"))


def write_csv(result: DataFrame, path: str) -> None:
    """(timestamp, value, quality) of a reconstruction, replacing what was there."""
    result.select("timestamp", "value", "quality").write.mode("overwrite").csv(path, header=True)


def write_audit(records: DataFrame, folder: str, run_id: str) -> None:
    records.write.mode("overwrite").text(f"{folder}/imputation_audit_{run_id}.json")


def save_templates(templates: dict[str, DataFrame], folder: str) -> None:
    for name, t in templates.items():
        t.write.mode("overwrite").parquet(f"{folder}/{name}")


def load_templates(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}


def write_report(points: DataFrame, metrics: DataFrame, lines: DataFrame, folder: str) -> None:
    """A test report as three tables: points, metrics and the strategies of the masked stretches."""
    for name, t in (("points", points), ("metrics", metrics), ("strategies", lines)):
        t.orderBy(*KEY).write.mode("overwrite").csv(f"{folder}/{name}", header=True)
