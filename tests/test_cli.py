import math
from datetime import UTC, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gridmend import cli
from gridmend.plans import daily
from gridmend.sources import files, tables

T0 = datetime(2025, 1, 6, tzinfo=UTC)


def week(path, holes=()):
    rows = ["timestamp,value"]
    for i in range(1008):
        t = (T0 + timedelta(minutes=10 * i)).strftime("%Y-%m-%dT%H:%M:%S+00:00")
        rows.append(f"{t},{'' if i in holes else round(1000 + 300 * math.sin(i / 144 * 2 * math.pi) + i % 7, 2)}")
    Path(path).write_text("\n".join(rows) + "\n")
    return str(path)


def read(spark, folder):
    return [r.asDict() for r in spark.read.csv(str(folder), header=True).orderBy("timestamp").collect()]


def test_week_with_a_test_gap(spark, tmp_path):
    src = week(tmp_path / "w.csv", {0, 1, 300, 301, 302})
    args = ["--input", src, "--output", str(tmp_path / "out"), "--test-gap", "2025-01-08T12:00", "2025-01-08T15:00", "--report", str(tmp_path / "report")]
    assert cli.main(args, spark) == 0
    out = read(spark, tmp_path / "out")
    assert len(out) == 1008 and all(r["value"] and r["quality"] in "0123" for r in out) and out[0]["timestamp"] == "2025-01-06T00:00:00+00:00"
    assert out[0]["quality"] == "3" and out[300]["quality"] == "1" and out[500]["quality"] == "0"
    hidden = [r for r in out if "2025-01-08T11:00" <= r["timestamp"] <= "2025-01-08T14:00:00+00:00"]  # wall-clock time of Paris, both bounds included
    assert len(hidden) == 19 and all(r["quality"] != "0" for r in hidden)
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert lines[0].startswith("# strategy ") and lines[-2:] == ["# n_points 19", "# n_ground_truth 19"] and any(x.startswith("# MAE ") for x in lines)


def test_gaps_outside_and_across_the_window(spark, tmp_path, capsys):
    first, last = T0, T0 + timedelta(minutes=10 * 1007)
    got, warnings = cli.masks([("2025-01-05T00:00+00:00", "2025-01-06T01:00+00:00")], first, last)
    assert got == [(first, T0 + timedelta(hours=1))] and len(warnings) == 1
    with pytest.raises(ValueError):
        cli.masks([("2024-01-05T00:00", "2024-01-06T01:00")], first, last)
    src = week(tmp_path / "w.csv")
    assert cli.main(["--input", src, "--output", str(tmp_path / "o"), "--test-gap", "2025-01-06T00:00+00:00", "2025-02-06T00:00+00:00"], spark) == 2
    assert "leave no number" in capsys.readouterr().err
    (tmp_path / "bad.csv").write_text("timestamp,value\n2025-01-06T00:00:00Z,1\n")
    assert cli.main(["--input", str(tmp_path / "bad.csv"), "--output", str(tmp_path / "o")], spark) == 2


def test_histories_that_are_missing(spark, tmp_path):
    (tmp_path / "h.csv").write_text("Date,Ptot_HA\n2025-01-01 00:00:00,5\n2025-01-01 00:00:00,6\nx,7\n")
    got = files.csv_history(spark, [f"file://{tmp_path}/h.csv", f"file://{tmp_path}/none.csv", str(tmp_path / "h*.csv")], "Ptot_HA").collect()
    assert [r["value"] for r in got] == [6.0] and files.csv_history(spark, [str(tmp_path / "none.csv")], "Ptot_HA").count() == 0


def test_a_cluster_must_name_its_folder(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master, kept = "spark://host:7077", None
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: type("O", (), {"isEmpty": lambda self: True})()})()})()

        def getConf(self):
            return Conf()

    with pytest.raises(RuntimeError):
        tables.checkpoint_dir(type("Spark", (), {"sparkContext": Context()})())


def test_nightly_run_up_to_a_day(spark):
    rows = [(i, 1, T0.replace(tzinfo=None) + timedelta(minutes=10 * i), 1000.0 + i % 50 if i % 97 else None) for i in range(-144 * 80, 144 * 7 + 300)]
    clean = spark.createDataFrame(rows, "reading_id bigint, poste_id int, Date timestamp_ntz, Ptot_HA double").withColumns({c: F.lit(None).cast("double") for c in ("Ptot_HEI", "Ptot_HEI_13RT", "Ptot_HEI_5RNS", "Ptot_RIZOMM")})
    meters, days = spark.createDataFrame([], cli.METERS), spark.createDataFrame([], "cal_date date, kind string")
    w = daily.run(clean, meters, days, target=datetime(2025, 1, 13).date()).windows
    r = w.agg(F.count("*").alias("n"), F.count("value").alias("v"), F.min("slot").alias("a"), F.max("slot").alias("b")).first()
    assert (r["n"], r["v"]) == (1008, 1008) and r["b"] == int(datetime(2025, 1, 12, 23, tzinfo=UTC).timestamp()) // 600 - 1
