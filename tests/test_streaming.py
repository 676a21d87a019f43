import os
from datetime import date

from gridmend.streaming.online import upsert_days


def test_only_touched_days_are_written_again(spark, tmp_path):
    src, out = "poste_id int, slot bigint, day date, value double", str(tmp_path / "table")

    def feed(name, rows):
        spark.createDataFrame(rows, src).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        upsert_days(spark.readStream.schema(src).parquet(str(tmp_path / "in")), out, ["poste_id", "slot", "day"], "day", str(tmp_path / "cp")).awaitTermination()

    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    feed("a", [(1, 1, d1, 1.0), (1, 2, d1, 2.0), (1, 3, d2, 3.0)])
    files = lambda d: sorted(os.listdir(f"{out}/day={d}"))
    before = files(d1)
    feed("b", [(1, 3, d2, 30.0), (2, 9, d2, 9.0)])
    rows = sorted(tuple(r) for r in spark.read.schema(src).parquet(out).select("poste_id", "slot", "value").collect())
    assert rows == [(1, 1, 1.0), (1, 2, 2.0), (1, 3, 30.0), (2, 9, 9.0)] and files(d1) == before
