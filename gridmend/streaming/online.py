"""Streaming front: readings into ten-minute slots with a watermark, and late batches upserted by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridmend.functions.cols import number


def slots(stream: DataFrame, time: str = "Date", value: str = "Ptot_HA", late: str = "2 hours") -> DataFrame:
    """(poste_id, slot_start, n, value): mean number per station and slot; a slot is given out once the watermark has passed it."""
    t = stream.select("poste_id", F.col(time).cast("timestamp").alias("ts"), number(F.col(value)).alias("v")).where("v is not null")
    g = t.withWatermark("ts", late).groupBy("poste_id", F.window("ts", "10 minutes").alias("w")).agg(F.count("*").alias("n"), F.avg("v").alias("value"))
    return g.select("poste_id", F.col("w.start").alias("slot_start"), "n", "value")


def upsert_batches(stream: DataFrame, read: Callable[[], DataFrame], write: Callable[[DataFrame], None], keys: list[str], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Merges each micro-batch into a keyed table; a batch that is replayed leaves the same table."""
    from gridmend.operators.audit import upsert

    def merge(batch: DataFrame, _: int) -> None:
        write(upsert(read(), batch, keys))

    w = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()


def upsert_days(stream: DataFrame, path: str, keys: list[str], day: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Merges each micro-batch into the parquet table at path, which is kept in folders by the column day (one of the keys).

    Only the days that a batch touches are read and written again (dynamic partition overwrite), whatever the table's size; a batch that is replayed leaves the same table.
    Of several rows of a batch with the same keys any one counts.
    """
    from gridmend.operators.audit import upsert
    from gridmend.sources.files import exists

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates(keys)
        if exists(spark, f"{path}/{day}=*"):
            days = [r[0] for r in new.select(day).distinct().collect()]  # those of one batch
            old = spark.read.schema(new.schema).parquet(path).where(F.col(day).isin(days))
            new = upsert(old, new, keys).select(*new.columns)
        new.write.partitionBy(day).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)

    w = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()
