"""Reading tables; zone-less timestamps mean UTC, so the session is put on UTC before anything is analysed."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster, which the session names in spark.checkpoint.dir. Only a session on one machine that names none gets a local one; on a cluster that is an error."""
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isEmpty():
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not named:
            master = spark.sparkContext.master
            if master != "local" and not master.startswith("local["):
                raise RuntimeError("spark.checkpoint.dir names no folder that all executors share")
            named = os.path.join(tempfile.gettempdir(), "gridmend-checkpoints")
        spark.sparkContext.setCheckpointDir(named)
    return jsc.getCheckpointDir().get()
