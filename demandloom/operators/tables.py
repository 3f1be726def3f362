"""Tables that operators write between costly steps, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Only a local session, which has no other machine, gets a folder of its own where none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="demandloom-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it back: what follows neither computes it again nor depends on the executors that did."""
    path = f"{shared_folder(df.sparkSession)}/demandloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
