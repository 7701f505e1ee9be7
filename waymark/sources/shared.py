"""Folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_BATCH_BYTES = 8 << 20

def scratch(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder; a local one where none is set and all tasks run on this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="waymark-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 8 MB, or of one row that is larger, in this session, unless it asks for less."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).rstrip("b")
    if not now.isdigit() or int(now) > _BATCH_BYTES:
        spark.conf.set(name, str(_BATCH_BYTES))


def stored(df: DataFrame, folder: str) -> DataFrame:
    """df written to a folder and read from there, so that no use of it computes it again."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
