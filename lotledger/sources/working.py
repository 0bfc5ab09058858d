"""Tables that a job writes for itself, in a folder that driver and executors share."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def working_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``. A session on one machine that does not name one
    uses the warehouse; on a cluster that may be each machine's own disk, so it is refused."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/ingest-{uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written once and read from there: later uses see the same rows, whatever
    executor is lost, and do not compute them again."""
    path = working_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
