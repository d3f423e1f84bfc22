"""Tables in the shared folder that ``spark.checkpoint.dir`` names: where a plan would be run several times."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared(spark: SparkSession, name: str) -> str:
    """A new path in the application's part of the shared folder; under /tmp in local mode only (tests)."""
    return f"{_own(spark)}/{name}-{uuid.uuid4().hex}"


def _own(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file:///tmp/quantloom-shared"
    return f"{base.rstrip('/')}/quantloom/{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Delete the application's intermediate tables; results that were not written yet are lost."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own(spark))
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table, read back: what follows may use it often, and survives lost executors."""
    path = shared(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
