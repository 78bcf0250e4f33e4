"""Intermediate tables of jobs in several stages, on storage that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_scratch(spark: SparkSession) -> str:
    """A new folder on the storage that all executors share, removed when the session's JVM ends.

    That is where the session checkpoints, or else its warehouse.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    shared = shared or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{shared.rstrip('/')}/chartmill-{uuid.uuid4().hex}"
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def written(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder and read from there.

    What follows does not compute them again, neither when they are read twice nor when an executor is lost.
    """
    folder = f"{shared_scratch(df.sparkSession)}/table"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
