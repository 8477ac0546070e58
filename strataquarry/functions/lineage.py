"""Cutting lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; where it is unset, one of our own on a single machine, else an error."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='strataquarry-')}"
        sc.setCheckpointDir(found)
    return found


def scratch(spark: SparkSession) -> str:
    """A new folder's path in the shared folder; its file system removes it when the JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    if not df.sparkSession.sparkContext.getCheckpointDir():
        df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def land(df: DataFrame) -> DataFrame:
    """df written as Parquet in the shared folder and read again. Unlike a checkpoint it also forgets what Catalyst has inferred
    about its columns, which in loops of joins over renamed columns doubles with every round."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
