"""Session helpers shared by the operators: cutting lineage in the shared folder and Arrow batch limits."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of one Arrow batch handed to a Python worker; keeps a worker's memory flat whatever the text length.
ARROW_BATCH_BYTES = "8m"


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir. Where that is unset, one of our own on a single machine, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="strataquarry-")
        _folder(spark, found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def _folder(spark: SparkSession, path: str):
    """The folder in its file system, which removes it when the JVM ends, whatever has become of the session."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.deleteOnExit(where)
    return files, where


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that no plan reads any more."""
    files, where = _folder(spark, path)
    files.delete(where, True)


def scratch(spark: SparkSession, kind: str) -> str:
    """A new folder's path in the shared folder, removed at the end."""
    path = f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    _folder(spark, path)
    return path


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, unless the session already asks for something tighter than the default."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b") in ("67108864b", "64MB", "64m"):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH_BYTES)


def cut(df: DataFrame) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends here and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, "cut")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut = path
    return out


def forget(*written: DataFrame) -> None:
    """Delete what cut() wrote for these frames; nothing that is still to run may read them."""
    for df in written:
        remove(df.sparkSession, df._cut)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of plans that a cut() has made obsolete."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of df has it (whatever its case)."""
    return _unused(df.columns, names)


def _unused(columns: list[str], names: Iterable[str]) -> list[str]:
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def splittable(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join that deals both sides anew. After an aggregate on the same keys Spark would otherwise reuse its
    partitioning, and could no longer split a key that holds a large part of the rows."""
    (name,) = _unused([*left.columns, *right.columns], ["parity"])
    parity = F.pmod(F.xxhash64(*keys), F.lit(2))
    return left.withColumn(name, parity).join(right.withColumn(name, parity), [*keys, name], how).drop(name)


def text_key(column: str = "text"):
    """128-bit identity of a text (null reads as empty); equal texts share it, whatever their ids."""
    return F.unhex(F.md5(F.coalesce(F.col(column), F.lit(""))))
