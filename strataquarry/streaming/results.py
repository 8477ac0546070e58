"""Case results and events as Structured Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(path)


def deduplicated(results: DataFrame, time: str = "reported_at", late: str = "1 hour") -> DataFrame:
    """Each (task, run, test) once within the watermark: re-sent reports do not count twice and state stays bounded."""
    return results.withWatermark(time, late).dropDuplicatesWithinWatermark(["task_id", "run", "test_id"])


def class_counts(results: DataFrame, time: str = "reported_at", window: str = "5 minutes", late: str = "1 hour") -> DataFrame:
    """Failure classes by window, emitted once a window is closed."""
    return results.withWatermark(time, late).groupBy(F.window(time, window), "failure_class").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "failure_class", "n")


def append_jsonl(stream: DataFrame, path: str, checkpoint: str):
    """Exactly-once append of a stream as JSON lines."""
    return stream.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def upsert(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str], buckets: int = 64):
    """Insert-or-replace of each batch into a table: last row of a key wins. The table is partitioned by a hash of the keys
    (_bucket), and a batch reads and replaces only the buckets it has rows for. A batch that is run again changes nothing."""
    from ..functions.lineage import cut
    from ..sources import sinks

    def apply(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        batch = batch.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        touched = [r[0] for r in batch.select("_bucket").distinct().collect()]  # at most `buckets`
        try:
            old = spark.read.schema(batch.schema).parquet(path)
            old.take(1)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            old = batch.where("false")
        merged = cut(sinks.last_wins(old.where(F.col("_bucket").isin(touched)).unionByName(batch), keys, order))
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(path)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
