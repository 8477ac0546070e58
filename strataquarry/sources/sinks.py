"""Sinks: staged publication, appends, upserts, single-document export."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def publish(df: DataFrame, path: str, fmt: str = "parquet", validate=None) -> None:
    """Write beside the target, let validate(DataFrame) look at what was written, then swap by rename; the old version comes back if the swap fails."""
    spark, tag = df.sparkSession, uuid.uuid4().hex
    staged, backup = f"{path}.staged-{tag}", f"{path}.backup-{tag}"
    df.write.format(fmt).save(staged)
    if validate:
        validate(spark.read.format(fmt).schema(df.schema).load(staged))
    fs, target = _fs(spark, path)
    of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    had = fs.exists(target)
    if had:
        fs.rename(target, of(backup))
    if not fs.rename(of(staged), target):
        if had:
            fs.rename(of(backup), target)
        raise OSError(f"could not publish {path}")
    if had:
        fs.delete(of(backup), True)


def append(df: DataFrame, path: str, fmt: str = "json") -> None:
    df.write.format(fmt).mode("append").save(path)


def export_lines(df: DataFrame, path: str, order: list[str]) -> None:
    """JSON lines in one sorted file, keys in the order of names; for small emitted records only."""
    df.select(*sorted(df.columns)).repartitionByRange(1, *order).sortWithinPartitions(*order).write.mode("overwrite").json(path)


def last_wins(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Insert-or-replace: for each key the row that came last. One combinable aggregate, no sort of a hot key."""
    pick = F.max_by(F.struct(*(c for c in df.columns if c not in keys)), F.struct(*order))
    return df.groupBy(*keys).agg(pick.alias("_r")).select(*keys, "_r.*").select(*df.columns)


def first_wins(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Insert-or-ignore: for each key the row that came first."""
    pick = F.min_by(F.struct(*(c for c in df.columns if c not in keys)), F.struct(*order))
    return df.groupBy(*keys).agg(pick.alias("_r")).select(*keys, "_r.*").select(*df.columns)


def numbered(df: DataFrame, keys: list[str], order: list[Column], out: str = "rank") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def withdraw(existing: DataFrame, shipped: DataFrame, key: str) -> DataFrame:
    """Rows of a former emission that the present one no longer ships."""
    return existing.join(shipped.select(key), key, "left_anti")


def task_records(tasks: DataFrame) -> DataFrame:
    """(id, targets_txt, record) of tasks(task_id, source, title, instruction, primary_module, modules, verifier_files, targets,
    command): what a task's folder is written from. record is JSON with keys in the order of names."""
    none = F.array().cast("array<string>")
    listed = lambda c: F.coalesce(F.col(c), none)
    below = lambda what: F.concat("task_id", F.lit(f"/{what}"))
    verifier = F.struct(listed("command").alias("command"), F.array_join(listed("command"), " ").alias("command_line"), listed("verifier_files").alias("files"), listed("targets").alias("node_ids"))
    paths = F.struct(below("evidence").alias("evidence"), below("goldenSolution.diff").alias("golden_diff"), below("goldenSolution.md").alias("golden_solution"), below("input").alias("input"), below("solution").alias("solution"), below("verifier").alias("verifier"))
    record = F.struct(F.col("task_id").alias("id"), "instruction", listed("modules").alias("modules"), paths.alias("paths"), "primary_module", "source", "title", verifier.alias("verifier"))
    return tasks.select(F.col("task_id").alias("id"), F.concat(F.array_join(listed("targets"), "\n"), F.lit("\n")).alias("targets_txt"), F.to_json(record).alias("record"))


def rebuild_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Register the evidence tables and the derived bridges over them; always a full rebuild."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    if {"coverage", "symbols", "files"} <= set(tables):
        spark.sql("CREATE OR REPLACE TEMP VIEW test_modules AS SELECT DISTINCT c.test_id, f.module FROM coverage c JOIN symbols s ON s.id = c.symbol_id JOIN files f ON f.path = s.path WHERE f.module IS NOT NULL")
