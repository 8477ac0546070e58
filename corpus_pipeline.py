"""Corpus pipeline over the documents table: quality, line dedup, near duplicates, decontamination, packing.

Each stage reads its predecessor's Parquet and returns all it keeps; the first four return the columns of documents. Null
texts read as empty; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataquarry.llm import decontam, jaccard, line_dedup, packing, quality
from strataquarry.llm.runtime import remove, scratch, unused

#: The verdicts of learned stages have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the boilerplate lines of their source; n_chars follows the text."""
    kept = line_dedup.without_boilerplate(docs, into=tuple(unused(docs, "lines", "dropped")))
    return kept.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return jaccard.one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    (leaks,) = unused(docs, "leaks")
    marked = decontam.mark_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), into=leaks)
    return marked.where(F.size(leaks) == 0).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard", near_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what one returns is written as Parquet and read again by the next."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        path = scratch(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
