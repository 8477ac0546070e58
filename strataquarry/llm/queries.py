"""Queries over the driver tables, one for each operator, at production parameters and over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import substring_dedup

    return substring_dedup(_table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find_personal_data

    return find_personal_data(_table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(_table(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import digests, format_conversations, hostile

    return digests(format_conversations(hostile(_table(spark, sf_dir, "conversations"))))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import jaccard_join

    return jaccard_join(_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import mark_leaks

    marked = mark_leaks(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"), with_text=False)
    items = F.array_sort(F.array_distinct(F.transform("_leaks", lambda x: x["item_id"])))
    return marked.select("doc_id", (F.size("_leaks") > 0).alias("contaminated"), F.size(items).cast("long").alias("n_items"), F.array_join(items.cast("array<string>"), ",").alias("item_ids"), F.array_min(F.transform("_leaks", lambda x: x["distance"])).cast("long").alias("least_edits"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import without_boilerplate

    kept = without_boilerplate(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return kept.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan_licenses

    return scan_licenses(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score_toxicity

    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality_rules

    return quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .resampling import resample

    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .centroids import cluster_vectors

    return cluster_vectors(_table(spark, sf_dir, "embeddings"))


def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold no list of URLs: listed are those of pages whose host names one of these trades."""
    from .urls import host_of, judge_urls

    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where(host_of(F.col("url")).rlike(r"(^|[.-])(adult|ads|bets|casino|pills|spam)([.-]|\z)")).select("url")
    return judge_urls(pages, listed)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_substring_dedup, op2_pii, op3_packing, op4_chat, op5_jaccard_join, op6_decontamination, op7_line_dedup, op8_licenses, op9_quality_rules, op10_toxicity, op11_resampling, op12_centroids, op13_urls)}


def oracle_sql() -> dict[str, str]:
    from .oracles import ORACLES

    return dict(ORACLES)
