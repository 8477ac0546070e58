"""Import facts and audits against declared and locked names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import graph as G

ANCHORS = 5


def import_facts(imports: DataFrame, files: DataFrame, stdlib: tuple[str, ...] = G.STDLIB) -> DataFrame:
    """One row a top-level module: kind, test_only, always_guarded, guards, first anchors, bucket. Relative imports are none."""
    rows = G.absolute_imports(imports.where("level = 0"), files).join(files.select("path", F.col("is_test").alias("_t")), "path")
    top = F.substring_index(F.when(F.coalesce("absolute", F.lit("")) != "", F.col("absolute")).otherwise(F.col("bound_name")), ".", 1)
    own = files.where("module is not null").select(F.substring_index("module", ".", 1).alias("top"), F.lit(True).alias("own")).distinct()
    rows = rows.withColumn("top", top).where("top <> ''").join(own, "top", "left")
    kind = F.when(F.col("own"), "internal").when(F.col("top").isin(*stdlib), "stdlib").otherwise("third_party")
    return facts(rows.withColumn("kind", kind).withColumn("anchor", F.concat_ws(":", "path", "line")), ["top", "kind"], "_t", "guard", "anchor", ["path", "ordinal"])


def facts(rows: DataFrame, keys: list[str], test: str, guard: str, anchor: str, order: list[str]) -> DataFrame:
    """The roll-up itself: all tests, all guarded, distinct guards, the first few anchors in order."""
    first = F.transform(F.slice(F.sort_array(F.collect_list(F.struct(*order, F.col(anchor).alias("_a")))), 1, ANCHORS), lambda x: x["_a"])
    per = rows.groupBy(*keys).agg(F.bool_and(test).alias("test_only"), F.bool_and(F.col(guard).isNotNull()).alias("always_guarded"), F.sort_array(F.collect_set(guard)).alias("guards"), first.alias("anchors"))
    return per.withColumn("bucket", F.when(F.col("always_guarded"), "optional").when(F.col("test_only"), "test").otherwise("runtime"))


def name_audit(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(left without right, right without left) of names, compared as distributions."""
    a, b = left.select("name", T.package_name(F.col("name")).alias("k")), right.select("name", T.package_name(F.col("name")).alias("k"))
    return a.join(b, "k", "left_anti").select("name").distinct(), b.join(a, "k", "left_anti").select("name").distinct()
