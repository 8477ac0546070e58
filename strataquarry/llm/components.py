"""Connected components by alternating large-star and small-star steps, each a map and a combinable minimum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import cut, forget, splittable


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of edges(a, b); label is the component's smallest node. Nulls are no nodes."""
    e = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = cut(e)
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = splittable(both, least, ["u"]).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = splittable(large, low, ["u"]).where(F.col("v") != F.col("low")).select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = small.unionByName(low.select("u", F.col("low").alias("v"))).where("u <> v")
        last, e = e, cut(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        forget(last)
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    out = e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
    out._cut = e._cut
    return out
