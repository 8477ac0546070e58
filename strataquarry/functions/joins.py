"""Joins that neither a hot key nor a wrong estimate holds up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def splittable(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equi-join that deals both sides by one column more than the keys. Beside an aggregate of the same keys Spark would keep that
    one's partitioning, and adaptive execution could not split the key that holds a large part of the rows."""
    name = "_dealt"
    while name in {c.lower() for c in (*left.columns, *right.columns)}:
        name += "_"
    half = F.pmod(F.xxhash64(*keys), F.lit(2))
    return left.withColumn(name, half).join(right.withColumn(name, half), [*keys, name], how).drop(name)


def dealt(right: DataFrame) -> DataFrame:
    """A join's side that is shuffled and never broadcast. Spark estimates a side by its files, but one that is exploded or made of texts
    is many times larger, and a broadcast of it passes through the driver whole."""
    return right.hint("merge")
