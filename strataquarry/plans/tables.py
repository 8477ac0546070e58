"""Driver tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """Attribute access to the Parquet tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


class Catalogue(dict):
    """name -> (function of Tables, DuckDB SQL or None)."""

    def add(self, sql: str | None):
        def register(f):
            self[f.__name__] = (f, sql)
            return f

        return register
