"""The query catalogue: every registered query with its DuckDB counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import checks, gating, intake, lookups, ranking, relational, structure, textual
from .tables import Tables

ALL = {**relational.Q, **ranking.Q, **gating.Q, **textual.Q, **intake.Q, **structure.Q, **checks.Q, **lookups.Q}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, f=f: f(Tables(spark, sf_dir))) for name, (f, _) in ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ALL.items() if sql}
