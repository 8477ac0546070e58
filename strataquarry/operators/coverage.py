"""Coverage: lines to symbols, breadth ceilings, excision bands."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric as N


def innermost(lines: DataFrame, spans: DataFrame, keys: list[str], at: str = "line", low: str = "line", high: str = "end_line", order: list[str] | None = None, bucket: int = 64) -> DataFrame:
    """lines joined with the shortest span of the same keys that holds `at`; ties go to the later `order`.

    Spans are dealt to fixed-width buckets, so the range condition runs inside an equi-join and no span meets far lines. Lines
    are a set here: equal rows come out once.
    """
    b = spans.withColumn("_b", F.explode(F.sequence(F.floor(F.col(low) / bucket), F.floor(F.col(high) / bucket))))
    b = b.select(*keys, "_b", F.col(low).alias("_lo"), F.col(high).alias("_hi"), F.struct(*[c for c in spans.columns if c not in keys]).alias("_span"), *[F.col(c).alias(f"_o_{c}") for c in order or []])
    hit = lines.withColumn("_b", F.floor(F.col(at) / bucket)).join(b, [*keys, "_b"]).where((F.col(at) >= F.col("_lo")) & (F.col(at) <= F.col("_hi")))
    best = F.min_by("_span", F.struct((F.col("_hi") - F.col("_lo")).alias("w"), *[(-F.col(f"_o_{c}")).alias(c) for c in order or []]))
    rest = [c for c in lines.columns if c not in keys]
    return hit.groupBy(*keys, *rest).agg(best.alias("span"))


def enclosing(lines: DataFrame, spans: DataFrame, bucket: int = 64) -> DataFrame:
    """Every span that holds a line, for reports that credit all of them."""
    b = spans.withColumn("_b", F.explode(F.sequence(F.floor(F.col("line") / bucket), F.floor(F.col("end_line") / bucket)))).select("path", "_b", "id", F.col("line").alias("_lo"), "end_line")
    return lines.withColumn("_b", F.floor(F.col("line") / bucket)).join(b, ["path", "_b"]).where("line between _lo and end_line").select("path", "line", "test_id", F.col("id").alias("symbol_id"))


def attribute(lines: DataFrame, symbols: DataFrame) -> DataFrame:
    """(symbol_id, line, test_id) of coverage lines; the innermost symbol owns a line."""
    owners = innermost(lines.select("path", "line").distinct(), symbols.where("kind <> 'module'").select("path", "id", "line", "end_line", "ordinal"), ["path"], order=["ordinal"])
    return lines.join(owners.select("path", "line", F.col("span.id").alias("symbol_id")), ["path", "line"]).select("symbol_id", "line", "test_id")


def covered_symbols(lines: DataFrame, symbols: DataFrame) -> DataFrame:
    """One row a symbol with body, covered lines, tests, ceiling, ratio, possible, ready and focus score."""
    owned = attribute(lines, symbols)
    per = owned.groupBy("symbol_id").agg(F.count_distinct("line").alias("covered_lines"), F.sort_array(F.collect_set("test_id")).alias("covering_tests"))
    total = lines.agg(F.count_distinct("test_id").alias("_tests"))
    rows = symbols.where("kind <> 'module'").join(per, F.col("id") == F.col("symbol_id"), "left").crossJoin(F.broadcast(total))
    tests = F.coalesce(F.size("covering_tests"), F.lit(0))
    rows = rows.select("id", "path", "kind", "qualified_name", (F.col("end_line") - F.col("line") + 1).alias("body_lines"), F.coalesce("covered_lines", F.lit(0)).alias("covered_lines"), F.coalesce("covering_tests", F.array().cast("array<string>")).alias("covering_tests"), (F.coalesce("docstring", F.lit("")) != "").alias("has_docstring"), "is_test", F.when(tests < 0, 0).otherwise(tests).alias("tests"), N.ceiling_of(F.col("_tests")).alias("ceiling"))
    rows = rows.withColumn("ratio", N.coverage_ratio(F.col("covered_lines"), F.col("body_lines")))
    return band(rows)


def band(rows: DataFrame) -> DataFrame:
    """possible, ready, focus_score of rows(kind, tests, is_test, ceiling, has_docstring, ratio, body_lines)."""
    possible = F.col("kind").isin("function", "method") & (F.col("tests") > 0) & ~F.col("is_test")
    ready = possible & F.col("tests").between(2, F.col("ceiling")) & F.col("has_docstring") & (F.col("ratio") >= 0.6) & (F.col("body_lines") >= 4)
    score = F.when(possible, N.focus_score(F.col("ratio"), F.col("tests"), F.col("ceiling"), F.col("body_lines"), F.col("has_docstring"))).otherwise(0.0)
    return rows.withColumns({"possible": possible, "ready": ready, "focus_score": score})


def excision_reason():
    """Why no task can be built on a symbol; null if one can. First failing reason."""
    return F.when(F.col("tests") == 0, "no_covering_test").when(F.col("is_test"), "is_itself_a_test").when(~F.col("kind").isin("function", "method"), "not_a_callable")


def tests_index(owned: DataFrame) -> DataFrame:
    """Test to its sorted symbols."""
    return owned.groupBy("test_id").agg(F.sort_array(F.collect_set("symbol_id")).alias("symbols"))


def coverage_statistics(covered: DataFrame) -> DataFrame:
    hit = F.col("tests") > 0
    return covered.agg(F.count(F.lit(1)).alias("symbols"), F.count_if(hit).alias("covered"), F.coalesce(F.avg(F.when(hit, F.col("tests"))), F.lit(0.0)).alias("tests_per_covered"), F.max("ceiling").alias("ceiling"), F.count_if("possible").alias("possible"), F.count_if("ready").alias("ready"))


def importable(paths: DataFrame, files: DataFrame) -> DataFrame:
    """paths that belong to a distribution: at the root, below src or lib, or below a package."""
    parts = F.split("path", "/")
    dirs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    packages = files.where(F.col("path").endswith("/__init__.py")).select(F.regexp_replace("path", "/__init__\\.py$", "").alias("dir")).distinct()
    inside = paths.select("path", F.explode(dirs).alias("dir")).join(packages, "dir", "left_semi").select("path").distinct()
    plain = paths.where((F.size(parts) == 1) | F.get(parts, F.lit(0)).isin("src", "lib")).select("path")
    return inside.unionByName(plain).distinct()


def uncovered_targets(covered: DataFrame, symbols: DataFrame, files: DataFrame, most: int = 3) -> DataFrame:
    """Public callables without tests: documented first, then long ones, one a module; the last slot takes the next best of any module."""
    fit = covered.where("tests = 0 and not is_test and kind in ('function', 'method')").join(symbols.where("is_public").select("id").distinct(), "id", "left_semi")
    fit = fit.join(importable(files, files), "path", "left_semi").withColumn("module", F.regexp_replace("qualified_name", r"\.?[^.]*$", ""))
    fit = fit.withColumn("_key", F.struct((~F.col("has_docstring")).alias("a"), (-F.col("body_lines")).alias("b"), F.col("id").alias("c")))
    first = fit.withColumn("_n", F.row_number().over(Window.partitionBy("module").orderBy("_key"))).where("_n = 1").drop("_n").orderBy("_key").limit(most - 1)
    edge = first.agg(F.max("_key").alias("_edge"), F.count(F.lit(1)).alias("_have"))
    last = fit.crossJoin(F.broadcast(edge)).where((F.col("_have") == most - 1) & (F.col("_key") > F.col("_edge"))).drop("_edge", "_have").orderBy("_key").limit(1)
    return first.unionByName(last).drop("_key")
