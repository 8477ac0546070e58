"""Numeric conventions: nearest-rank percentiles, min-max with constant columns at 1, scores and tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut


def half_even(c: Column) -> Column:
    """Round to a whole number, ties to even."""
    return F.rint(c)


def mean_in_order(value: Column, order: Column) -> Column:
    """Mean of a group's doubles, added one by one in `order`; nulls are left out. avg() adds them as partitions happen to meet, so the
    last bit, and with it a comparison with a limit, changes from run to run. A group's numbers are held by one task."""
    rows = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v")))))
    total = F.aggregate(rows, F.lit(0.0), lambda s, x: s + x["v"])
    return F.when(F.size(rows) > 0, total / F.size(rows))


def nearest_rank(df: DataFrame, keys: list[str], value: str, fractions: dict[str, float]) -> DataFrame:
    """value at index round_half_even(f * (n - 1)) of each group's order, clamped. One pass: no group is collected."""
    by = Window.partitionBy(*keys)
    ranked = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"), F.row_number().over(by.orderBy(value)).alias("_i"), F.count(F.lit(1)).over(by).alias("_n"))
    index = lambda f: F.least(F.greatest(half_even(F.lit(f) * (F.col("_n") - 1)), F.lit(0)), F.col("_n") - 1) + 1
    return ranked.groupBy(*keys).agg(F.max("_n").alias("n"), *(F.max(F.when(F.col("_i") == index(f), F.col("_v"))).alias(name) for name, f in fractions.items()))


def counted_rank(df: DataFrame, keys: list[str], value: str, fractions: dict[str, float]) -> DataFrame:
    """nearest_rank() for values with few distinct ones: counts first, so a hot group travels as its distinct values."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    by = Window.partitionBy(*keys)
    run = counts.withColumn("_to", F.sum("_c").over(by.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))).withColumn("_n", F.sum("_c").over(by))
    index = lambda f: F.least(F.greatest(half_even(F.lit(f) * (F.col("_n") - 1)), F.lit(0)), F.col("_n") - 1) + 1
    hit = lambda f: (F.col("_to") >= index(f)) & (F.col("_to") - F.col("_c") < index(f))
    return run.groupBy(*keys).agg(F.max("_n").alias("n"), *(F.max(F.when(hit(f), F.col("_v"))).alias(name) for name, f in fractions.items()))


def min_max(value: Column, low: Column, high: Column) -> Column:
    """0..1; a constant column scores 1 everywhere."""
    return F.when(high <= low, F.lit(1.0)).otherwise((value - low) / (high - low))


def with_min_max(df: DataFrame, keys: list[str], columns: list[str], suffix: str = "_norm") -> DataFrame:
    """Normalised columns; the extremes are one small aggregate joined back, so a hot group is never sorted."""
    ends = df.groupBy(*keys).agg(*(f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))))
    joined = df.join(ends, keys) if keys else df.crossJoin(F.broadcast(ends))
    out = joined.select("*", *(min_max(F.col(c), F.col(f"_lo_{c}"), F.col(f"_hi_{c}")).alias(c + suffix) for c in columns))
    return out.drop(*(f"_{n}_{c}" for c in columns for n in ("lo", "hi")))


def ceiling_of(distinct_tests: Column, share: float = 0.15, least: int = 3, default: int = 12) -> Column:
    """Tests above which a symbol counts as infrastructure."""
    return F.when(distinct_tests == 0, F.lit(default)).otherwise(F.greatest(F.lit(least), half_even(F.lit(share) * distinct_tests).cast("int")))


def coverage_ratio(covered: Column, body: Column) -> Column:
    return F.when(body <= 0, F.lit(0.0)).otherwise(F.bround(F.least(F.lit(1.0), covered / body), 3))


def focus_score(ratio: Column, tests: Column, ceiling: Column, body: Column, documented: Column) -> Column:
    """0.35 coverage + 0.30 breadth + 0.20 substance + 0.15 documentation of a symbol that can be excised.

    Breadth: 0.25 below two tests, 0.1 above the ceiling, else 1 falling to 0.5 at the ceiling. Substance: body over 12 lines.
    """
    span = F.greatest(F.lit(1), ceiling - 2)
    breadth = F.when(tests < 2, 0.25).when(tests > ceiling, 0.1).otherwise(1.0 - (tests - 2) / span * 0.5)
    return F.bround(ratio * 0.35 + breadth * 0.30 + F.least(F.lit(1.0), body / 12.0) * 0.20 + F.when(documented, 0.15).otherwise(0.0), 4)


def tier_of(value: Column, low: Column, high: Column) -> Column:
    return F.when(value <= low, "easy").when(value <= high, "medium").otherwise("hard")


def with_rank(df: DataFrame, keys: list[str], order: list[Column], out: str = "rank", total: str | None = None) -> DataFrame:
    """Position from 1 in each group, and the group's size. The whole table is sorted in ranges of keys and order: every range
    numbers its own rows and adds what earlier ranges hold of the same group, so no task ever holds a whole hot group."""
    at = F.monotonically_increasing_id()
    rows = cut(df.orderBy(*keys, *order).withColumn("_range", F.shiftright(at, 33)).withColumn("_at", at - F.shiftleft(F.shiftright(at, 33), 33)))
    sizes = rows.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    group = Window.partitionBy(*keys)
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a group and range
    own = [f"_key_{i}" for i in range(len(keys))]
    sizes = sizes.select(*(F.col(k).alias(o) for k, o in zip(keys, own, strict=True)), F.col("_range").alias("_in"), "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(group).alias("_all"))
    same = F.col("_range") == F.col("_in")
    for k, o in zip(keys, own, strict=True):
        same &= F.col(k).eqNullSafe(F.col(o))
    ranked = rows.join(sizes if keys else F.broadcast(sizes), same).withColumn(out, F.col("_before") + F.col("_at") - F.col("_first") + 1)
    ranked = ranked.withColumn(total, F.col("_all")) if total else ranked
    return ranked.drop("_range", "_at", "_before", "_all", "_in", "_first", *own)


def equal_thirds(df: DataFrame, keys: list[str], order: list[Column], out: str = "tier") -> DataFrame:
    """min(2, position * 3 // n) within each group."""
    ranked = with_rank(df, keys, order, "_place", "_total")
    return ranked.withColumn(out, F.floor((F.col("_place") - 1) * 3 / F.col("_total")).cast("int")).drop("_place", "_total")


def version_tuple(version: Column) -> Column:
    return F.transform(F.filter(F.split(F.regexp_replace(version, r"\.\*$", ""), r"\."), lambda p: p.rlike("^[0-9]+$")), lambda p: p.cast("int"))


def satisfies(version: Column, spec: Column) -> Column:
    """Whether a dotted version meets one specifier (>=, >, <=, <, ==, !=, ~=; a trailing .* compares the prefix). ~= acts as >=."""
    op = F.regexp_extract(spec, r"^\s*(>=|<=|==|!=|~=|>|<)", 1)
    text = F.trim(F.regexp_replace(spec, r"^\s*(>=|<=|==|!=|~=|>|<)", ""))
    v, w = version_tuple(version), version_tuple(text)
    n = F.greatest(F.size(v), F.size(w))
    pad = lambda a: F.concat(a, F.array_repeat(F.lit(0), (n - F.size(a)).cast("int")))
    a, b = pad(v), pad(w)
    prefix = F.slice(v, F.lit(1), F.size(w)) == w
    same = F.when(text.endswith(".*"), prefix).otherwise(a == b)
    return F.when(op == ">=", a >= b).when(op == "<=", a <= b).when(op == ">", a > b).when(op == "<", a < b).when(op == "==", same).when(op == "!=", ~same).when(op == "~=", a >= b).otherwise(F.lit(True))
