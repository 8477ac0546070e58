"""Whether symbols stand where a graph says: their anchors against the lines of the files themselves.

A line ends where Python's str.splitlines ends one. Spans meet lines by equi-join on path and buckets of lines, so a long file
or span is spread over many keys and a symbol is never compared with lines outside the buckets it reaches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import EDGE_KEY, match_rate

#: Lines of a bucket.
BUCKET = 64
_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
SYMBOL_KEY = ["id", "kind", "path", "line", "end_line", "column", "end_column", "signature"]


def _lines(content: Column) -> Column:
    parts = F.split(F.coalesce(content, F.lit("")), _BREAK, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def line_table(files: DataFrame) -> DataFrame:
    """(path, line, text) of files(path, content), from line 1."""
    return files.select("path", F.posexplode(_lines(F.col("content"))).alias("at", "text")).select("path", (F.col("at") + 1).alias("line"), "text")


def check_lines(symbols: DataFrame, files: DataFrame) -> DataFrame:
    """symbols(id, path, line, end_line) with `valid` and `reason`: an anchor begins on a line of its file and ends no earlier.

    A file without lines, or that is not there, counts as one of a single line."""
    counts = files.groupBy("path").agg(F.max(F.size(_lines(F.col("content")))).alias("_count"))
    rows = symbols.join(counts, "path", "left")
    reason = (
        F.when(F.col("line") < 1, "before_first_line")
        .when(F.col("line") > F.greatest(F.coalesce("_count", F.lit(0)), F.lit(1)), F.when(F.col("_count").isNull(), "no_such_file").otherwise("after_last_line"))
        .when(F.col("end_line") < F.col("line"), "ends_before_it_begins")
        .when(F.col("line").isNull() | F.col("end_line").isNull(), "no_anchor")
    )
    return rows.select(*symbols.columns, reason.isNull().alias("valid"), reason.alias("reason"))


def check_names(symbols: DataFrame, files: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """symbols(path, name, line, end_line) with `valid` and `reason`: some line of the span holds the name. Symbols of files that are not there are left out."""
    spans = symbols.select("path", "name", "line", "end_line").distinct()
    first, last = F.greatest(F.col("line"), F.lit(1)), F.col("end_line")
    reach = spans.where(last >= first).select("*", F.explode(F.sequence((first / bucket).cast("long"), (last / bucket).cast("long"))).alias("bucket"))
    lines = line_table(files).select("path", (F.col("line") / bucket).cast("long").alias("bucket"), F.col("line").alias("at"), "text")
    inside = (F.col("at") >= F.col("line")) & (F.col("at") <= F.col("end_line")) & F.col("text").contains(F.col("name"))
    found = reach.join(lines, ["path", "bucket"]).where(inside).select("path", "name", "line", "end_line", F.lit(True).alias("_found")).distinct()
    rows = symbols.join(files.select("path").distinct(), "path", "left_semi")
    keys = [rows[c] == found[c] for c in ("path", "name", "line", "end_line")]
    valid = F.coalesce("_found", F.lit(False))
    return rows.join(found, keys, "left").select(*(rows[c] for c in symbols.columns), valid.alias("valid"), F.when(~valid, F.when(~F.coalesce(rows["end_line"] >= rows["line"], F.lit(False)), "no_span").otherwise("name_not_in_span")).alias("reason"))


def anchor_rate(checked: DataFrame) -> DataFrame:
    """anchors_checked, anchors_valid, anchor_rate of check_lines() or check_names(); none checked match at 1."""
    n, good = F.count(F.lit(1)), F.count_if("valid")
    return checked.agg(n.alias("anchors_checked"), good.alias("anchors_valid"), F.when(n == 0, 1.0).otherwise(good / n).alias("anchor_rate"))


def verify(edges: DataFrame, edges_again: DataFrame, symbols: DataFrame, symbols_again: DataFrame, checked: DataFrame, edge_key: list[str] = EDGE_KEY, symbol_key: list[str] = SYMBOL_KEY) -> DataFrame:
    """One row: a graph against one derived anew from the same source, and `status`, verified where edges, symbols and anchors all agree.

    Totals are of the graph's own distinct keys; what the second graph has beyond them does not lower a rate, but is counted."""

    def side(left: DataFrame, right: DataFrame, keys: list[str], name: str) -> DataFrame:
        one = match_rate(left, right, keys).withColumn("total", F.col("matched") + F.col("only_left"))
        rate = F.when(F.col("total") == 0, 1.0).otherwise(F.col("matched") / F.col("total"))
        return one.select(F.col("total").alias(f"{name}s_total"), F.col("matched").alias(f"{name}s_matched"), F.col("only_right").alias(f"{name}s_only_again"), rate.alias(f"{name}_rate"))

    row = side(edges, edges_again, edge_key, "edge").crossJoin(side(symbols, symbols_again, symbol_key, "symbol")).crossJoin(anchor_rate(checked))
    agree = (F.col("edge_rate") == 1) & (F.col("symbol_rate") == 1) & (F.col("anchor_rate") == 1)
    return row.withColumn("status", F.when(agree, "verified").otherwise("mismatched"))
