"""Boilerplate lines by site-relative frequency.

For each host, a line's frequency is the share of the host's pages that contain it (once a page, however often it stands
there; lines compare after trimming spaces; blank lines never count). A line goes where its share exceeds `ratio` by more
than chance explains: pages above ratio * total by over `sure` standard deviations of as many pages that hold the line with
probability `ratio`. The rule is one for hosts of every size: 2 of 4 pages are evidence, 2 of 50 are not. A line on a single
page repeats nothing and stays. The pages' line hashes are counted with map-side combination; what survives is at most
(lines a page) / ratio hashes a host, and is joined back to the pages by host, where Spark may split a large host.

Defined results: null or empty text is one empty line and stays; a null host is a host of its own; repeated rows are pages of
their own; a text all of whose lines go becomes empty; texts of any length are read whole; other columns pass through
whatever their names, but those named as `into` are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import cut, release, splittable, unused

RATIO = 0.03
SURE = 2.0


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def boilerplate(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, sure: float = SURE) -> DataFrame:
    """(h, absent, hashes): xxhash64 of each host's boilerplate lines."""
    sites = pages.select(F.coalesce(F.col(host), F.lit("")).alias("h"), F.col(host).isNull().alias("absent"), F.col(text).alias("t"))
    # lines meet a page's host once, by hash; the text itself never travels
    marks = F.array_distinct(F.transform(F.filter(F.transform(_lines(F.col("t")), lambda x: F.trim(x)), lambda x: x != ""), lambda x: F.xxhash64(x)))
    counts = sites.select("h", "absent", F.explode(marks).alias("line")).groupBy("h", "absent", "line").agg(F.count(F.lit(1)).alias("pages")).where("pages > 1")
    totals = sites.groupBy("h", "absent").agg(F.count(F.lit(1)).alias("total"))
    above = F.col("pages") - F.lit(ratio) * F.col("total")
    found = splittable(counts, totals, ["h", "absent"]).where((above > 0) & (above * above > F.lit(sure * sure * ratio * (1 - ratio)) * F.col("total")))
    return cut(found.groupBy("h", "absent").agg(F.array_sort(F.collect_list("line")).alias("hashes")))


def without_boilerplate(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, sure: float = SURE, into: tuple[str, str] = ("_lines", "_dropped")) -> DataFrame:
    """Rows of pages with text as it stays, and `into` (long): the lines there were and those that went."""
    pages = pages.drop(*into)
    found = boilerplate(pages, host, text, ratio, sure)
    release(pages.sparkSession)
    h, absent, hashes, kept = unused(pages, "h", "absent", "hashes", "kept")
    b = found.toDF(h, absent, hashes)
    joined = pages.join(b, (F.coalesce(F.col(host), F.lit("")) == F.col(h)) & (F.col(host).isNull() == F.col(absent)), "left")
    all_lines = _lines(F.col(text))
    stays = F.filter(all_lines, lambda x: ~F.array_contains(F.col(hashes), F.xxhash64(F.trim(x))) | (F.trim(x) == ""))
    joined = joined.withColumn(kept, F.when(F.col(hashes).isNull(), all_lines).otherwise(stays))
    out = [F.array_join(kept, "\n").alias(text) if c == text else F.col(c) for c in pages.columns]
    return joined.select(*out, F.size(all_lines).cast("long").alias(into[0]), (F.size(all_lines) - F.size(kept)).cast("long").alias(into[1]))
