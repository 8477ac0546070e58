"""Search over a tree of texts by trigrams: an inverted index picks the files that can match before a pattern reads them.

The index is rows (gram, path), a file's distinct runs of three characters without a line end. Written by write_index() it is sorted by gram,
so a lookup's filter skips most pages, and dealt by the gram and one of PARTS of the paths, so a run that every file has fills many files of
postings, not one. Ranges would have to be sampled, and with that all grams made twice.
A pattern's grams come from the characters that every match must hold; a pattern without any is run over all files. Null texts have no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIZE = 3
#: Parts of the paths, each of which holds its own postings of a gram.
PARTS = 16
#: Postings that leave a task's Python at once.
_ROWS = 100_000
_LINE, _ONE, _TWO, _LOW = np.uint64(10), np.uint64(21), np.uint64(42), np.uint64((1 << 21) - 1)
CLASSES = "dDsSwWbBAzZGRnrtfhHvV"


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, path) of a task's texts: three code points in a number, so that a text's distinct ones come from one sort."""
    names = ["gram", "path"]
    for batch in batches:
        found, owner, paths = [], [], batch.column(0)
        for row, text in enumerate(batch.column(1)):
            code = np.frombuffer((text.as_py() or "").encode("utf-32-le"), np.uint32).astype(np.uint64)
            if len(code) < SIZE:
                continue
            a, b, c = code[:-2], code[1:-1], code[2:]
            key = np.unique((a << _TWO | b << _ONE | c)[(a != _LINE) & (b != _LINE) & (c != _LINE)])
            signs = np.stack([key >> _TWO, key >> _ONE & _LOW, key & _LOW], 1).astype("<u4").tobytes().decode("utf-32-le")
            found += [signs[i : i + SIZE] for i in range(0, len(signs), SIZE)]
            owner.append(np.full(len(key), row))
            if len(found) > _ROWS:
                yield pa.record_batch([pa.array(found, pa.string()), paths.take(pa.array(np.concatenate(owner)))], names=names)
                found, owner = [], []
        if found:
            yield pa.record_batch([pa.array(found, pa.string()), paths.take(pa.array(np.concatenate(owner)))], names=names)


def gram_index(files: DataFrame) -> DataFrame:
    """(gram, path) of files(path, content)."""
    return files.select("path", "content").mapInArrow(_grams, "gram string, path string")


def write_index(files: DataFrame, path: str) -> None:
    part = F.pmod(F.xxhash64("path"), F.lit(PARTS))
    gram_index(files).repartition("gram", part).sortWithinPartitions("gram", "path").write.mode("overwrite").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("gram string, path string").parquet(path)


def required(pattern: str) -> list[str]:
    """Texts that every match of a Java pattern holds. Only plain sequences are understood; alternatives, groups and classes require
    nothing, and with flags, references or quotes nothing at all is required."""
    if any(x in pattern for x in ("(?", "\\Q", "&&")):
        return []
    runs, run, depth, i = [], "", 0, 0
    while i < len(pattern):
        c, plain = pattern[i], False
        if c == "\\":
            i += 1
            c = pattern[i : i + 1]
            if c.isalnum() and c not in CLASSES:
                return []
            plain = not c.isalnum()
        elif c == "|":
            if not depth:
                return []
        elif c == "[":
            end = pattern.find("]", i + 2 + (pattern[i + 1 : i + 2] == "^"))
            if end < 0 or "[" in pattern[i + 1 : end] or "\\" in pattern[i:end]:
                return []
            i = end
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c in "*?{":
            run = run[:-1]
            if c == "{":
                i = pattern.find("}", i)
                if i < 0:
                    return []
        else:
            plain = c not in ".^$+"
        if plain and not depth:
            run += c
        else:
            runs, run = [*runs, run], ""
        i += 1
    return [r for r in [*runs, run] if r]


def required_grams(pattern: str) -> list[str]:
    return sorted({r[i : i + SIZE] for r in required(pattern) for i in range(len(r) - SIZE + 1) if "\n" not in r[i : i + SIZE]})


def candidates(index: DataFrame, pattern: str) -> DataFrame | None:
    """(path) of the files that hold all grams of a pattern; None where it has none. One combinable count, no join a gram."""
    wanted = required_grams(pattern)
    if not wanted:
        return None
    return index.where(F.col("gram").isin(wanted)).groupBy("path").agg(F.count_distinct("gram").alias("_n")).where(F.col("_n") == len(wanted)).select("path")


def search(files: DataFrame, index: DataFrame, pattern: str) -> DataFrame:
    """(path, line, text) of every matching line, as texts.grep() finds them without a limit; only candidates are read by the pattern."""
    some = candidates(index, pattern)
    read = files if some is None else files.join(some, "path", "left_semi")
    return read.select("path", F.posexplode(F.split("content", "\n")).alias("n", "text")).where(F.col("text").rlike(pattern)).select("path", (F.col("n") + 1).alias("line"), "text")


def search_cost(files: DataFrame, index: DataFrame, pattern: str) -> DataFrame:
    """(files, files_read, files_hit) of a search."""
    some = candidates(index, pattern)
    read = files.select("path") if some is None else some
    hit = search(files, index, pattern).select("path").distinct()
    marked = files.select("path").distinct().join(read.withColumn("_r", F.lit(True)), "path", "left").join(hit.withColumn("_h", F.lit(True)), "path", "left")
    return marked.agg(F.count(F.lit(1)).alias("files"), F.count("_r").alias("files_read"), F.count("_h").alias("files_hit"))
