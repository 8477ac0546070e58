"""Plans and results that hold on tables much larger than those of the other tests."""

import os
import pickle
from datetime import datetime
from functools import reduce
from operator import add

import numpy as np
import pytest
from pyspark import SparkFiles
from pyspark.sql import functions as F

from strataquarry.functions import lineage
from strataquarry.llm import quality, runtime
from strataquarry.llm import words as W
from strataquarry.operators import graph, rank, search, texts
from strataquarry.plans import catalogue


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def small(spark, **columns):
    """Task t0's row, which Spark estimates at some bytes, as the scan of a narrow table."""
    return spark.range(1).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("task_id"), *(F.lit(v).alias(k) for k, v in columns.items()))


def test_leak_verdict_broadcasts_nothing(spark):
    said = small(spark, text="Set _new and call run(alpha, beta)")
    diff = small(spark, diff="+++ b/x\n+_new = run(alpha, beta)\n")
    names = small(spark, name="old")
    out = texts.leak_verdict(said, diff, names, names.selectExpr("task_id", "name AS text"))
    assert "SortMergeJoin" in plan(out) and "Broadcast" not in plan(out)
    assert [tuple(r) for r in out.collect()] == [("t0", False, ["run ( alpha , beta"], ["_new"], [])]


def test_classes_do_not_follow_the_order_of_rows(spark, tmp_path):
    """Seven values whose mean is 25 on paper; added in the order of events they give the least double above it, backwards 25 or less."""
    values = [19.0, 36.61, 37.28, 2.29, 51.77, 19.22, 8.83]
    assert reduce(add, values) / 7 > 25 >= reduce(add, values[::-1]) / 7
    rows = [(k, datetime(2024, 1, 20), 1, "view", v) for k, v in enumerate(values)] + [(7, datetime(2024, 1, 20), 2, "view", None), (8, datetime(2024, 1, 20), 2, "view", None)]
    for name, some in (("there", rows), ("back", rows[::-1])):
        spark.createDataFrame(some, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").coalesce(1).write.parquet(str(tmp_path / name / "events.parquet"))
        got = catalogue.queries()["q138_class_counts"](spark, str(tmp_path / name)).collect()
        assert sorted((r.user_id, r.failure_class, r.n) for r in got) == [(1, "assertion", 1), (2, "behavioral_exception", 1)]


def test_weighted_rank_is_of_the_scores_it_shows(spark):
    """The larger of two scores that round alike stands behind the smaller key."""
    plain = spark.createDataFrame([(0, 0.0), (1, 0.5 - 2e-11), (2, 0.5), (3, 1.0)], "s_suppkey int, x double")
    shown = rank.weighted_rank(plain, [], {"x": 1.0}, "s_suppkey", digits=9)
    assert [r.s_suppkey for r in shown.orderBy("rank").collect()] == [3, 1, 2, 0]


def test_quality_model_is_a_file_not_a_closure(spark):
    docs = spark.createDataFrame([(k, f"a{k % 7} b{k % 5} c{k % 3} d e f g h i j k{k}") for k in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1) for k in range(0, 40, 2)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    assert len(pickle.dumps(model)) < 1000
    texts_ = [r.text.encode() for r in docs.orderBy("doc_id").collect()]
    buf, ends = np.frombuffer(b"".join(texts_), np.uint8), np.cumsum([0, *map(len, texts_)])
    want = quality.scores(W.split(buf, ends), model)
    got = [r.score for r in quality.quality_rules(docs, labels).orderBy("doc_id").collect()]
    assert np.any(want) and np.allclose(got, want)


def test_quality_file_holds_no_ratio_of_zero_and_leaves_no_other_copy(spark, monkeypatch, tmp_path):
    """Most n-grams stand once in a document that is not trusted; each executor keeps two copies of the file."""
    written, spaces = [], []
    monkeypatch.setattr(quality, "cut", lambda df: (written.append(runtime.cut(df)), written[-1])[1])
    monkeypatch.setattr("tempfile.tempdir", str(tmp_path))
    monkeypatch.setattr(quality, "_count", lambda buckets, f=quality._count: (spaces.append(buckets), f(buckets))[1])
    docs = spark.createDataFrame([(k, f"a{k % 7} b{k % 5} c{k % 3} d e f g h i j " + " ".join(f"w{k}x{i}" for i in range(200))) for k in range(40)], "doc_id long, text string")
    model = quality.fit(docs, spark.createDataFrame([(k, 1) for k in range(2)], "doc_id long, quality int"))
    (buckets,) = spaces
    path = SparkFiles.get(model.file)
    assert os.path.getsize(path) < buckets * 3 // 16 + 2 * 2_000, "16,000 n-grams, some 950 of which are trusted or repeated"
    assert not os.path.exists(written[0]._cut.removeprefix("file://"))
    assert not list(tmp_path.rglob("ratios-*"))


@pytest.mark.parametrize("share", [0.0, 0.3, 1.0])
def test_quality_file_gives_the_ratio_of_every_bucket(spark, share):
    """Slices in any order, one of them without n-grams; every bucket is looked up."""
    buckets, rng = quality.SLICE * 4, np.random.default_rng(2)
    want = np.where(rng.random(buckets) < share, rng.normal(size=buckets), 0).astype(np.float16)
    want[2 * quality.SLICE : 3 * quality.SLICE] = 0
    rows = []
    for k in (3, 0, 1):
        part = want[k * quality.SLICE : (k + 1) * quality.SLICE]
        rows.append((k, bytearray(np.packbits(part != 0, bitorder="little")), bytearray(part[part != 0].tobytes())))
    name = quality._handed_out(spark.createDataFrame(rows, "slice long, bits binary, ratio binary").coalesce(1), buckets)
    model = pickle.loads(pickle.dumps(quality.Model(name, 0.0, buckets)))
    high = rng.integers(0, 1 << 40, buckets).astype(np.uint64) * np.uint64(buckets)
    assert np.array_equal(model.ratio(high + np.arange(buckets, dtype=np.uint64)), want.astype(float))


def test_bindings_broadcast_nothing(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(graph, "cut", lambda df: (plans.append(plan(df)), lineage.cut(df))[1])
    k = F.col("id")
    path, module = (F.concat(F.lit(a), k.cast("string"), F.lit(b)) for a, b in (("m", ".py"), ("m", "")))
    files = spark.range(1, 9).select(path.alias("path"), module.alias("module"))
    imports = spark.range(2, 9).select(path.alias("path"), F.lit(1).alias("line"), F.concat(F.lit("m"), F.expr("id div 2").cast("string")).alias("module"), F.lit("f").alias("name"), F.lit(0).alias("level"), F.lit("f").alias("bound_name"), F.lit(0).alias("ordinal"))
    got = graph.bindings(imports, files, spark.range(1, 2).select(F.concat(F.lit("m"), k.cast("string"), F.lit(".py::m1.f")).alias("id")))
    assert {r.target for r in got.collect()} == {"m1.py::m1.f"} and got.count() == 7
    assert plans and not any("Broadcast" in p for p in plans)


def test_index_reads_its_texts_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    contents = {"a": "abcabc\nab", "b": None, "c": "", "d": "é😀x\x00y", "e": "ab", "f": "\nxyz\n"}
    files = spark.createDataFrame(list(contents.items()), "path string, content string").select("path", F.udf(seen)("content").alias("content"))
    search.write_index(files, str(tmp_path / "i"))
    assert read.value == len(contents)
    want = {(line[i : i + 3], path) for path, text in contents.items() for line in (text or "").split("\n") for i in range(len(line) - 2)}
    got = [tuple(r) for r in search.read_index(spark, str(tmp_path / "i")).collect()]
    assert sorted(got) == sorted(want)
