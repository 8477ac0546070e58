import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from strataquarry.llm import quality

from .fixtures import DOCS, corpus, prose, rows

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = [False] * len(w)
    for i in range(len(w) - 4):
        if seen[tuple(w[i : i + 5])] > 1:
            hit[i : i + 5] = [True] * 5
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = sum(hit)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), n, len(w) < 10 or 100 * n > 20 * len(w)


def test_base_equals_brute_force(spark):
    data = [*corpus(), *[(500 + i, t, "en", "s", 0) for i, t in enumerate(["# a\n# a\n\n\n", "x y z q r " * 9, "a|b <c> & $1 %\n*\n*", None])]]
    got = {r.doc_id: tuple(r)[1:7] for r in quality.quality_rules(spark.createDataFrame(data, DOCS).repartition(4), spark.createDataFrame([], "doc_id long, quality int")).collect()}
    assert got == {r[0]: plain(r[1]) for r in data}


def test_ratio_separates_junk_and_keeps_columns(spark):
    rng = random.Random(1)
    good = [prose(rng, 120) for _ in range(120)]
    junk = [" ".join(f"{w}***" for w in prose(rng, 120, 8).upper().split()) for _ in range(40)]
    df = spark.createDataFrame(rows(good + junk), DOCS)
    labels = spark.createDataFrame([*((i, 1) for i in range(80)), (0, 1), (None, 1), *((120 + i, 0) for i in range(20))], "doc_id long, quality int")
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(120))
    verdicts = {r.doc_id: r for r in quality.quality_rules(df, labels).collect()}
    assert all(verdicts[i].kept == (i < 120) for i in verdicts)


def test_no_trusted_rows_and_empty_table(spark):
    df = spark.createDataFrame(rows(["a b c d e f g h i j", None]), DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [(r.kept, r.score) for r in quality.quality_rules(df, none).orderBy("doc_id").collect()] == [(True, 0.0), (False, 0.0)]
    assert quality.quality_rules(df.where("false"), none).count() == 0


def test_junk_is_not_masked_by_collisions_of_many_words(spark):
    rng = random.Random(3)
    good = [prose(rng, 400, 60_000) for _ in range(2500)]
    junk = [" ".join(f"{w}***" for w in prose(rng, 60, 8).split()) for _ in range(20)]
    df = spark.createDataFrame(rows(good + junk), DOCS)
    labels = spark.createDataFrame([(i, 1) for i in range(2500)], "doc_id long, quality int")
    assert [r.doc_id for r in quality.quality_rules(df, labels).where("not kept").orderBy("doc_id").collect()] == list(range(2500, 2520))


def test_verdicts_stay_as_the_table_grows_past_the_hash_space(spark, monkeypatch):
    """Ten times the documents, 2^20 buckets for more distinct n-grams than that, the trusted sample unchanged."""
    monkeypatch.setattr(quality, "MOST_BUCKETS", 1 << 20)
    rng = random.Random(4)
    good = [prose(rng, 250, 40_000) for _ in range(4000)]
    junk = [" ".join(f"{w}***" for w in prose(rng, 60, 8).split()) for _ in range(200)]
    labels = spark.createDataFrame([(i, 1) for i in range(400)], "doc_id long, quality int")
    scores = []
    for n, bad in ((400, 20), (4000, 200)):
        data = rows(good[:n]) + [(10_000 + i, t, "en", "s", 0) for i, t in enumerate(junk[:bad])]
        found = {r.doc_id: r for r in quality.quality_rules(spark.createDataFrame(data, DOCS).repartition(4), labels).collect()}
        assert all(r.kept == (i < 10_000) for i, r in found.items())
        scores.append([found[i].score for i in range(400)])
    assert max(abs(a - b) for a, b in zip(*scores)) < 0.15


def test_half_spoiled_documents_are_rejected(spark):
    rng = random.Random(5)
    good = [prose(rng, 120) for _ in range(120)]
    junk = [" ".join(x for w in prose(rng, 60, 8).split() for x in (prose(rng, 1), f"{w}***")) for _ in range(20)]
    df = spark.createDataFrame(rows(good + junk), DOCS)
    labels = spark.createDataFrame([(i, 1) for i in range(120)], "doc_id long, quality int")
    verdicts = quality.quality_rules(df, labels).orderBy("doc_id").collect()
    assert not any(r.base_failed for r in verdicts)
    assert [r.kept for r in verdicts] == [True] * 120 + [False] * 20, [r.score for r in verdicts]


def test_ties_long_texts_repeats_and_clashing_columns(spark):
    long = "many plain words " * 100_000 + "z" * 500_000
    data = [(1, long, 1, "t", 2.0), (1, long, 1, "t", 2.0), (2, "a b c d e f g h i j k", None, None, None)]
    df = spark.createDataFrame(data, "doc_id long, text string, total int, trusted string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.quality_rules(df, none, threshold=0.0).collect()
    assert [(r.doc_id, r.kept) for r in sorted(got, key=lambda r: r.doc_id)] == [(1, False), (1, False), (2, True)], "a score at the threshold stays"
    assert [tuple(r) for r in quality.keep_good(df, none, threshold=0.0).collect()] == [data[2]]


def test_score_equals_brute_force(spark):
    """Mean log ratio of hashed unigrams and bigrams, counted by plain loops, and the verdict that follows."""
    import math

    import pyarrow as pa

    from strataquarry.llm import words as W

    rng = random.Random(9)
    data = [(i, prose(rng, rng.randrange(8, 60), 50), "en", "s", 0) for i in range(40)] + [(99, None, "en", "s", 0)]
    trusted = {i for i in range(0, 40, 3)}
    grams = {}
    for i, t, *_ in data:
        w = W.split(*W.buffers(pa.array([t])))
        grams[i] = [h % quality.LEAST_BUCKETS for h in quality.features(w)[1].tolist()]
    raw, target = Counter(x for g in grams.values() for x in g), Counter(x for i in trusted for x in grams[i])
    share, k = sum(target.values()) / sum(raw.values()), quality.SMOOTHING
    n = sum(raw.values())
    shift = math.log(((n - len(raw)) * share + k * quality.LEAST_BUCKETS) / (n * share + k * quality.LEAST_BUCKETS))
    ratio = lambda x: math.log(target[x] + k) - math.log(max(raw[x] - 1, 0) * share + k)
    out = quality.quality_rules(spark.createDataFrame(data, DOCS).repartition(3), spark.createDataFrame([(i, 1) for i in trusted], "doc_id long, quality int"), threshold=0.01).collect()
    for r in out:
        want = sum(map(ratio, grams[r.doc_id])) / len(grams[r.doc_id]) + shift if grams[r.doc_id] else 0.0
        assert abs(r.score - want) < 2e-3
        assert r.kept == (not r.base_failed and r.score >= 0.01)


def test_counts_of_one_text_may_pass_the_packed_width(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(quality, "_COUNT", np.uint64(7))
    batch = pa.record_batch({"text": ["a " * 50 + "b", "a a", "b"], "trusted": [True, False, False]})
    rows = pa.Table.from_batches(quality._count(1 << 20)(iter([batch])))
    found = {}
    for r in rows.to_pylist():
        for place, raw, target in zip(r["place"], r["raw"], r["target"]):
            old = found.get((r["slice"], place), (0, 0))
            found[r["slice"], place] = (old[0] + raw, old[1] + target)
    assert sorted(found.values()) == [(1, 1), (2, 1), (50, 49), (52, 50)]
