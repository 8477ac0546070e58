import random
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from strataquarry.llm import jaccard
from strataquarry.llm.components import components

from .fixtures import DOCS, corpus, prose, rows


def shingles(text, k=5):
    w = (text or "").encode().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def brute(texts):
    sets, links, root = [shingles(t) for t in texts], [0] * len(texts), list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(texts)), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (find(i), links[i]) for i in range(len(texts))}


def family(seed, n, words, edits):
    rng = random.Random(seed)
    base = prose(rng, words).split()
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rng.randrange(edits)):
            t[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(t))
    return out


def test_equals_brute_force(spark):
    texts = [r[1] for r in corpus()] + family(3, 60, 120, 8)
    df = spark.createDataFrame(rows(texts), DOCS).repartition(6)
    assert {r.doc_id: (r.class_id, r.n_links) for r in jaccard.jaccard_join(df).collect()} == brute(texts)


def test_groups_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 8)
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", 8_000)
    texts = family(5, 90, 100, 6)
    df = spark.createDataFrame(rows(texts), DOCS)
    assert {r.doc_id: (r.class_id, r.n_links) for r in jaccard.jaccard_join(df).collect()} == brute(texts)


def test_one_of_each_keeps_columns_and_wordless_texts(spark):
    texts = ["a b c d e f", "a b c d e f", "q r s t u v", "", None]
    df = spark.createDataFrame(rows(texts), DOCS).withColumns({"key": F.lit(1), "links": F.lit(2)})
    df = df.unionByName(df.where("doc_id = 2"))
    out = jaccard.one_of_each(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [0, 2, 3, 4]
    assert jaccard.one_of_each(df.where("false")).count() == 0


def test_null_ids_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, "x y z"), (None, "x y z"), (4, "x y z"), (4, "x y z"), (5, None)], "doc_id long, text string")
    got = sorted(((r.doc_id or -1), r.class_id, r.n_links) for r in jaccard.jaccard_join(df).collect())
    assert got == [(-1, 4, 3), (-1, 4, 3), (4, 4, 3), (4, 4, 3), (5, 5, 0)]


def test_pruning_is_monotone_and_keeps_likely_pairs():
    need = jaccard.least_matches(0.8, jaccard.TOLERANCE)
    assert list(need) == sorted(need) and need[-1] < 0.8 * jaccard.BANDS * jaccard.ROWS
    sig = np.random.default_rng(1).integers(0, 256, (3, 120), dtype=np.uint8)
    sig[1, :110] = sig[0, :110]
    pairs = [p for l, r in jaccard.surviving(sig, np.array([1, 2, 3]), np.array([3, 3, 3]), need) for p in zip(l.tolist(), r.tolist())]
    assert pairs == [(0, 1)]


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (5, 5), (None, 1), (20, 21), (21, 22), (22, 20)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7, 9: 7, 20: 20, 21: 20, 22: 20}
    chain = spark.range(200).selectExpr("id as a", "id + 1 as b")
    assert {r.label for r in components(chain).collect()} == {0}


def test_long_texts_ties_at_the_threshold_and_clashing_columns(spark):
    rng = random.Random(6)
    words = [f"u{i}" for i in range(4 + 90)]
    # 90 shingles each, 80 of them shared: 80 / 100 is the threshold itself; with one shared shingle less it is missed
    at, below = [*words[:84], *(f"a{i}" for i in range(10))], [*words[:83], *(f"b{i}" for i in range(11))]
    long = " ".join(f"w{rng.randrange(50_000)}" for _ in range(150_000))
    texts = [" ".join(words), " ".join(at), " ".join(below), long, long.replace(" ", "  ", 1), "x" * 1_000_000, "x" * 1_000_000]
    df = spark.createDataFrame([(i, t, 1, b"k", "r") for i, t in enumerate(texts)], "doc_id long, text string, links int, key binary, rep string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.jaccard_join(df).collect()}
    assert got == {0: (0, 1), 1: (0, 1), 2: (2, 0), 3: (3, 1), 4: (3, 1), 5: (5, 1), 6: (5, 1)}
