import random
import zlib
from itertools import product

import numpy as np

from strataquarry.llm import toxicity

from .fixtures import prose


def test_messages_equal_enumeration():
    rng = np.random.default_rng(3)
    bounds = np.array([0, 4, 5, 11])
    unary, move = rng.normal(size=11), rng.normal(size=(2, 2))
    forward, backward = toxicity.messages(unary, bounds, move)
    p = 1 / (1 + np.exp(-(forward + backward)))
    pairs = np.zeros((2, 2))
    for a, b in zip(bounds[:-1], bounds[1:]):
        total, ones = 0.0, np.zeros(b - a)
        for y in product((0, 1), repeat=b - a):
            s = np.exp(sum(unary[a + i] for i, v in enumerate(y) if v) + sum(move[u, v] for u, v in zip(y, y[1:])))
            total += s
            ones += s * np.array(y)
        assert np.allclose(p[a:b], ones / total)
        for y in product((0, 1), repeat=b - a):
            s = np.exp(sum(unary[a + i] for i, v in enumerate(y) if v) + sum(move[u, v] for u, v in zip(y, y[1:]))) / total
            for u, v in zip(y, y[1:]):
                pairs[u, v] += s
    assert np.allclose(toxicity.pair_sums(forward, backward, unary, bounds, move), pairs)


def planted(n=400, seed=2):
    rng = random.Random(seed)
    data, labels = [], []
    for i in range(n):
        words, bad = prose(rng, 60, 200).split(), i % 5 == 0
        if bad:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice(("zounds", "Blast!", "drat"))
        data.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return data, labels


def test_held_out_accuracy_and_spans(spark):
    data, labels = planted()
    out = {r.doc_id: r for r in toxicity.score_toxicity(spark.createDataFrame(data, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    held = [i for i, _ in data if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(out[i].held_out == (i in held) for i in out)
    assert all(out[i].predicted == dict(labels)[i] for i in held)
    for i in held:
        words = {x for a, b in (s.split(":") for s in out[i].spans.split(",") if s) for x in data[i][1][int(a) : int(b)].replace("!", "").split()}
        assert words == {w.rstrip("!") for w in data[i][1].split() if w in ("zounds", "Blast!", "drat")}


def test_held_out_labels_never_matter(spark):
    data, labels = planted()
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels]
    score = lambda ls: sorted((r.doc_id, r.score) for r in toxicity.score_toxicity(spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(ls, "doc_id long, toxic int")).collect())
    assert score(labels) == score(flipped)


def test_edges(spark):
    data, labels = planted(100)
    docs = spark.createDataFrame([*data, (900, None), (901, ""), (None, "zounds"), (902, "word " * 3000)], "doc_id long, text string")
    out = {r.doc_id: r for r in toxicity.score_toxicity(docs, spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")).collect()}
    assert out[900].score == out[901].score and 0 <= out[900].score < 0.3 and not out[None].held_out
    none = toxicity.score_toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {(r.score, r.predicted) for r in none.collect()} == {(0.0, 0)}
    assert toxicity.score_toxicity(docs.where("false"), spark.createDataFrame(labels, "doc_id long, toxic int")).count() == 0


def test_words_side_by_side_are_one_span():
    text = "éa bad worse, fine. bad Bad! bad"
    buf, docs = toxicity.W.buffers(toxicity.pa.array([text, "bad", ""]))
    w = toxicity.W.split(toxicity.W.FOLD[buf], docs)
    names = [toxicity.W.FOLD[buf][a:b].tobytes() for a, b in zip(w.starts, w.ends)]
    p = np.array([0.9 if n in (b"bad", b"worse") else 0.1 for n in names])
    got = toxicity.spans_of(p, toxicity.chains(buf, w), w, buf)
    cut = [text[int(a) : int(b)] for a, b in (x.split(":") for x in got[0].split(","))]
    assert cut == ["bad worse", "bad Bad", "bad"] and got[1] == "0:3" and 2 not in got


def test_sample_is_bounded_in_bytes(spark):
    data = [(i, "w " * (50 + i)) for i in range(40)] + [(7, f"other text {j}") for j in range(30)] + [(1, "x" * 5_000_000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    df = spark.createDataFrame(data, "doc_id long, text string")
    texts, toxic = toxicity.sample(df, labels, 30, 4_000)
    assert 0 < sum(map(len, texts)) <= 4_000 and len(texts) == len(toxic)
    assert len(toxicity.sample(df, labels, 30)[0]) >= 22


def test_repeats_ties_long_texts_and_clashing_columns(spark):
    data, labels = planted(100)
    long = "fine words here. " * 60_000 + "zounds " * 3 + "x" * 1_000_000
    rows = [(*r, 1, "s", 2) for r in data] + [(*data[0], 1, "s", 2), (900, long, 1, "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id int, toxic string, score int")
    out = toxicity.score_toxicity(docs, spark.createDataFrame([*labels, *labels[:5], (0, 0)], "doc_id long, toxic int")).collect()
    assert len(out) == 102 and len({(r.score, r.spans) for r in out if r.doc_id == 0}) == 1
    assert all((r.score >= toxicity.THRESHOLD) == bool(r.predicted) for r in out)
    assert "1020000:1020020" in next(r.spans for r in out if r.doc_id == 900)
