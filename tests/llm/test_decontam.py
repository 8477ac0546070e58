import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strataquarry.llm import decontam
from strataquarry.llm import words as W

from .fixtures import prose


def nearest(item, text):
    """Least edits of item against any run of text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_bit_parallel_distance_equals_the_table():
    rng = random.Random(2)
    for _ in range(200):
        item, text = ([rng.randrange(4) for _ in range(n)] for n in (rng.randrange(1, 70), rng.randrange(0, 90)))
        found = decontam.fit_in(np.array(item), np.array(text, int), len(item))
        best = nearest(item, text)
        assert found[2] == best
        assert nearest(item, text[found[0] : found[1]]) == best


def spoil(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        i = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[i] = f"n{rng.randrange(9999)}"
        elif kind == 1:
            del out[i]
        else:
            out.insert(i, f"n{rng.randrange(9999)}")
    return out


def test_recall_against_brute_force(spark):
    rng = random.Random(4)
    items = [(i, prose(rng, rng.randrange(12, 60))) for i in range(40)]
    data, want = [], {}
    for d in range(240):
        item, text = items[d % 40], items[d % 40][1].split()
        leak = spoil(rng, text, rng.randrange(0, len(text) // 5 + 1)) if d % 3 else []
        words = prose(rng, rng.randrange(0, 50)).split() + leak + prose(rng, rng.randrange(0, 50)).split()
        data.append((d, " ".join(words)))
        want[d] = {i for i, t in items if nearest(t.split(), words) <= int(0.2 * len(t.split()) + 1e-9)}
        assert not leak or item[0] in want[d]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("start", F.lit(1))
    got = {r.doc_id: {x.item_id for x in r._leaks} for r in decontam.mark_leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert all(got[d] <= want[d] for d in got)
    assert sum(len(got[d]) for d in got) >= 0.97 * sum(len(want[d]) for d in want)
    exact = [d for d in want if any(t in data[d][1] for _, t in items)]
    assert all(got[d] for d in exact)


def test_blocks_edges_and_empties(spark, monkeypatch):
    item = " ".join(f"k{i}" for i in range(20))
    docs = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "k0 k1 k2"), (None, f"x {item} y")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, item), (9, None), (None, item), (10, "too short")], "item_id long, text string")
    for size in (8_000_000, 10):
        got = {r.doc_id: sorted((x.item_id, x.start, x.end, x.distance) for x in r._leaks) for r in decontam.mark_leaks(docs, bench).collect()}
        assert got == {1: [(7, 0, 20, 0), (8, 0, 20, 0)], 2: [], 3: [], 4: [], None: [(7, 1, 21, 0), (8, 1, 21, 0)]}
        monkeypatch.setattr(decontam.blocks, "__defaults__", (size and 10,))
    assert decontam.mark_leaks(docs, bench.where("false"), with_text=False).columns == ["doc_id", "_leaks"]
    assert decontam.mark_leaks(docs.where("false"), bench).count() == 0


def test_short_leaks_alone_in_their_partition(spark):
    rng = random.Random(11)
    items = [(i, prose(rng, 30)) for i in range(12)] + [(99, prose(rng, 59))]
    data = [(i, f"{prose(rng, 20)} {text} {prose(rng, 20)}") for i, text in items[:12]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for d, text in data:
        alone = spark.createDataFrame([(d, text)], "doc_id long, text string").coalesce(1)
        assert [x.item_id for r in decontam.mark_leaks(alone, bench).collect() for x in r._leaks] == [d]


def test_no_leak_at_the_edit_limit_is_lost(spark):
    rng = random.Random(12)
    items = [(i, prose(rng, n, 4000)) for i, n in enumerate([12, 30, 59, 100, 200] * 4)]
    data = []
    for i, text in items:
        words = text.split()
        chosen = set(rng.sample(range(len(words)), len(words) // 5))
        fewer = [x for j, x in enumerate(words) if j not in chosen]
        other = [f"n{j}" if j in chosen else x for j, x in enumerate(words)]
        for leak in (fewer, other, spoil(rng, words, len(chosen))):
            data.append((i, " ".join([prose(rng, 40), *leak, prose(rng, 40)])))
    marked = decontam.mark_leaks(spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert all([x.item_id for x in r._leaks] == [r.doc_id] for r in marked.collect())


def test_partitions_and_batches_change_nothing(spark):
    rng = random.Random(13)
    items = [(i, prose(rng, n)) for i, n in enumerate([12, 20, 30, 45, 59, 100, 200, 300])]
    data = [(j, " ".join([prose(rng, rng.randrange(40)), *(spoil(rng, t.split(), len(t.split()) // 6) if j % 2 else [t]), prose(rng, 9)])) for j, (_, t) in enumerate(items * 6)]
    data += [(100 + j, prose(rng, 80)) for j in range(30)]
    bench, docs = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(data, "doc_id long, text string")
    found = []
    for n in (1, 7, 64):
        rows = decontam.mark_leaks(docs.repartition(n), bench).select("doc_id", "_leaks").collect()
        found.append(sorted((r.doc_id, sorted(map(tuple, r._leaks))) for r in rows))
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    found.append(sorted((r.doc_id, sorted(map(tuple, r._leaks))) for r in decontam.mark_leaks(docs.coalesce(1), bench).select("doc_id", "_leaks").collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    assert all(x == found[0] for x in found)
    leaks = dict(found[0])
    assert all(any(x[0] == j % 8 for x in leaks[j]) for j in range(0, 48, 2))


@pytest.mark.parametrize("kind", [0, 1, 2, 3])
@pytest.mark.parametrize("size", [12, 30, 59, 100])
def test_walks_alone_reach_their_recall(size, kind):
    """Leaks other than those the walks were counted on, at the full number of edits, through keys only."""
    rng = np.random.Generator(np.random.PCG64(1_000 + size * 4 + kind))
    edits, walks = int(decontam._allowed(size, 0.8)), decontam.walks_for(decontam._stands_for(size), 0.8, 0.99)
    assert 0 < walks <= decontam.MOST_WALKS
    met = 0
    for _ in range(100):
        item = rng.integers(1, 1 << 62, size, dtype=np.uint64)
        text = np.concatenate([rng.integers(1, 1 << 62, edits, dtype=np.uint64), decontam._edited(rng, item, edits, kind), rng.integers(1, 1 << 62, size, dtype=np.uint64)])
        starts, sizes = np.arange(2 * edits + 1), np.full(2 * edits + 1, size)
        for walk in range(walks):
            own = decontam.sampled(decontam.embed(item, np.zeros(1, int), np.full(1, size), walk, 2 * size), np.full(1, size), walk)
            if (decontam.sampled(decontam.embed(text, starts, sizes, walk, 2 * size), sizes, walk) == own).any():
                met += 1
                break
    assert met >= 97


def test_long_texts_repeats_ties_and_clashing_columns(spark):
    rng = random.Random(14)
    item = prose(rng, 30, 5_000)
    long = " ".join([prose(rng, 60_000, 9_000), item, prose(rng, 60_000, 9_000), item])
    rows = [(1, long, "a", 5), (1, long, "a", 5), (2, "w" * 300_000, "b", 6), (3, "k0 " * 50_000, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string, _leaks int")
    got = decontam.mark_leaks(docs, spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert got.columns == ["doc_id", "text", "item_id", "_leaks"]
    assert sorted((r.doc_id, len(r._leaks)) for r in got.collect()) == [(1, 2), (1, 2), (2, 0), (3, 0)]
    kept = decontam.mark_leaks(docs, spark.createDataFrame([(7, item)], "item_id long, text string"), into="found")
    assert sorted(r._leaks or 0 for r in kept.collect()) == [0, 5, 5, 6]


def chunk(text):
    buf, docs = W.buffers(pa.array([text]))
    return W.split(W.FOLD[buf], docs)


def test_every_copy_of_an_item_is_a_leak():
    """Two and three copies in a row, some words apart, one of them edited; all are reported, in order and without overlap."""
    rng = random.Random(6)
    item = [f"i{rng.randrange(300)}" for _ in range(40)]
    index = decontam.build([(5, " ".join(item))], 0.8, 8)
    other = list(item)
    other[7] = other[20] = "changed"
    for apart in (0, 1, 3, 20, 80):
        gap = [f"g{rng.randrange(9999)}" for _ in range(apart)]
        for parts in ([item, item], [item, other], [other, item, item]):
            words = [f"a{i}" for i in range(15)]
            want = []
            for p in parts:
                want.append((len(words), len(words) + 40, 2 if p is other else 0))
                words += p + gap
            found = decontam.find(index, chunk(" ".join(words)))
            assert [x[2:] for x in sorted(found, key=lambda x: x[2])] == want, (apart, len(parts))


def zipf_words(rng, n, vocabulary, power=1.0):
    weights = 1 / np.arange(1, vocabulary + 1) ** power
    return [f"z{x}" for x in rng.choice(vocabulary, n, p=weights / weights.sum())]


def test_many_items_of_common_words():
    """20,000 items over words by 1/rank, and some where a quarter of all words are one: cost follows what meets, and each planted leak is found."""
    rng = np.random.default_rng(4)
    items = [zipf_words(rng, 50, 20_000) for _ in range(20_000)]
    items[:200] = [[w if rng.random() > 0.25 else "the" for w in x] for x in items[:200]]
    text, want = [], set()
    for k in range(60):
        leak = list(items[k * 3])
        for at in rng.choice(50, k % 9, replace=False):
            leak[at] = f"edit{k}"
        want.add(k * 3)
        text += ["the" if rng.random() < 0.25 else w for w in zipf_words(rng, 3000, 20_000)] + leak
    began = time.perf_counter()
    index = decontam.build([(i, " ".join(x)) for i, x in enumerate(items)], 0.8, 8)
    built = time.perf_counter() - began
    w = chunk(" ".join(text))
    tracemalloc.start()
    found = decontam.find(index, w)
    peak, took = tracemalloc.get_traced_memory()[1], time.perf_counter() - began - built
    tracemalloc.stop()
    assert {x[1] for x in found} >= want and len(found) < 2 * len(want)
    assert peak < 1 << 30 and took < 120, (peak, took, built)
