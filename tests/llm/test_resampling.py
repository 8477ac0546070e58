import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataquarry.llm import resampling as rs
from strataquarry.llm.runtime import cut

from .fixtures import prose


def brute(docs, target, percent, min_words, buckets=10_000, most=1, seed=2024):
    def words(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    def found(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, most + 1) for i in range(len(w) - k + 1)]

    raw, goal = [0] * buckets, [0] * buckets
    for counts, texts in ((raw, [t for _, t in docs]), (goal, target)):
        for t in texts:
            for b in found(t):
                counts[b] += 1
    gain = [math.floor(1000 * math.log((t + 1) * (sum(raw) + buckets) / ((s + 1) * (sum(goal) + buckets)))) for s, t in zip(raw, goal, strict=True)]
    out = []
    for i, t in docs:
        f = found(t)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(t))])
    order = sorted((x for x in out if x[5] >= min_words), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1]))
    for place, x in enumerate(order[: percent * len(order) // 100]):
        x[4] = place + 1
    return sorted((tuple(x[:5]) for x in out), key=repr)


def test_registers_extend_like_zlib():
    rng = random.Random(5)
    texts = [bytes(rng.randrange(256) for _ in range(n)) for n in (0, 1, 2, 63, 64, 65, 300, 7, 0, 5)]
    buf, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    starts = ends - np.array([len(t) for t in texts])
    got = rs.crc_extend(np.full(len(texts), 0xFFFFFFFF, np.uint32), buf, starts, ends)
    assert [int(x) ^ 0xFFFFFFFF for x in got] == [zlib.crc32(t) for t in texts]
    more = rs.crc_extend(got, np.frombuffer(b"tail", np.uint8), starts * 0, starts * 0 + 4)
    assert [int(x) ^ 0xFFFFFFFF for x in more] == [zlib.crc32(t + b"tail") for t in texts]


@pytest.mark.parametrize("most", [1, 2, 3])
def test_equals_brute_force(spark, most, monkeypatch):
    monkeypatch.setattr(rs, "BLOCK", 7)
    rng = random.Random(most)
    docs = [(i, prose(rng, rng.randrange(1, 60))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, "Ärger 9x_Y 日本 " * 20), (303, "a" * 70_000 + " B b"), (None, prose(rng, 40)), (None, None), (17, docs[17][1]), (17, prose(rng, 30)), (304, prose(rng, 20_000))]
    target = [prose(rng, 50, 40) for _ in range(6)] + [None, ""]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"rank": F.lit(1), "score": F.lit("x"), "run": F.lit(2)}).repartition(5)
    got = rs.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), percent=35, min_words=10, buckets=500, most_words=most).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs, target, 35, 10, 500, most)


def test_one_score_fills_many_ranges(spark, monkeypatch):
    """A score that most rows share is cut by ids; copies of one row, id included, take neighbouring ranks."""
    monkeypatch.setattr(rs, "BLOCK", 5)
    monkeypatch.setattr(rs, "RANGE", 20)
    rows = [(i, 30, 30, 5, 100) for i in range(500)] + [(1000 + i, 30, 30, i % 9, 90 + i) for i in range(40)] + [(7, 30, 30, 5, 100)] * 60 + [(None, 30, 30, 5, 100)] * 3 + [(2000 + i, 3, 3, 9, 999) for i in range(5)]
    scored = cut(spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long").repartition(6))
    got = rs.rank_draw(scored, percent=80, min_words=20).collect()
    ranked = sorted((r["rank"], -r.score, r.doc_id is None, r.doc_id or 0) for r in got if r["rank"])
    total = len(rows) - 5
    want = sorted((-s, i is None, i or 0) for i, n, _, _, s in rows if n >= 20)[: 80 * total // 100]
    assert [x[1:] for x in ranked] == want and [x[0] for x in ranked] == list(range(1, len(want) + 1))
    assert len(got) == len(rows)
    everything = rs.rank_draw(scored, percent=100, min_words=0).collect()
    assert sorted(r["rank"] for r in everything) == list(range(1, len(rows) + 1))


def test_merge_holds_only_what_overlaps():
    """Blocks of many runs in the order of their first rows: a block is open while its rows may be next, and merging stops on time."""
    rng = random.Random(3)
    runs = [sorted((rng.randrange(10_000),) for _ in range(400)) for _ in range(9)]
    blocks = sorted((run[i : i + 10] for run in runs for i in range(0, 400, 10)), key=lambda b: b[0])
    opened = []
    tree = rs.Tournament
    most = 0

    class Watched(tree):
        def add(self, rows):
            nonlocal most
            super().add(rows)
            opened.append(rows[0])
            most = max(most, sum(b is not None for b in self.blocks))

    rs.Tournament = Watched
    try:
        out = list(rs.merge(iter(blocks), 1000))
    finally:
        rs.Tournament = tree
    everything = sorted(x for run in runs for x in run)
    assert [x for p, x in out if p is not None] == everything[:1000] and sorted(x for _, x in out) == everything
    assert most <= 2 * len(runs) and len(opened) < len(blocks) / 2
    assert list(rs.merge(iter([]), 5)) == [] and [p for p, _ in rs.merge(iter(blocks[:2]), 0)] == [None] * 20


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert rs.resample(none, none.select("text")).count() == 0
    out = rs.resample(spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), none.select("text"), percent=100, min_words=1).collect()
    assert [tuple(r)[:2] + (r["rank"],) for r in out] == [(1, 3, 1)]
