import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strataquarry.llm import words as W
from strataquarry.llm.substring_dedup import compacted, substring_dedup

from .fixtures import DOCS, corpus, prose


def brute(texts, k):
    docs = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(d[i : i + k]) for d in docs for i in range(len(d) - k + 1))
    out = []
    for d in docs:
        gone = [False] * len(d)
        for i in range(len(d) - k + 1):
            if seen[tuple(d[i : i + k])] > 1:
                gone[i : i + k] = [True] * k
        out.append((len(d), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(d, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize(("window", "k"), [(35, 8), (10, 4), (5, 5)])
def test_equals_brute_force(spark, window, k):
    data = corpus()
    df = spark.createDataFrame(data, DOCS).repartition(5)
    got = {r[0]: tuple(r[1:4]) for r in substring_dedup(df, window, k).collect()}
    assert got == dict(enumerate(brute([r[1] for r in data], window)))


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    text = " ".join(f"t{i}" for i in range(50))
    data = [(1, text), (1, text), (None, "solo words"), (None, None)]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumns({"key": F.lit(1), "spans": F.lit(2), "node": F.lit(3)})
    got = sorted((r[0] or -1, r.n_words, r.n_removed) for r in substring_dedup(df).collect())
    assert got == [(-1, 0, 0), (-1, 2, 0), (1, 50, 50), (1, 50, 50)]


def test_kept_text_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a  b\nc")], "doc_id long, text string")
    assert substring_dedup(df, with_text=True).first().kept_text == "a b c"
    assert substring_dedup(df.where("false")).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 12])
def test_colliding_hashes_change_nothing(spark, bits):
    """With hashes of a few bits nearly everything collides; the words at the source coordinates decide."""
    rng = random.Random(bits)
    texts = [r[1] for r in corpus(bits, 25)][:-1] + [" ".join(rng.choice("ab") for _ in range(60)) for _ in range(12)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r[0]: tuple(r[1:4]) for r in substring_dedup(df, 12, 4, bits=bits).collect()}
    assert got == dict(enumerate(brute(texts, 12)))


def test_words_of_all_lengths(spark):
    rng = random.Random(3)
    n = len(W._PLACE)
    tail = " ".join(f"t{i}" for i in range(34))
    texts = [f"{'a' * n + 'b' * n} {tail}", f"{'b' * n + 'a' * n} {tail}"]
    pool = ["".join(rng.choice("xyé") for _ in range(rng.choice([1, 2, 7, 300, n - 1, n, n + 1, 20_000]))) for _ in range(40)]
    shared = " ".join(rng.choice(pool) for _ in range(40))
    texts += [" ".join([prose(rng, 5), shared, prose(rng, 5)]) for _ in range(2)] + [" ".join(rng.choice(pool) for _ in range(60)) for _ in range(4)] + ["z" * 2_000_000, " " * 1_000_000 + "w"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: tuple(r[1:4]) for r in substring_dedup(df).collect()}
    assert got == dict(enumerate(brute(texts, 35)))
    assert got[0][1] == got[1][1] == 0 and got[2][1] == got[3][1] == 40


def test_compaction_equals_brute_force(spark):
    """Paths by plain loops: neighbours that always follow each other are one path, everywhere."""
    rng = random.Random(8)
    unit = {u: [(u * 10 + i, 1, rng.randrange(1, 4)) for i in range(rng.randrange(1, 6))] for u in range(6)}
    rows = []
    for t in range(12):
        lo = 0
        for _ in range(rng.randrange(1, 7)):
            if rng.random() < 0.2:
                lo += 1  # a gap: words that nothing repeats
            for node, edge, size in unit[rng.randrange(6)]:
                rows.append((f"t{t}".encode(), node, edge, lo, lo + size - 1))
                lo += size
    places = {(r[0], r[3]): r for r in rows}
    after = {r: places.get((r[0], r[4] + 1)) for r in rows}
    n = Counter(r[1:3] for r in rows)
    met = Counter((r[1:3], a[1:3]) for r, a in after.items() if a)
    linked = {(p, q) for (p, q), c in met.items() if c == n[p] == n[q]}
    inner = {a for r, a in after.items() if a and (r[1:3], a[1:3]) in linked}
    want = []
    for r in rows:
        if r not in inner:
            end = r
            while after[end] and (end[1:3], after[end][1:3]) in linked:
                end = after[end]
            want.append((r[0], r[1], r[2], r[3], end[4]))
    df = spark.createDataFrame(rows + rows[:5], "key binary, node long, edge long, lo int, hi int").repartition(5)
    got = [(bytes(r.key), r.node, r.edge, r.lo, r.hi) for r in compacted(df).collect()]
    assert sorted(got) == sorted(want) and len(want) < len(rows)
