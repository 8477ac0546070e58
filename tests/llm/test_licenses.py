import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from strataquarry.llm import licenses
from strataquarry.llm import words as W

from .fixtures import prose


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in licenses.scan_licenses(df).collect()}


def folded(text):
    return bytes(W.FOLD[np.frombuffer((text or "").encode(), np.uint8)]).decode("utf-8", "replace").split()


def common(a, b):
    """Length of the longest common subsequence, by the full table."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
        row = new
    return row[-1]


def brute(text, pairs):
    """Licenses whose template some stretch of the text (its length and a quarter more) covers, by full alignment of every stretch."""
    words, out = folded(text), set()
    for name, t in pairs:
        t = folded(t)
        short = len(t) < licenses.WHOLE
        need, reach = len(t) if short else 0.8 * len(t) - 1e-9, len(t) if short else len(t) + max(licenses.BAND, len(t) // 4)
        if len(set(t) & set(words)) >= 0.5 * len(set(t)) and any(common(t, words[a : a + reach]) >= need for a in range(max(1, len(words)))):
            out.add(name)
    return out


def test_every_template_is_found_with_its_span(spark):
    rng = random.Random(1)
    pairs = licenses.templates()
    assert {"Apache-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "BSD-2-Clause"} <= {n for n, _ in pairs}
    texts = [f"ä {prose(rng, 30)}\n{t}\n{prose(rng, 30)}" for _, t in pairs]
    got = scan(spark, texts)
    for i, (name, t) in enumerate(pairs):
        assert name in got[i].licenses.split(",")
        a, b = max(((int(x.split(":")[1]), int(x.split(":")[2])) for x in got[i].spans.split(",") if x.startswith(f"{name}:")), key=lambda s: s[1] - s[0])
        assert folded(texts[i][a:b]) == folded(t)


@pytest.mark.parametrize("kind", ["change", "drop", "add"])
def test_edited_full_texts(spark, kind):
    """A tenth of the words of every template over 100 words changed, dropped or added: found, and covered as far as the full table says."""
    rng = random.Random(7)
    pairs = [p for p in licenses.templates() if 100 < len(p[1].split()) < 700]
    texts, want = [], []
    for _, t in pairs:
        words = t.split()
        for i in sorted(rng.sample(range(len(words)), len(words) // 10), reverse=True):
            words[i : i + (kind != "add")] = [] if kind == "drop" else [f"n{rng.randrange(999)}"]
        texts.append(" ".join([prose(rng, 40), *words, prose(rng, 40)]))
        want.append(common(folded(t), folded(texts[-1])) / len(folded(t)))
    got = scan(spark, texts)
    for i, (name, _) in enumerate(pairs):
        assert name in got[i].licenses.split(",")
        assert got[i].best_coverage >= want[i] - 0.02


def test_names_equal_brute_force(spark):
    rng = random.Random(5)
    pairs = tuple(p for p in licenses.NOTICES if len(p[1].split()) < 60)
    texts = []
    for name, t in pairs:
        for share in (0, 0.1, 0.15, 0.5):
            words = [x if rng.random() >= share else "other" for x in t.split()]
            texts.append(" ".join([prose(rng, 15), *words, prose(rng, 15)]))
    texts += NEGATIVE
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: set(filter(None, r.licenses.split(","))) for r in licenses.scan_licenses(df, pairs).collect()}
    want = {i: brute(t, pairs) for i, t in enumerate(texts)}
    assert got == want


#: Texts that speak of licenses and hold none.
NEGATIVE = [
    "Permission is hereby granted to nobody.",
    "We compared the MIT License with the Apache License, version by version, and the GNU General Public License.",
    "The license of the software is unclear; copyright law differs, all rights are disputed and none reserved.",
    "You may obtain a copy of the book at the shop; either version is licensed under terms we do not know.",
    "Released under the Apache license? No: released under a license of their own.",
    "driving license, fishing license, licensed physician, copyright office",
]


def test_texts_that_only_speak_of_licenses(spark):
    got = scan(spark, [*NEGATIVE, prose(random.Random(3), 500), None, "", "released UNDER the mit   license"])
    assert all(got[i].n_matches == 0 for i in range(len(NEGATIVE) + 3))
    assert got[len(NEGATIVE) + 3].licenses == "MIT"


def test_winnowing_guarantee():
    rng = np.random.default_rng(0)
    for _ in range(50):
        grams = rng.integers(0, 50, 40).astype(np.uint64)
        at = licenses.winnow(grams, 3)
        assert np.diff(at).max(initial=0) <= 3 and at[0] < 3 and at[-1] >= 37


def test_alignment_is_the_longest_chain_in_the_band():
    t = np.arange(10)
    assert licenses.align(t, np.array([99, 98, *range(10)]), 0, 4) == (10, 2, 12)
    assert licenses.align(t, np.array([0, 1, 2, 77, 5, 6, 7, 8, 9]), -4, 4) == (8, 0, 9)
    assert licenses.align(t, np.array([0, 1, 2, 77, 5, 6, 7, 8, 9]), 0, 1)[0] == 3
    assert licenses.align(t, np.array([], int), -2, 2)[0] == 0
    rng = random.Random(4)
    for _ in range(100):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(1, 30))] for _ in range(2))
        assert licenses.align(np.array(a), np.array(b), -99, 99)[0] == common(a, b)


def test_empty_table_repeats_long_texts_ties_and_clashing_columns(spark):
    notice = licenses.NOTICES[0][1]
    long = f"{'word ' * 200_000}{notice}{' x' * 100_000} {notice}"
    rows = [(1, long, "a", 1), (1, long, "a", 1), (2, "y" * 1_000_000, "b", 2), (3, " ".join(t for _, t in licenses.NOTICES[:2]), "c", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, licenses string, n_matches int")
    got = licenses.scan_licenses(df).collect()
    assert sorted((r.doc_id, r.n_matches) for r in got) == [(1, 2), (1, 2), (2, 0), (3, 2)]
    assert got[0].spans == f"MIT:1000000:{1000000 + len(notice) - 1},MIT:{1200001 + len(notice)}:{1200000 + 2 * len(notice)}"
    assert licenses.scan_licenses(df.where("false")).count() == 0
    hit = [(5, 9, "B", 1.0), (5, 9, "A", 1.0), (0, 9, "A", 0.9), (5, 9, "B", 0.8)]
    assert licenses.outermost(hit) == [(0, 9, "A", 0.9), (5, 9, "B", 1.0)]


def test_repetitive_texts_stay_bounded():
    """Phrases of many templates over and over, and templates' words in disorder: seconds, bounded memory, and a real notice between them is found."""
    found = licenses.index(licenses.templates())
    notice = dict(licenses.NOTICES)["MIT"]
    text = "of the gnu general public license " * 60_000 + notice + " of the gnu general public license" * 60_000
    buf, docs = W.buffers(pa.array([text]))
    w = W.split(W.FOLD[buf], docs)
    tracemalloc.start()
    began = time.perf_counter()
    hits = licenses.scan_chunk(found, w, licenses.K)
    took, peak = time.perf_counter() - began, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert took < 120 and peak < 1 << 30, (took, peak)
    mine = [h for h in hits if found.names[h[1]] == "MIT"]
    assert mine and max(h[2] for h in mine) == 1.0 and all(360_000 <= h[3] < h[4] <= 360_000 + len(notice.split()) + 5 for h in mine)


def test_stretches_hold_every_narrow_match():
    """A match in a text of its own template's phrases is the one an unbounded region gives."""
    rng = random.Random(8)
    words = [f"v{rng.randrange(9)}" for _ in range(60)]
    found = licenses.index((("own", " ".join(words)),))
    for _ in range(20):
        phrase = words[10:16]
        parts = [phrase * rng.randrange(0, 60), words, phrase * rng.randrange(0, 60)]
        at = len(parts[0])
        buf, docs = W.buffers(pa.array([" ".join(x for p in parts for x in p)]))
        hits = licenses.scan_chunk(found, W.split(W.FOLD[buf], docs), licenses.K)
        assert any(h[2] == 1.0 and h[3] <= at + 20 and h[4] >= at + 40 for h in hits)
