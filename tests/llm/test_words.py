import re

import numpy as np
import pyarrow as pa

from strataquarry.llm import words as W

from .fixtures import corpus

WORD = re.compile("[^\x20\x09-\x0d]+")


def _split(texts):
    buf, docs = W.buffers(pa.array(texts, pa.string()))
    return W.split(buf, docs)


def test_words_are_matches_of_the_pattern():
    texts = [t for _, t, *_ in corpus()]
    w = _split(texts)
    raw = w.buf.tobytes()
    for i, t in enumerate(texts):
        got = [raw[a:b].decode() for a, b in zip(w.starts[w.first[i] : w.first[i + 1]], w.ends[w.first[i] : w.first[i + 1]])]
        assert got == WORD.findall(t or "")


def test_equal_words_hash_alike_and_others_apart():
    w = _split(["b a b", "", "a", "ab ba"])
    names = [w.buf[a:b].tobytes() for a, b in zip(w.starts, w.ends)]
    seen = {}
    for n, h in zip(names, w.hashes.tolist()):
        assert seen.setdefault(n, h) == h
    assert len(set(seen.values())) == len(seen)


def test_runs_agree_wherever_they_stand():
    w = _split(["x y z", "q x y z"])
    runs = W.Runs(w.hashes)
    assert runs.of(np.array([0]), np.array([3])) == runs.of(np.array([4]), np.array([7]))
    assert runs.grams(3)[0] == runs.of(np.array([0]), np.array([3]))[0]
    assert W.whole(w.first, 3).tolist() == [True, False, False, True, True]


def test_chunks_cover_all_rows():
    sizes = np.array([5, 0, 200, 1, 1])
    assert list(W.chunks(sizes, 10)) == [(0, 2), (2, 3), (3, 5)]
    assert list(W.chunks(np.array([], int), 10)) == []


def test_blocks_of_long_words_do_not_commute():
    n = len(W._PLACE)
    parts = ["a" * n + "b" * n, "b" * n + "a" * n, "a" * n, "a" * 2 * n, "a" * (2 * n + 1), "a" * n + "b", "b" + "a" * n]
    parts += ["c" * n + "a" * n + "b" * n, "c" * n + "b" * n + "a" * n, "ab" * n, "ba" * n]
    w = _split([" ".join(parts), *parts])
    once, alone = w.hashes[: len(parts)], w.hashes[len(parts) :]
    assert once.tolist() == alone.tolist()
    assert len(set(once.tolist())) == len(parts)
