import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strataquarry.llm import packing

from .fixtures import DOCS, corpus


@cache
def reference():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_rank_file_gives_the_same_ids(text):
    assert list(packing.encoder()(text)) == reference()(text)


def test_every_code_point_in_context():
    encode, want = packing.encoder(), reference()
    for c in [*range(0, 0x3000), *range(0x3000, 0xD800, 37), *range(0xE000, 0x110000, 61)]:
        text = f"a{chr(c)}b1{chr(c)}2  {chr(c)}  .{chr(c)}!'{chr(c)}"
        assert list(encode(text)) == want(text), hex(c)


def test_added_token_has_its_id():
    assert list(packing.encoder()("a<|endoftext|>b")) == reference()("a<|endoftext|>b") == [64, 50256, 65]


@pytest.mark.parametrize("text", [" " * 2_000_000, "x" * 2_000_000, "\n" * 300_000 + "a", "\u00a0" * 300_000, "a" + " \t" * 20_000 + "b"])
def test_very_long_runs(text):
    assert list(packing.encoder()(text)) == reference()(text)


def check(pieces, texts, size):
    ids = {i: np.array([*reference()(t or ""), 1], "<u4") for i, t in enumerate(texts)}
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    assert set(docs) == set(ids)
    for i, found in docs.items():
        at = 0
        for p in sorted(found, key=lambda p: p.start):
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids[i]), zlib.crc32(ids[i][at : at + p.length].tobytes()))
            at += p.length
        assert at == len(ids[i])
    for found in sequences.values():
        at = 0
        for p in sorted(found, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= size
    return len(sequences), sum(map(len, ids.values()))


def test_every_id_lies_in_one_piece(spark):
    data = corpus()
    df = spark.createDataFrame(data, DOCS).repartition(3)
    n, tokens = check(packing.pack(df).collect(), [r[1] for r in data], 2048)
    assert tokens / (2048 * n) > 0.9
    n, tokens = check(packing.pack(df, size=64, open_windows=4, max_gap=2, merge_span=2).collect(), [r[1] for r in data], 64)
    assert tokens / (64 * n) > 0.97


@given(st.lists(st.integers(1, 400), max_size=80), st.integers(1, 6), st.integers(0, 30))
def test_packer_never_overfills(lengths, most, gap):
    p = packing.Packer(100, most, gap)
    used = defaultdict(int)
    for n in lengths:
        pieces = p.place(n)
        assert sum(x[3] for x in pieces) == n
        for window, offset, _, length in pieces:
            assert used[window] == offset
            used[window] += length
        assert len(p.room) <= most
    assert all(v <= 100 for v in used.values())


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], DOCS)).count() == 0


def test_long_texts_ties_repeats_and_clashing_columns(spark):
    texts = [" " * 1_100_000, "same words here", "same words here", None, "", "<|endoftext|>" * 50]
    rows = [(i, t, 1, "p", 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, part int, window string, leftover int")
    check(packing.pack(df).collect(), texts, 2048)
    again = spark.createDataFrame([(None, "a b"), (None, "a b"), (4, None), (4, None)], "doc_id long, text string")
    out = packing.pack(again).collect()
    assert sorted((p.doc_id or -1, p.length) for p in out) == [(-1, 3), (-1, 3), (4, 1), (4, 1)]
