"""Vectorised words over Arrow string buffers.

A word is a maximal run of bytes other than space and \\t \\n \\v \\f \\r, so words of UTF-8 text equal matches of
``[^\\x20\\x09-\\x0D]+``. Everything here is numpy over whole batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes with ASCII letters in lower case and other ASCII but digits as blanks.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[[i for i in range(128) if not chr(i).isalnum()]] = 32
_rng = np.random.Generator(np.random.PCG64(20_240_607))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[_SPACE] = 0
_PLACE = _rng.integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_S33 = np.uint64(33)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser over 64 bits; distinct inputs keep distinct outputs."""
    h = h ^ (h >> _S33)
    h = h * _MIX1
    h ^= h >> _S33
    h *= _MIX2
    h ^= h >> _S33
    return h


@dataclass
class Words:
    buf: np.ndarray  # bytes of all documents, back to back
    docs: np.ndarray  # byte offset of each document, one more than documents
    starts: np.ndarray  # byte offset of each word
    ends: np.ndarray
    first: np.ndarray  # word index at which each document begins, one more than documents
    hashes: np.ndarray  # 64 bits a word

    @property
    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; nulls are empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_string())
    if arr.null_count:
        arr = arr.fill_null("")
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    data = arr.buffers()[2] if len(arr) else None
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(n_bytes: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes; one longer document makes a range of its own."""
    at, n = 0, len(n_bytes)
    sums = np.concatenate([[0], np.cumsum(n_bytes)])
    while at < n:
        to = max(at + 1, int(np.searchsorted(sums, sums[at] + most, "right")) - 1)
        yield at, to
        at = to


def pieces(batch: pa.RecordBatch, column: str = "text", most: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with the bytes and offsets of their texts."""
    buf, docs = buffers(batch.column(batch.schema.get_field_index(column)))
    for a, b in chunks(np.diff(docs), most):
        yield batch.slice(a, b - a), buf[docs[a] : docs[b]], docs[a : b + 1] - docs[a]


def split(buf: np.ndarray, docs: np.ndarray, space: np.ndarray = _SPACE, hashed: bool = True) -> Words:
    n = len(buf)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(buf, docs, none, none, np.zeros(len(docs), np.int64), np.zeros(0, np.uint64))
    gap = space[buf]
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = gap[:-1]
    inner = docs[:-1][docs[:-1] < n]
    before[inner] = True
    starts = np.flatnonzero(before & ~gap)
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = gap[1:]
    last = docs[1:][docs[1:] > 0] - 1
    after[last] = True
    ends = np.flatnonzero(after & ~gap) + 1
    first = np.searchsorted(starts, docs).astype(np.int64)
    return Words(buf, docs, starts, ends, first, word_hashes(buf, starts, ends, gap) if hashed else np.zeros(0, np.uint64))


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """64 bits a word. Bytes weigh by their place in a block of len(_PLACE) bytes; blocks of longer words weigh by their number."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size, most = ends - starts, len(_PLACE)
    place = np.arange(len(buf), dtype=np.int32)
    place[starts[0] :] -= np.repeat(starts.astype(np.int32), np.diff(np.append(starts, len(buf))))
    place &= most - 1
    value = _BYTE[buf]
    value[gap] = 0
    value *= _PLACE[place]
    if int(size.max()) <= most:
        return mix(np.add.reduceat(value, starts) + size.astype(np.uint64) * _MIX2)
    n = -(-size // most)
    word = np.repeat(np.arange(len(starts)), n)
    number = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)
    block = np.add.reduceat(value, starts[word] + number * most)
    later = number > 0
    block[later] = mix(block[later] + mix(number[later].astype(np.uint64)))
    return mix(np.add.reduceat(block, np.cumsum(n) - n) + size.astype(np.uint64) * _MIX2)


class Runs:
    """Hashes of any run of consecutive words in constant time, by prefix sums of a polynomial."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        up = np.full(n, _BASE, np.uint64)
        down = np.full(n + 1, _INVERSE, np.uint64)
        if n:
            up[0] = 1
        down[0] = 1
        self.down = np.multiply.accumulate(down)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * np.multiply.accumulate(up), out=self.sums[1:])

    def of(self, at: np.ndarray, to: np.ndarray) -> np.ndarray:
        return mix((self.sums[to] - self.sums[at]) * self.down[at])

    def grams(self, k: int) -> np.ndarray:
        """One hash for each start of k words; runs over document bounds are for the caller to mask."""
        n = len(self.sums) - 1
        if n < k:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:-k]) * self.down[: n - k + 1])


def whole(first: np.ndarray, k: int) -> np.ndarray:
    """Mask over starts 0..n-k of those whose k words lie in one document."""
    n = int(first[-1])
    if n < k:
        return np.zeros(0, bool)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return doc[: n - k + 1] == doc[k - 1 :]
