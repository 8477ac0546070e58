"""Bounded-space online packing of token sequences.

Each partition keeps at most `open_windows` windows open. A piece goes where it leaves least room (best fit). When it fits
nowhere the fullest window is emitted; if more than `max_gap` tokens would be padding there, the piece's head fills the gap
first. Documents beyond one window are cut into whole windows and a rest. At the end a partition's open windows are
merged with those of its neighbours (`merge_span` partitions together), so the leftovers stay bounded too.

Ids are those of the byte-level BPE file as `tokenizers` reads it. The rank file of the same vocabulary gives equal ids at a
third of the time, but not for the file's added tokens and not for very long runs of white space (its pattern engine has no
room for them): such texts go to `tokenizers` itself, and tests hold both against each other.

Defined results: null or empty text is the single end id 1; a text of any length is cut into pieces, whatever it is made of;
repeated rows (and rows with equal or null doc_id) are packed each; documents of equal length keep the order of their
partition; other columns, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import bisect
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import cut, small_batches

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, window int, offset long, leftover boolean"
END = 1
#: White-space runs of this length are left to `tokenizers`.
LONG_GAP = 10_000
_GAP = re.compile(rf"\s{{{LONG_GAP}}}")
_encoders: dict[tuple[str, str], Callable[[str], list[int]]] = {}


def encoder(path: str | None = None, ranks: str | None = None) -> Callable[[str], list[int]]:
    """Ids by the tokenizer file at `path` (the public 50k byte-level one if none is named). `ranks`: its rank file, if there is one."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    if path is None:
        path, ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    if (path, ranks) in _encoders:
        return _encoders[path, ranks]
    exact = Tokenizer.from_file(path)
    added = tuple(t.content for t in exact.get_added_tokens_decoder().values())

    def by_file(text: str) -> list[int]:
        return exact.encode(text, add_special_tokens=False).ids

    encode = by_file
    if ranks:
        with open(ranks, "rb") as f:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary

        def encode(text: str) -> list[int]:
            if any(token in text for token in added) or len(text) >= LONG_GAP and _GAP.search(text):
                return by_file(text)
            return fast(text)

    _encoders[path, ranks] = encode
    return encode


class Packer:
    """Open windows of one partition. place() returns (window, offset, start, length) for each piece of a document."""

    def __init__(self, size: int, open_windows: int, max_gap: int):
        self.size, self.most, self.max_gap = size, open_windows, max_gap
        self.room: list[tuple[int, int]] = []  # (room left, window), sorted
        self.windows = 0

    def _put(self, at: int, n: int) -> tuple[int, int]:
        room, window = self.room.pop(at)
        if room > n:
            bisect.insort(self.room, (room - n, window))
        return window, self.size - room

    def place(self, n: int) -> list[tuple[int, int, int, int]]:
        out, start = [], 0
        while n:
            take = min(n, self.size)
            if take < self.size:
                at = bisect.bisect_left(self.room, (take, -1))
                if at == len(self.room):
                    if len(self.room) < self.most:
                        self.room.append((self.size, self.windows))
                        self.windows += 1
                    else:
                        room = self.room[0][0]
                        if room <= self.max_gap:
                            self.room.pop(0)  # emitted as it is
                            continue
                        at, take = 0, room
                window, offset = self._put(at, take)
            else:
                window, offset = self.windows, 0
                self.windows += 1
            out.append((window, offset, start, take))
            start += take
            n -= take
        return out

    def leftovers(self) -> list[int]:
        """Windows still open with more room than padding may take."""
        return [window for room, window in self.room if room > self.max_gap]


def _pack(size: int, open_windows: int, max_gap: int, path: str | None, ranks: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer, part = encoder(path, ranks), Packer(size, open_windows, max_gap), TaskContext.get().partitionId()
        pending: list[tuple] = []  # pieces in windows that may still be open
        names = [x.split()[0] for x in PIECES.split(", ")]

        def batch_of(rows: list[tuple], leftover: set[int]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 5 + [pa.int32(), pa.int32(), pa.int64()]
            return pa.record_batch([*(pa.array(c, k) for c, k in zip(cols, kinds, strict=True)), pa.array([r[6] in leftover for r in rows])], names=names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array(encode(text.as_py() or "") + [END], "<u4")
                for window, offset, start, n in packer.place(len(ids)):
                    pending.append((doc_id, start, n, zlib.crc32(ids[start : start + n].tobytes()), len(ids), part, window, offset))
            still = {window for _, window in packer.room}
            done = [r for r in pending if r[6] not in still]
            pending = [r for r in pending if r[6] in still]
            if done:
                yield batch_of(done, set())
        if pending:
            yield batch_of(pending, set(packer.leftovers()))

    return run


def _merge(size: int):
    def run(pdf):
        """Best fit, largest first, of leftover windows."""
        import pandas as pd

        pdf = pdf.sort_values(["used", "part", "window"], ascending=[False, True, True])
        room: list[tuple[int, int]] = []
        rows, bins = [], 0
        for g, part, window, used in zip(pdf.g, pdf.part, pdf.window, pdf.used, strict=True):
            at = bisect.bisect_left(room, (used, -1))
            left, b = room.pop(at) if at < len(room) else (size, bins)
            bins += b == bins
            rows.append((part, window, (1 << 62) + (int(g) << 32) + b, size - left))
            if left > used:
                bisect.insort(room, (left - used, b))
        return pd.DataFrame(rows, columns=["part", "window", "merged", "base"])

    return run


def pack(documents: DataFrame, size: int = 2048, open_windows: int = 32, max_gap: int = 24, merge_span: int = 64, tokenizer: str | None = None, ranks: str | None = None) -> DataFrame:
    """Pieces of every document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    small_batches(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = cut(rows.mapInArrow(_pack(size, open_windows, max_gap, tokenizer, ranks), PIECES))
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    loose = pieces.where("leftover")
    used = loose.groupBy("part", "window").agg(F.sum("length").alias("used")).withColumn("g", F.expr(f"part div {merge_span}"))
    moved = used.groupBy("g").applyInPandas(_merge(size), "part int, window int, merged long, base long")
    merged = loose.join(moved, ["part", "window"]).select(*keep, F.col("merged").alias("sequence_id"), (F.col("base") + F.col("offset")).alias("offset"))
    own = F.shiftleft(F.col("part").cast("long"), 32) + F.col("window")
    return pieces.where("not leftover").select(*keep, own.alias("sequence_id"), "offset").unionByName(merged)
