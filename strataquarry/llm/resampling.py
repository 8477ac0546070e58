"""Importance resampling towards a target distribution.

Words are runs of ASCII letters and digits and of everything beyond ASCII, with A-Z lower-cased; features are all runs of one
to `most_words` consecutive words. A feature's bucket is the CRC-32 of its UTF-8 bytes modulo `buckets`. One pass counts the
buckets of the documents, one those of the target; their smoothed log ratio in thousandths, rounded down, is a bucket's gain.
A second pass over the documents looks the gains up in an array and averages them to a weight, and Gumbel noise from the
document's id makes the weight a score, so that the highest scores are a sample without replacement.

The draw never gathers: scores are integers between bounds that `buckets` and 64-bit counts set (under 2^18 values), so their
histogram gives the number of documents to draw and the lowest score that is drawn, whatever the input's size. Eligible rows
from that score on are sorted within their partition into runs, which are cut at range bounds into blocks and written. Each
range is one task that merges its blocks by a tournament tree. Blocks come in the order of their first row, so a block is
opened when its first row is the next to leave and closed when it is used up: a task holds the blocks that overlap, never its
range. A range starts ranking behind the sizes of those before it, and stops merging once the draw is complete.
A score that more rows share than a range should hold is cut further by quantiles of its document ids.

Defined results: null or empty text has no features and weight 0; texts and words of any length are read whole; equal scores
rank by doc_id, those without an id last, then by n_features, and rows alike in all of it take neighbouring ranks in any order; a missing id reads as the empty
text where it is hashed; repeated rows count each; other columns, whatever their names, are ignored; an empty table gives an
empty result, an empty target gains of its smoothing alone.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import cut, small_batches
from .words import FOLD, pieces, split, whole

BUCKETS, MIN_WORDS, PERCENT, SEED = 10_000, 20, 10, 2024
#: Rows of a block, and rows a range should hold.
BLOCK, RANGE = 4096, 1 << 19
_SHORT = 64
_ROW = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _ROW = np.where(_ROW & 1, (_ROW >> 1) ^ np.uint32(0xEDB88320), _ROW >> 1).astype(np.uint32)
_ONES = np.uint32(0xFFFFFFFF)


def crc_extend(state: np.ndarray, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 registers after also reading buf[starts:ends] each, one byte of all words at a time (longer words by zlib)."""
    state, size = state.copy(), ends - starts
    for i in np.flatnonzero(size > _SHORT):
        state[i] = np.uint32(zlib.crc32(buf[starts[i] : ends[i]], int(state[i] ^ _ONES))) ^ _ONES
    size = np.where(size > _SHORT, 0, size)
    order = np.argsort(-size, kind="stable")
    longer = len(size) - np.searchsorted(np.sort(size), np.arange(int(size.max(initial=0))), "right")
    at, value = starts[order], state[order]
    for place, n in enumerate(longer.tolist()):
        value[:n] = _ROW[(value[:n] ^ buf[at[:n] + place]) & np.uint32(255)] ^ (value[:n] >> np.uint32(8))
    state[order] = value
    return state


def features(buf: np.ndarray, docs: np.ndarray, buckets: int, most_words: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of 1, 2, ... words: the bucket of each run, the document it lies in, and words a document."""
    w = split(FOLD[buf], docs, hashed=False)
    state = crc_extend(np.full(len(w.starts), _ONES), w.buf, w.starts, w.ends)
    doc, n_words, blank = w.doc_of, w.counts(), np.frombuffer(b" ", np.uint8)
    for k in range(1, most_words + 1):
        if k > 1:
            if len(w.starts) < k:
                return
            zero = np.zeros(len(w.starts) - k + 1, np.int64)
            state = crc_extend(crc_extend(state[:-1], blank, zero, zero + 1), w.buf, w.starts[k - 1 :], w.ends[k - 1 :])
        inside = whole(w.first, k) if k > 1 else np.ones(len(doc), bool)
        yield ((state ^ _ONES) % np.uint32(buckets)).astype(np.int64)[inside], doc[: len(inside)][inside], n_words


def count_buckets(texts: DataFrame, buckets: int = BUCKETS, most_words: int = 1) -> np.ndarray:
    """Features of texts(text) in each bucket, `buckets` numbers however many texts there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, buf, docs in pieces(batch):
                for bucket, _, _ in features(buf, docs, buckets, most_words):
                    total += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    found = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the natural log of how much likelier the target is in each bucket, rounded down."""
    n, all_raw, all_target = len(raw), int(raw.sum()), int(target.sum())
    ratio = [float(t + 1) * float(all_raw + n) / (float(s + 1) * float(all_target + n)) for s, t in zip(raw.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def weigh(documents: DataFrame, target: DataFrame, buckets: int = BUCKETS, most_words: int = 1, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score (long) of every row of documents(doc_id, text)."""
    gain = gains(count_buckets(documents, buckets, most_words), count_buckets(target, buckets, most_words))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, buf, docs in pieces(batch):
                n = len(docs) - 1
                words, found, total = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
                for bucket, doc, words in features(buf, docs, buckets, most_words):
                    found += np.bincount(doc, minlength=n)
                    sums = np.concatenate([[0], np.cumsum(gain[bucket])])
                    first = np.searchsorted(doc, np.arange(n + 1))
                    total += sums[first[1:]] - sums[first[:-1]]
                weight = np.where(found, total // np.maximum(found, 1), 0)
                yield pa.record_batch([rows.column(0), pa.array(words), pa.array(found), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"])

    small_batches(documents.sparkSession)
    scored = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, "doc_id long, n_words long, n_features long, weight long")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return scored.withColumn("score", F.col("weight") + noise)


class Tournament:
    """A tree of matches between the rows that stand first in their blocks; a block's next row replays its own path only."""

    def __init__(self) -> None:
        self.blocks: list[tuple[list, int] | None] = [None]
        self.free = [0]
        self.winner = [0, 0]

    def _beats(self, a: int, b: int) -> int:
        x, y = self.blocks[a], self.blocks[b]
        return a if y is None or (x is not None and x[0][x[1]] <= y[0][y[1]]) else b

    def _replay(self, leaf: int) -> None:
        at = (len(self.blocks) + leaf) // 2
        while at:
            left, right = 2 * at, 2 * at + 1
            n = len(self.blocks)
            self.winner[at] = self._beats(left - n if left >= n else self.winner[left], right - n if right >= n else self.winner[right])
            at //= 2

    def add(self, rows: list) -> None:
        """A block, in order, of at least one row."""
        if not self.free:
            n = len(self.blocks)
            self.blocks += [None] * n
            self.free = list(range(2 * n - 1, n - 1, -1))
            self.winner = [0] * (2 * n)
            for leaf in range(0, 2 * n, 2):
                self._replay(leaf)
        leaf = self.free.pop()
        self.blocks[leaf] = (rows, 0)
        self._replay(leaf)

    def first(self):
        """The smallest row that has not left, or None."""
        found = self.blocks[self.winner[1] if len(self.blocks) > 1 else 0]
        return found and found[0][found[1]]

    def pop(self):
        leaf = self.winner[1] if len(self.blocks) > 1 else 0
        rows, at = self.blocks[leaf]
        if at + 1 < len(rows):
            self.blocks[leaf] = (rows, at + 1)
        else:
            self.blocks[leaf] = None
            self.free.append(leaf)
        self._replay(leaf)
        return rows[at]

    def rest(self) -> Iterator:
        for block in self.blocks:
            if block:
                yield from block[0][block[1] :]


def merge(blocks: Iterator[list], stop: int) -> Iterator[tuple[int | None, tuple]]:
    """(place from 0, row) of sorted blocks that come in the order of their first rows; after `stop` places the rows follow in any order, with None."""
    tree, place = Tournament(), 0
    waiting = next(blocks, None)
    while place < stop:
        first = tree.first()
        if waiting is not None and (first is None or waiting[0] <= first):
            tree.add(waiting)
            waiting = next(blocks, None)
        elif first is None:
            return
        else:
            yield place, tree.pop()
            place += 1
    for row in tree.rest():
        yield None, row
    while waiting is not None:
        for row in waiting:
            yield None, row
        waiting = next(blocks, None)


_BLOCKS = "range int, run long, head_score long, head_id long, n long, ids array<long>, features array<long>, weights array<long>, scores array<long>"
_BLOCK_SCHEMA = pa.schema([
    ("range", pa.int32()), ("run", pa.int64()), ("head_score", pa.int64()), ("head_id", pa.int64()), ("n", pa.int64()),
    *((name, pa.list_(pa.int64())) for name in ("ids", "features", "weights", "scores")),
])


def _place(score: int, doc_id: int | None, features: int = 0, weight: int = 0) -> tuple:
    """The order of the draw: higher scores first, then smaller ids."""
    return (-score, doc_id is None, doc_id or 0, features, weight)


def _cutter(bounds: list[tuple]):
    """Sorted rows of a partition as blocks, none across a bound."""

    def pack(number: int, run: int, rows: list[tuple]) -> dict:
        ids, found, weights, scores = map(list, zip(*rows, strict=True))
        return {"range": number, "run": run, "head_score": scores[0], "head_id": ids[0], "n": len(rows), "ids": ids, "features": found, "weights": weights, "scores": scores}

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, open_range, held = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                number = bisect_right(bounds, _place(row[3], row[0])[:3])
                if held and (number != open_range or len(held) == BLOCK):
                    out.append(pack(open_range, run, held))
                    held = []
                open_range = number
                held.append(row)
            yield pa.RecordBatch.from_pylist(out, schema=_BLOCK_SCHEMA)
        if held:
            yield pa.RecordBatch.from_pylist([pack(open_range, run, held)], schema=_BLOCK_SCHEMA)

    return cut_up


def _ranker(before: list[int], draw: int):
    """Blocks of whole ranges, each range's in the order of their first rows, as ranked rows."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_features", "weight", "score", "rank")])

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
        for batch in batches:
            for i in range(batch.num_rows):
                number, *parts = (batch.column(c)[i].as_py() for c in ("range", "scores", "ids", "features", "weights"))
                yield number, [_place(*row) for row in zip(*parts, strict=True)]

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = rows_of(batches)
        ahead = next(source, None)
        while ahead is not None:
            number = ahead[0]

            def of_range(number: int = number) -> Iterator[list[tuple]]:
                nonlocal ahead
                while ahead is not None and ahead[0] == number:
                    block = ahead[1]
                    ahead = next(source, None)
                    yield block

            out = []
            for place, (minus, absent, doc_id, found, weight) in merge(of_range(), draw - before[number]):
                out.append((None if absent else doc_id, found, weight, -minus, None if place is None else before[number] + place + 1))
                if len(out) == 1 << 16:
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)
                    out = []
            if out:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)

    return rank


def _bounds(eligible: DataFrame, scores: np.ndarray, counts: np.ndarray, size: int) -> list[tuple]:
    """Where ranges end, in the order of the draw (scores from the highest), each about `size` rows."""
    hot = counts > 2 * size
    quantiles: dict[int, list[int]] = {}
    if hot.any():
        parts = -(-int(counts[hot].max()) // size)
        each = F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 100 * parts).alias("q")
        found = eligible.where(F.col("score").isin([int(x) for x in scores[hot]])).groupBy("score").agg(each)
        quantiles = {r.score: sorted(set(r.q or ())) for r in found.collect()}
    bounds, held = [], 0
    for score, n in zip(scores.tolist(), counts.tolist(), strict=True):
        if held and held + n > size:
            bounds.append((-score, False, -(1 << 63)))
            held = 0
        bounds += [(-score, False, q) for q in quantiles.get(score, ())]
        held += n if score not in quantiles else size
    return bounds


def rank_draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """scored(doc_id, n_words, n_features, weight, score), which a job may read again, with rank: 1, 2, ... of the draw, else null."""
    columns = ["doc_id", "n_features", "weight", "score"]
    eligible = scored.where(F.col("n_words") >= min_words)
    found = eligible.groupBy("score").agg(F.count(F.lit(1)).alias("n")).toArrow()
    scores, counts = found["score"].to_numpy(), found["n"].to_numpy()
    order = np.argsort(-scores)
    scores, counts = scores[order], counts[order]
    draw = percent * int(counts.sum()) // 100
    if not draw:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    last = int(np.searchsorted(np.cumsum(counts), draw))
    scores, counts = scores[: last + 1], counts[: last + 1]
    tasks = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = max(1, min(RANGE, -(-int(counts.sum()) // tasks)))
    reach = (F.col("n_words") >= min_words) & (F.col("score") >= int(scores[-1]))
    rows = eligible.where(F.col("score") >= int(scores[-1])).select("doc_id", "n_features", "weight", "score")
    bounds = _bounds(rows, scores, counts, size)
    ordered = rows.sortWithinPartitions(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "n_features", "weight")
    runs = cut(ordered.mapInArrow(_cutter(bounds), _BLOCKS))
    sizes = {r["range"]: r["n"] for r in runs.groupBy("range").agg(F.sum("n").alias("n")).collect()}
    before = [0]
    for i in range(len(bounds)):
        before.append(before[-1] + sizes.get(i, 0))
    dealt = runs.repartitionById(len(before), "range").sortWithinPartitions("range", F.col("head_score").desc(), F.col("head_id").asc_nulls_last(), F.element_at("features", 1), F.element_at("weights", 1))
    ranked = dealt.mapInArrow(_ranker(before, draw), "doc_id long, n_features long, weight long, score long, rank long")
    return ranked.unionByName(scored.where(~reach).select(*columns, F.lit(None).cast("long").alias("rank")))


def resample(documents: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS, most_words: int = 1, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank (long) of every row of documents(doc_id, text), against target(text)."""
    return rank_draw(cut(weigh(documents, target, buckets, most_words, seed)), percent, min_words)
