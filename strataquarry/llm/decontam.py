"""Benchmark decontamination: CGK walks turn edit distance into Hamming distance, bit-sampling LSH finds candidates, and
exact edit distance decides.

Texts are word sequences; ASCII letters compare in lower case, other ASCII but digits parts words. An item of L words leaks into a text if some run of its words is within floor((1 - similarity) * L)
word edits of the item. One pass over the texts:

1. Places that cannot hold a leak are skipped by necessary conditions that lose nothing. e edits destroy at most 2e of the
   item's L - 1 word pairs, so of any 2e + 1 of them one stands in every leak: an item is looked up by its 2e + 1 pairs that
   the fewest items have, so common pairs lead to no item that has rarer ones, and cost follows what meets, not the number
   of items. Around such a place a run of L + e words must hold at least L - 1 - 2e pairs of the item (one at least, which
   only matters at similarities far below the default). Both are worked off in slabs of bounded size.
2. The item-sized windows of the places left are embedded by CGK random walks: at every step the walk puts out the word it
   stands on and moves on by a random bit that depends on walk, step and word alone. Runs a few edits apart meet again and
   put out equal words on many steps. A key is the words at `SAMPLED` random steps; a window that shares one of an item's
   `KEYS` keys a walk is its candidate. How many walks an item takes follows from `recall`: they are counted on synthetic
   leaks at the full number of edits (all substitutions, all deletions, all insertions, mixed; the worst counts) and
   doubled. Items over `LONGEST` words, or that `MOST_WALKS` walks do not bring to `recall`, take all their places as
   candidates.
3. The region around each candidate is verified by bit-parallel edit distance of the item against any part of it; what lies
   before and behind the nearest run is then searched in the same way, so each of several leaks is reported.

Walks depend on nothing but their number, so neither partitions nor the other items change a result. Items travel to the
workers in blocks of bounded size; a larger benchmark is several maps in a row, not a larger one.

Defined results: null or empty text matches nothing; a text of any length is read whole, in pieces of documents, never cut;
items with fewer than `min_words` words (null included) are no evidence and are left out; repeated items or rows are
reported each; of equally near runs the first end counts; an empty benchmark marks nothing, an empty table gives an empty
result; other columns pass through whatever their names, but one named as `into` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .runtime import small_batches

SIMILARITY, MIN_WORDS = 0.8, 8
BLOCK_CHARS = 2_000_000
RECALL, MOST_WALKS, LONGEST = 0.99, 96, 256
KEYS, SAMPLED = 4, 2
_TRIALS = 64
_SLAB = 1 << 20
HITS = "array<struct<item_id:bigint,start:int,end:int,distance:int>>"
_HITS = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("distance", pa.int32())]))
_BITS = 22


@dataclass
class Index:
    """A block of items, ready for lookup."""

    ids: np.ndarray
    words: list[np.ndarray]
    edits: np.ndarray
    pairs: np.ndarray  # sorted hashes of all word pairs
    posts: np.ndarray  # bounds of the items in post that are looked up by a pair
    post: np.ndarray
    own: np.ndarray  # sorted hashes of (item, pair)
    lengths: np.ndarray  # distinct item lengths
    slack: np.ndarray  # edits that each allows
    filter: np.ndarray
    walks: np.ndarray  # walks that each item takes; 0: all its places are candidates
    keys: np.ndarray  # walk x key x item


def embed(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, walk: int, steps: int) -> np.ndarray:
    """What a CGK walk puts out over the runs words[start : start + size], a row each; 0 beyond their ends."""
    at, out = np.zeros(len(starts), np.int64), np.zeros((len(starts), steps), np.uint64)
    turns = W.mix((np.arange(steps, dtype=np.uint64) + np.uint64(walk << 32)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    for t in range(steps):
        out[:, t] = np.where(at < sizes, words[np.minimum(starts + at, len(words) - 1)], 0)
        at += (W.mix(out[:, t] ^ turns[t]) >> np.uint64(63)).astype(np.int64)
    return out


def sampled(out: np.ndarray, sizes: np.ndarray, walk: int) -> np.ndarray:
    """Keys of embedded runs, KEYS x runs. Steps are shares of twice an item's length."""
    keys = np.empty((KEYS, len(out)), np.uint64)
    for k in range(KEYS):
        draws = W.mix(np.arange(1, SAMPLED + 1, dtype=np.uint64) + np.uint64((walk << 16) + (k << 8) + (1 << 40)))
        h = np.full(len(out), k, np.uint64)
        for draw in draws.tolist():
            step = (2 * sizes * (draw >> 11) / 2**53).astype(np.int64)
            h = W.mix(h * np.uint64(3) + out[np.arange(len(out)), step])
        keys[k] = h
    return keys


def _allowed(size, similarity: float):
    return np.floor((1 - similarity) * size + 1e-9).astype(np.int64)


def _edited(rng: np.random.Generator, item: np.ndarray, edits: int, kind: int) -> np.ndarray:
    """item after edits of one kind (0 substitutions, 1 deletions, 2 insertions) or of all (3)."""
    out = item.tolist()
    for k in (rng.integers(0, 3, edits) if kind == 3 else np.full(edits, kind)).tolist():
        at = int(rng.integers(0, len(out) + (k == 2)))
        out[at : at + (k < 2)] = [] if k == 1 else [int(rng.integers(1, 1 << 62))]
    return np.array(out, np.uint64)


@lru_cache(maxsize=None)
def walks_for(size: int, similarity: float, recall: float) -> int:
    """Walks that find `recall` of synthetic leaks of items of that size, twice over; 0 if MOST_WALKS do not."""
    edits = int(_allowed(size, similarity))
    rng = np.random.Generator(np.random.PCG64(size))
    noise = lambda n: rng.integers(1, 1 << 62, n, dtype=np.uint64)
    items = [noise(size) for _ in range(4 * _TRIALS)]
    kinds = np.arange(len(items)) // _TRIALS
    texts = [np.concatenate([noise(edits), _edited(rng, x, edits, int(k)), noise(size)]) for x, k in zip(items, kinds, strict=True)]
    first = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    flat, own, item = np.concatenate(texts), np.concatenate(items), np.arange(len(items))
    left = np.ones(len(items), bool)
    for walk in range(MOST_WALKS // 2):
        rows = np.repeat(np.flatnonzero(left), 2 * edits + 1)
        starts = first[rows] + np.tile(np.arange(2 * edits + 1), int(left.sum()))
        full = lambda n: np.full(n, size)
        keys = sampled(embed(own, item * size, full(len(item)), walk, 2 * size), full(len(item)), walk)
        found = (sampled(embed(flat, starts, full(len(starts)), walk, 2 * size), full(len(starts)), walk) == keys[:, rows]).any(0)
        left[rows[found]] = False
        if np.bincount(kinds[left], minlength=4).max() <= (1 - recall) * _TRIALS:
            return 2 * (walk + 1)
    return 0


def _stands_for(size: int) -> int:
    """A length at or above size, so that few lengths need a count of walks."""
    step = 1 << max(0, size.bit_length() - 4)
    return -(-size // step) * step


def _owned(item: np.ndarray, pair: np.ndarray) -> np.ndarray:
    return W.mix(pair ^ W.mix(item.astype(np.uint64) + np.uint64(1)))


def build(items: list[tuple[int, str]], similarity: float, min_words: int, recall: float = RECALL) -> Index | None:
    buf, docs = W.buffers(pa.array([t or "" for _, t in items], pa.string()))
    w = W.split(W.FOLD[buf], docs)
    some = [i for i in range(len(items)) if w.counts()[i] >= min_words]
    if not some:
        return None
    words = [w.hashes[w.first[i] : w.first[i + 1]] for i in some]
    n = np.array([len(x) for x in words])
    grams = [np.unique(W.Runs(x).grams(2)) for x in words]
    pairs, which = np.unique(np.concatenate(grams), return_inverse=True)
    item = np.repeat(np.arange(len(words)), [len(g) for g in grams])
    spread = np.bincount(which, minlength=len(pairs))  # items that have a pair
    by_rarity = np.lexsort((which, spread[which], item))
    first = np.concatenate([[0], np.cumsum([len(g) for g in grams])])
    # repeated pairs stand for all their places, so 2e + 1 different ones are enough
    key = (np.arange(len(which)) - first[item[by_rarity]]) < (2 * _allowed(n, similarity) + 1)[item[by_rarity]]
    which, item = which[by_rarity][key], item[by_rarity][key]
    by_pair = np.argsort(which, kind="stable")
    posts = np.searchsorted(which[by_pair], np.arange(len(pairs) + 1))
    post = item[by_pair]
    own = np.sort(_owned(np.repeat(np.arange(len(words)), [len(g) for g in grams]), np.concatenate(grams)))
    seen = np.zeros(1 << _BITS, bool)
    seen[(pairs >> np.uint64(64 - _BITS)).astype(np.int64)] = True
    lengths = np.unique(n)
    walks = np.array([walks_for(_stands_for(x), similarity, recall) if x <= LONGEST else 0 for x in n.tolist()])
    keys = np.zeros((int(walks.max()), KEYS, len(words)), np.uint64)
    for walk in range(len(keys)):
        for rows in _slabs(np.flatnonzero(walks > walk), 2 * n):
            keys[walk][:, rows] = sampled(embed(w.hashes, w.first[some][rows], n[rows], walk, int(2 * n[rows].max())), n[rows], walk)
    return Index(np.array([items[i][0] for i in some]), words, _allowed(n, similarity), pairs, posts, post, own, lengths, _allowed(lengths, similarity), seen, walks, keys)


def _slabs(rows: np.ndarray, steps: np.ndarray) -> Iterator[np.ndarray]:
    """rows in parts whose embeddings have at most _SLAB cells; of similar lengths."""
    rows = rows[np.argsort(steps[rows], kind="stable")]
    at = 0
    while at < len(rows):
        to = at + max(1, min(len(rows) - at, _SLAB // int(steps[rows[at]])))
        while to - at > 1 and (to - at) * int(steps[rows[to - 1]]) > _SLAB:
            to = at + (to - at) // 2
        yield rows[at:to]
        at = to


def candidates(index: Index, w: W.Words, item: np.ndarray, doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which regions (words lo..hi of a document) hold a window that shares a key with their item."""
    size = np.array([len(x) for x in index.words])[item]
    starts = np.maximum(1, hi - lo - size + index.edits[item] + 1)
    hit = index.walks[item] == 0
    for walk in range(len(index.keys)):
        open_ = np.flatnonzero(~hit & (index.walks[item] > walk))
        if not len(open_):
            break
        region = np.repeat(open_, starts[open_])
        at = lo[region] + np.arange(len(region)) - np.repeat(np.cumsum(starts[open_]) - starts[open_], starts[open_])
        for rows in _slabs(np.arange(len(region)), 2 * size[region]):
            r, n = region[rows], size[region[rows]]
            ends = np.minimum(n, w.first[doc[r] + 1] - at[rows])
            found = sampled(embed(w.hashes, at[rows], ends, walk, int(2 * n.max())), n, walk) == index.keys[walk][:, item[r]]
            hit[r[found.any(0)]] = True
    return hit


def fit_in(item: np.ndarray, region: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """(start, end, distance) in region of the run nearest to item by word edits, if within `most`. Bit-parallel over the item."""
    end, distance = _nearest_end(item, region)
    if distance > most:
        return None
    back, _ = _nearest_end(item[::-1], region[:end][::-1], anchored=True)
    return end - back, end, distance


def every_fit(item: np.ndarray, region: np.ndarray, most: int) -> list[tuple[int, int, int]]:
    """All runs that fit_in() finds when it goes on before and behind each that it has found, in order."""
    out, parts = [], [(0, len(region))]
    while parts:
        a, b = parts.pop()
        if b - a < max(1, len(item) - most):
            continue
        found = fit_in(item, region[a:b], most)
        if found:
            out.append((a + found[0], a + found[1], found[2]))
            parts += [(a, a + found[0]), (a + found[1], b)]
    return sorted(out)


def _nearest_end(item: np.ndarray, region: np.ndarray, anchored: bool = False) -> tuple[int, int]:
    m = len(item)
    where: dict[int, int] = {}
    for i, x in enumerate(item.tolist()):
        where[x] = where.get(x, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best = (m, 0)
    for j, x in enumerate(region.tolist(), 1):
        eq = where.get(x, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | ~(xh | plus) & full, plus & xh
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1 | anchored) & full, down << 1 & full
        plus, minus = down | ~(xv | up) & full, up & xv
        if score < best[0]:
            best = (score, j)
    return best[1], best[0]


def _seeds(index: Index, w: W.Words, grams: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(item, document, first word, end word) of regions around places with a pair that an item is looked up by, if enough of its pairs stand there."""
    size = np.array([len(x) for x in index.words])
    pair = np.searchsorted(index.pairs, grams[at])
    n = index.posts[pair + 1] - index.posts[pair]
    at, pair, n = at[n > 0], pair[n > 0], n[n > 0]
    sums, x = np.concatenate([[0], np.cumsum(n)]), 0
    while x < len(at):
        y = max(x + 1, int(np.searchsorted(sums, sums[x] + _SLAB, "right")) - 1)
        row = np.repeat(np.arange(x, y), n[x:y])
        item = index.post[np.repeat(index.posts[pair[x:y]], n[x:y]) + np.arange(len(row)) - np.repeat(sums[x:y] - sums[x], n[x:y])]
        place, x = at[row], y
        doc = np.searchsorted(w.first, place, "right") - 1
        reach = (size + index.edits)[item]
        lo, hi = np.maximum(w.first[doc], place - reach), np.minimum(w.first[doc + 1], place + reach)
        # places of one item whose regions meet are one region
        order = np.lexsort((lo, item))
        item, doc, lo, hi = item[order], doc[order], lo[order], hi[order]
        new = np.ones(len(item), bool)
        new[1:] = (item[1:] != item[:-1]) | (doc[1:] != doc[:-1]) | (lo[1:] > hi[:-1])
        begin = np.flatnonzero(new)
        item, doc, lo, hi = item[begin], doc[begin], lo[begin], hi[np.append(begin[1:], len(new)) - 1]
        width, p = hi - lo, 0
        steps = np.concatenate([[0], np.cumsum(width)])
        while p < len(item):
            q = max(p + 1, int(np.searchsorted(steps, steps[p] + _SLAB, "right")) - 1)
            yield _dense(index, w, grams, size, item[p:q], doc[p:q], lo[p:q], width[p:q])
            p = q


def _dense(index: Index, w: W.Words, grams: np.ndarray, size: np.ndarray, item: np.ndarray, doc: np.ndarray, lo: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What of the regions lies around runs that hold enough pairs of their item."""
    row = np.repeat(np.arange(len(item)), np.maximum(0, width - 1))
    place = lo[row] + np.arange(len(row)) - np.repeat(np.cumsum(np.maximum(0, width - 1)) - np.maximum(0, width - 1), np.maximum(0, width - 1))
    mine = _owned(item[row], grams[place])
    hit = index.own[np.minimum(np.searchsorted(index.own, mine), len(index.own) - 1)] == mine
    row, place = row[hit], place[hit]
    need, edits = np.maximum(1, size - 1 - 2 * index.edits), index.edits
    last = np.arange(len(row)) + need[item[row]] - 1
    far = np.minimum(last, len(row) - 1)
    head = np.flatnonzero((last < len(row)) & (row[far] == row) & (place[far] - place <= (size + edits)[item[row]] - 2))
    # at most 2e words of a leak stand before its first surviving pair, so the leak lies in this region
    i, d, p = item[row[head]], doc[row[head]], place[head]
    return i, d, np.maximum(w.first[d], p - 2 * edits[i]), np.minimum(w.first[d + 1], p + (size + edits)[i])


def find(index: Index, w: W.Words) -> list[tuple[int, int, int, int, int]]:
    """(document, item, first word, end word, distance) of each leak in a chunk."""
    total = int(w.first[-1])
    if total < 2:
        return []
    grams = W.Runs(w.hashes).grams(2)
    hit = index.filter[(grams >> np.uint64(64 - _BITS)).astype(np.int64)] & W.whole(w.first, 2)
    at = np.flatnonzero(hit)
    place = np.searchsorted(index.pairs, grams[at])
    hit[at] = index.pairs[np.minimum(place, len(index.pairs) - 1)] == grams[at]
    at = np.flatnonzero(hit)
    near = np.zeros(len(at) + 1, np.int64)
    for length, e in zip(index.lengths.tolist(), index.slack.tolist(), strict=True):
        need = max(1, length - 1 - 2 * e)
        if len(at) >= need:
            head = np.flatnonzero(at[need - 1 :] - at[: len(at) - need + 1] <= length + e - 2)
            np.add.at(near, head, 1)
            np.subtract.at(near, head + need, 1)
    at = at[np.cumsum(near[:-1]) > 0]
    if not len(at):
        return []
    seeds = list(_seeds(index, w, grams, at))
    if not seeds:
        return []
    item, doc, lo, hi = (np.concatenate(x) for x in zip(*seeds, strict=True))
    order = np.lexsort((lo, doc, item))
    item, doc, lo, hi = item[order], doc[order], lo[order], hi[order]
    # of one item's regions in a document, those that meet are read as one
    new = np.ones(len(item), bool)
    new[1:] = (item[1:] != item[:-1]) | (doc[1:] != doc[:-1]) | (lo[1:] > np.maximum.accumulate(hi)[:-1])
    begin = np.flatnonzero(new)
    item, doc, lo, hi = item[begin], doc[begin], lo[begin], np.maximum.reduceat(hi, begin)
    some = candidates(index, w, item, doc, lo, hi)
    out = []
    for i, d, a, b in zip(item[some].tolist(), doc[some].tolist(), lo[some].tolist(), hi[some].tolist(), strict=True):
        for first, end, distance in every_fit(index.words[i], w.hashes[a:b], int(index.edits[i])):
            base = a - int(w.first[d])
            out.append((d, i, base + first, base + end, distance))
    return out


def _mark(index: Index, at: int, has_hits: bool, dropped: bool, into: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo = 0
            for part, buf, docs in W.pieces(batch.select([at]).rename_columns(["text"]), most=4 << 20):
                own = batch.slice(lo, len(part))
                lo += len(part)
                hits: list[list[dict]] = own.column(own.num_columns - 1).to_pylist() if has_hits else [[] for _ in range(len(part))]
                for d, item, a, b, distance in find(index, W.split(W.FOLD[buf], docs)):
                    hits[d].append({"item_id": int(index.ids[item]), "start": a, "end": b, "distance": distance})
                keep = [i for i in range(own.num_columns - has_hits) if not (dropped and i == at)]
                cols, names = [own.column(i) for i in keep], [own.schema.names[i] for i in keep]
                yield pa.record_batch([*cols, pa.array(hits, _HITS)], names=[*names, into])

    return run


def blocks(benchmark: DataFrame, most: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of at most `most` characters (or one longer item)."""
    block, size = [], 0
    for item_id, text in benchmark.where("item_id is not null").select(F.col("item_id").cast("long"), "text").toLocalIterator():
        if block and size + len(text or "") > most:
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += len(text or "")
    if block:
        yield block


def mark_leaks(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS, with_text: bool = True, recall: float = RECALL, into: str = "_leaks") -> DataFrame:
    """Rows of documents with `into`: item_id, start, end (words), distance of each leak. Without text, it need not travel back."""
    small_batches(documents.sparkSession)
    documents = documents.drop(into)
    at, out = documents.columns.index("text"), documents
    indexes = [x for x in (build(block, similarity, min_words, recall) for block in blocks(benchmark)) if x]
    leaks = T.StructField(into, T._parse_datatype_string(HITS))
    for i, index in enumerate(indexes):
        drop = i == len(indexes) - 1 and not with_text
        fields = [f for f in documents.schema.fields if not (drop and f.name == "text")]
        out = out.mapInArrow(_mark(index, at, i > 0, drop, into), T.StructType([*fields, leaks]))
    return out if indexes else out.withColumn(into, F.array().cast(HITS)).select(*(c for c in documents.columns if with_text or c != "text"), into)
