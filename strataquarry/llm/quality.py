"""Quality rules: hand rules of repetition and length, then a hashed n-gram log-likelihood ratio.

Word unigrams and bigrams hash into as many buckets as the documents have distinct ones (by a sketch; the next power of two,
from 2^20 to 2^26). Two smoothed multinomials are counted: one over trusted documents (label quality = 1; a bounded sample,
`max_trusted` ids by hash order), one over every document. A document's score is the mean log ratio of its n-grams, so
length cancels, and every document is held against one fixed threshold.

Both models are put in counts of the trusted sample before they are smoothed, and that sample is bounded. So a bucket's ratio
tends to a fixed value as the table grows, rare words that the sample lacks say as little of a large table as of a small one,
and n-grams that share a bucket add no more than the sample's n-grams divided by the buckets. Counts meet in slices of the
hash space, distributed; the log ratios become a file that the driver writes slice by slice and Spark hands to the executors,
whose workers map it into memory. So neither the driver nor a closure ever holds them. Spark keeps two copies of it an executor
until the session ends, so only ratios that are not 0 stand in it (2 bytes each), found by one bit a bucket and a count of
ratios every 64 buckets: 1.5 bits a bucket, 140 MB at most. Most buckets of a small table hold no n-gram or one that stands once
in a document that is not trusted, whose ratio is 0. Every table is read three times: for its size, its counts and its verdicts.

Defined results: null or empty text fails the rules; a document without n-grams scores 0; a score equal to the threshold is
kept; without any trusted document every score is 0, so the rules alone decide; texts of any length are read whole; repeated
rows count as often as they stand; labels with a null or repeated doc_id are ignored or counted once; other columns pass
through keep_good() whatever their names and are otherwise ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .runtime import cut, forget, release, small_batches

LEAST_BUCKETS, MOST_BUCKETS = 1 << 20, 1 << 26
#: Buckets whose counts meet in one task.
SLICE = 1 << 16
_SKETCH = 4096
_PENDING = 4_000_000
#: N-grams counted before their counts leave a task; well within 31 bits.
_MOST_GRAMS = 1 << 29
_COUNT, _TRUSTED = np.uint64((1 << 24) - 1), np.uint64(1 << 24)
MAX_TRUSTED = 20_000
#: Counts lent to every bucket of both models, in counts of the trusted sample: a bucket that neither knows says nothing.
SMOOTHING = 3.0
#: Mean log ratio below which a document is rejected; set by labelled good and junk documents together (README).
MIN_SCORE = -0.3
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"[#*$%&|<>]"[1:-1])] = True
_GRAM = 5
VERDICT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"


def _per_doc(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def repeat_words(w: W.Words, k: int = _GRAM) -> np.ndarray:
    """Words of each document that lie in a k-word window met at least twice in it."""
    grams, inside = W.Runs(w.hashes).grams(k), W.whole(w.first, k)
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(len(w.docs) - 1, np.int64)
    key = W.mix(grams[at] + w.doc_of[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    again = np.zeros(len(at), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    cover = np.zeros(int(w.first[-1]) + 1, np.int32)
    hit = at[again]
    cover[hit] += 1
    np.subtract.at(cover, hit + k, 1)
    return _per_doc(np.cumsum(cover[:-1]) > 0, w.first)


def base_counts(buf: np.ndarray, docs: np.ndarray, w: W.Words) -> tuple[np.ndarray, ...]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words of each document."""
    chars = _per_doc(((buf & 0xC0) != 0x80) & ~W._SPACE[buf], docs)
    symbols = _per_doc(_SYMBOL[buf], docs)
    raw, dup = buf.tobytes(), np.zeros(len(docs) - 1, np.int64)
    for i in range(len(dup)):
        lines = [x for x in raw[docs[i] : docs[i + 1]].split(b"\n") if x.strip()]
        dup[i] = len(lines) - len(set(lines))
    return chars, symbols, dup, repeat_words(w)


@dataclass
class Model:
    """Log ratios of the buckets, in a file that SparkContext.addFile has handed out (none: all 0); what every n-gram adds besides."""

    file: str | None
    shift: float
    buckets: int = LEAST_BUCKETS

    def __getstate__(self) -> dict:
        return {"file": self.file, "shift": self.shift, "buckets": self.buckets}

    @cached_property
    def _parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A bit a bucket; the ratios before each 64 buckets; the ratios that are not 0, by slices as they came."""
        held, bits, ahead = np.memmap(SparkFiles.get(self.file), np.uint8, "r"), self.buckets // 8, self.buckets // 16
        return held[:bits].view(np.uint64), held[bits : bits + ahead].view(np.int32), held[bits + ahead :].view(np.float16)

    def ratio(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes))
        if self.file:
            bits, ahead, ratios = self._parts
            bucket = hashes & np.uint64(self.buckets - 1)
            word, bit = bucket >> np.uint64(6), np.uint64(1) << (bucket & np.uint64(63))
            told = bits[word]
            at = np.flatnonzero(told & bit)
            out[at] = ratios[ahead[word[at]] + np.bitwise_count(told[at] & (bit[at] - np.uint64(1)))]
        return out


def features(w: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every unigram and bigram."""
    doc = w.doc_of
    pair = np.flatnonzero(W.whole(w.first, 2))
    grams = W.Runs(w.hashes).grams(2)[pair] if len(pair) else np.zeros(0, np.uint64)
    return np.concatenate([doc, doc[pair]]), np.concatenate([w.hashes, grams])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of a piece's n-grams, and which of them stand in trusted documents."""
    for batch in batches:
        for part, buf, docs in W.pieces(batch):
            doc, hashes = features(W.split(buf, docs))
            yield hashes, part.column(part.schema.get_field_index("trusted")).to_numpy(zero_copy_only=False).astype(bool)[doc]


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least hashes of a task (its distinct n-grams follow from them), and how many n-grams there are, all and trusted."""
    least, raw, target = np.zeros(0, np.uint64), 0, 0
    for hashes, trusted in _featured(batches):
        raw, target = raw + len(hashes), target + int(trusted.sum())
        fresh = hashes if len(least) < _SKETCH else hashes[hashes < least[-1]]
        least = np.unique(np.concatenate([least, fresh]))[:_SKETCH]
    yield pa.record_batch([pa.array([(least >> np.uint64(1)).astype(np.int64)], pa.list_(pa.int64())), pa.array([raw]), pa.array([target])], names=["least", "raw", "target"])


def _size(marked: DataFrame) -> tuple[int, int, int]:
    """(buckets, n-grams, n-grams of trusted documents)."""
    found = marked.mapInArrow(_sketch, "least array<long>, raw long, target long")
    raw, target = found.agg(F.coalesce(F.sum("raw"), F.lit(0)), F.coalesce(F.sum("target"), F.lit(0))).first()
    least = [r.h for r in found.select(F.explode("least").alias("h")).distinct().orderBy("h").limit(_SKETCH).collect()]
    distinct = len(least) if len(least) < _SKETCH else (_SKETCH - 1) * 2**63 / least[-1]
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << int(np.ceil(np.log2(max(distinct, 1)))))), raw, target


def _packed(held: list[np.ndarray]) -> pa.RecordBatch:
    """One row a slice: places in it and their counts. held: place << 25 | trusted << 24 | count, so one sort in place orders all."""
    key = np.concatenate(held)
    held.clear()
    key.sort()
    count, trusted = (key & _COUNT).astype(np.uint32), (key & _TRUSTED) > 0
    key >>= np.uint64(25)
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    raw = np.add.reduceat(count, new, dtype=np.int32)
    count[~trusted] = 0
    target = np.add.reduceat(count, new, dtype=np.int32)
    key = key[new]
    place = (key % np.uint64(SLICE)).astype(np.uint16).view(np.int16)
    key //= np.uint64(SLICE)
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    bounds = pa.array(np.append(begin, len(key)).astype(np.int32))
    return pa.record_batch([pa.array(key[begin].astype(np.int64)), *(pa.ListArray.from_arrays(bounds, pa.array(x)) for x in (place, raw, target))], names=["slice", "place", "raw", "target"])


def _count(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, grams = [], 0, 0
        for hashes, trusted in _featured(batches):
            grams += len(hashes)
            code, counts = np.unique((hashes & np.uint64(buckets - 1)) << np.uint64(1) | trusted, return_counts=True)
            while len(code):  # more than once only for a text with millions of one n-gram
                held.append(code << np.uint64(24) | np.minimum(counts, int(_COUNT)).astype(np.uint64))
                n += len(code)
                more = counts > int(_COUNT)
                code, counts = code[more], counts[more] - int(_COUNT)
            if n > _PENDING or grams > _MOST_GRAMS:
                yield _packed(held)
                held, n, grams = [], 0, 0
        if held:
            yield _packed(held)

    return run


def _ratios(share: float) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        raw, target = np.zeros(SLICE), np.zeros(SLICE)
        for row in range(len(rows)):
            place, r, t = (rows.column(k)[row].values.to_numpy() for k in ("place", "raw", "target"))
            at = place.view(np.uint16)
            raw[at] += r
            target[at] += t
        used = int((raw > 0).sum())
        raw = np.maximum(raw - 1, 0)  # a document that is scored has been counted itself
        ratio = (np.log(target + SMOOTHING) - np.log(raw * share + SMOOTHING)).astype(np.float16)
        told = ratio != 0
        bits, told = np.packbits(told, bitorder="little").tobytes(), ratio[told].tobytes()
        return pa.table({"slice": rows.column("slice")[:1], "used": pa.array([used]), "bits": pa.array([bits], pa.binary()), "ratio": pa.array([told], pa.binary())})

    return run


def _handed_out(table: DataFrame, buckets: int) -> str:
    """Name of a file of the ratios (see Model), which the executors fetch; slices pass one by one, those of no n-gram are 0."""
    name, n = f"ratios-{uuid.uuid4().hex}", 0
    path = os.path.join(SparkFiles.getRootDirectory(), name)  # where addFile would copy it to; it goes with the session
    with open(path, "wb") as f:
        f.truncate(buckets // 8 + buckets // 16)
        for row in table.select("slice", "bits", "ratio").toLocalIterator():
            f.seek(SLICE // 8 * row.slice)
            f.write(row.bits)
            counts = np.bitwise_count(np.frombuffer(row.bits, np.uint64))
            f.seek(buckets // 8 + SLICE // 16 * row.slice)
            f.write((n + np.cumsum(counts, dtype=np.int32) - counts).astype(np.int32).tobytes())
            f.seek(0, os.SEEK_END)
            f.write(row.ratio)
            n += len(row.ratio) // 2
    table.sparkSession.sparkContext.addFile(path)
    return name


def fit(documents: DataFrame, labels: DataFrame, max_trusted: int = MAX_TRUSTED) -> Model:
    small_batches(documents.sparkSession)
    trusted = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("tid")).distinct().orderBy(F.xxhash64("tid"), "tid").limit(max_trusted)
    marked = documents.select("doc_id", "text").join(F.broadcast(trusted), F.col("doc_id") == F.col("tid"), "left").select("text", F.col("tid").isNotNull().alias("trusted"))
    buckets, raw, target = _size(marked)
    if not target:
        return Model(None, 0.0)
    share = target / raw
    counts = marked.mapInArrow(_count(buckets), "slice long, place array<short>, raw array<int>, target array<int>")
    table = cut(counts.groupBy("slice").applyInArrow(_ratios(share), "slice long, used long, bits binary, ratio binary"))
    used = table.agg(F.sum("used")).first()[0]
    file = _handed_out(table, buckets)
    forget(table)
    release(documents.sparkSession)  # the shuffled counts go before the file has copies
    return Model(file, float(np.log(((raw - used) * share + SMOOTHING * buckets) / (target + SMOOTHING * buckets))), buckets)


def scores(w: W.Words, model: Model) -> np.ndarray:
    """Mean log ratio of each document's n-grams."""
    doc, hashes = features(w)
    total = np.bincount(doc, model.ratio(hashes), len(w.docs) - 1)
    n = w.counts() + np.maximum(w.counts() - 1, 0)
    return np.where(n > 0, total / np.maximum(n, 1) + model.shift, 0.0)


def judge(buf: np.ndarray, docs: np.ndarray, model: Model, threshold: float) -> list[pa.Array]:
    w = W.split(buf, docs)
    chars, symbols, dup, repeat = base_counts(buf, docs, w)
    n = w.counts()
    failed = (n < 10) | (100 * repeat > 20 * n)
    score = scores(w, model)
    return [pa.array(x) for x in (n, chars, symbols, dup, repeat, failed, score, ~failed & (score >= threshold))]


def quality_rules(documents: DataFrame, labels: DataFrame, threshold: float = MIN_SCORE, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """One verdict a row of documents(doc_id, text)."""
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = fit(documents, labels, max_trusted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, docs in W.pieces(batch):
                yield pa.record_batch([part.column(0), *judge(buf, docs, model, threshold)], names=[x.split()[0] for x in VERDICT.split(", ")])

    return documents.mapInArrow(run, VERDICT)


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = MIN_SCORE, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """The rows of documents that pass, all columns as they came."""
    model = fit(documents, labels, max_trusted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo = 0
            for part, buf, docs in W.pieces(batch.select(["text"])):
                kept = judge(buf, docs, model, threshold)[-1]
                yield batch.slice(lo, len(part)).filter(kept)
                lo += len(part)

    return documents.mapInArrow(run, documents.schema)
