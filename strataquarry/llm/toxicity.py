"""Toxic spans by a linear-chain conditional random field over words.

Training reads a bounded sample of labelled rows (`max_train` ids by hash order, the held-out fold never among them). Only
documents carry labels, so words are labelled first: a word of a toxic document is toxic if the distinct contexts (word
before, word after) it, or a prefix of it, has in toxic documents outweigh those in clean ones. Distinct contexts, not
documents, are counted, so that families of near copies do not vote many times. A two-state chain whose emissions sum the
weights of the word and of its prefixes (so inflected and unseen words carry over) is fitted by gradient descent on exact
forward-backward marginals; document features (largest marginal, sum of squared marginals, its density) are then
calibrated against the labels by logistic regression. Words side by side, of one chain, with a marginal of a half or more are
one span, from the first to the last.

Scoring is one map over the texts: chains are sentences (at most 256 words), all chains of a chunk run forward-backward
together. Words are lower case, punctuation parts them; nothing but the text enters a score.

Defined results: null or empty text has no words and gets the calibrated score of such; texts of any length are read whole; a
score equal to the threshold is predicted toxic; without labelled rows of both classes every score is 0 and nothing is
predicted; a null doc_id is not held out; repeated rows are scored each, repeated labels count once (toxic if one says so) and
so do equal texts of an id; other columns, whatever their names, are ignored; an empty table gives an empty result; spans are
code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .runtime import small_batches

MAX_TRAIN = 3_000
#: Bytes of sampled texts that reach the driver: an id whose texts would pass them is left out, as are those after it by hash.
MAX_BYTES = 24 << 20
THRESHOLD = 0.3
BITS = 18
LONGEST = 256
#: Prefix lengths in bytes that are features beside the word.
PREFIXES = (4, 5, 6, 7, 8)
NONE = 1 << BITS
#: Log odds beyond this are certain.
MOST = 30.0
SCORES = "doc_id long, held_out boolean, score double, predicted int, spans string"

_STOP = np.zeros(256, bool)
_STOP[list(b".!?\n")] = True


@dataclass
class Model:
    weight: np.ndarray  # emission of each feature bucket for the toxic state; NONE has 0
    bias: float
    move: np.ndarray  # 2 x 2 transition scores
    doc: np.ndarray  # bias and weights of the document features


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def features(buf: np.ndarray, w: W.Words) -> np.ndarray:
    """Feature buckets, 1 + len(PREFIXES) rows a word; NONE where a word is shorter than the prefix."""
    out = np.full((1 + len(PREFIXES), len(w.starts)), NONE, np.int32)
    out[0] = buckets(w.hashes)
    size, h = w.ends - w.starts, np.zeros(len(w.starts), np.uint64)
    for j in range(max(PREFIXES)):
        at = np.minimum(w.starts + j, len(buf) - 1)
        h = h + W._BYTE[buf[at]] * W._PLACE[j]
        if j + 1 in PREFIXES:
            row, fits = PREFIXES.index(j + 1) + 1, size > j
            out[row, fits] = buckets(W.mix(h[fits] + np.uint64(j)))
    return out


def chains(buf: np.ndarray, w: W.Words) -> np.ndarray:
    """Bounds of the chains in words: sentences, cut after LONGEST words; none crosses a document."""
    n = len(w.starts)
    if not n:
        return np.zeros(1, np.int64)
    stops = np.cumsum(_STOP[buf])[w.starts]
    doc = w.doc_of
    new = np.ones(n, bool)
    new[1:] = (stops[1:] != stops[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    inside = np.arange(n) - np.repeat(at, np.diff(np.append(at, n)))
    return np.append(np.flatnonzero(inside % LONGEST == 0), n)


def messages(unary: np.ndarray, bounds: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log odds at every word. Chains advance together, the longest first."""
    forward, backward = unary.copy(), np.zeros_like(unary)
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    head, size = bounds[:-1][order], size[order]
    longest = int(size[0]) if len(size) else 0
    alive = np.searchsorted(-size, -np.arange(1, longest + 1), "right")  # chains with more than t words at t
    last = head + size - 1
    m = np.exp(move)
    for t in range(1, longest):
        k = alive[t]
        at = head[:k] + t
        before = np.exp(np.clip(forward[at - 1], -MOST, MOST))
        forward[at] += np.log((m[0, 1] + before * m[1, 1]) / (m[0, 0] + before * m[1, 0]))
        at = last[:k] - t
        after = np.exp(np.clip(backward[at + 1] + unary[at + 1], -MOST, MOST))
        backward[at] = np.log((m[1, 0] + after * m[1, 1]) / (m[0, 0] + after * m[0, 1]))
    return forward, backward


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def pair_sums(forward: np.ndarray, backward: np.ndarray, unary: np.ndarray, bounds: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Expected number of each transition."""
    inner = np.ones(len(unary), bool)
    inner[bounds[1:] - 1] = False
    t = np.flatnonzero(inner)
    m, a = np.exp(move), np.exp(np.clip(forward[t], -MOST, MOST))
    b = np.exp(np.clip(unary[t + 1] + backward[t + 1], -MOST, MOST))
    parts = [np.full(len(t), m[0, 0]), m[0, 1] * b, m[1, 0] * a, m[1, 1] * a * b]
    total = sum(parts)
    return np.array([(x / total).sum() for x in parts]).reshape(2, 2)


def token_labels(h: np.ndarray, first: np.ndarray, feats: np.ndarray, toxic: np.ndarray, least: int = 5, least_docs: int = 4, odds: float = 30.0) -> np.ndarray:
    """Whether each word is taken as toxic for training: it or a prefix has the evidence. A word beside itself is no context."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    before, after = np.roll(h, 1), np.roll(h, -1)
    before[first[:-1][first[:-1] < len(h)]] = 0
    after[first[1:][first[1:] > 0] - 1] = 0
    bad, free = toxic[doc], (before != h) & (after != h)
    before = W.mix(before) * np.uint64(3)
    before += W.mix(after) * np.uint64(7)
    before += h
    before += bad
    del after
    one = np.unique(W.mix(before), return_index=True)[1]
    del before
    one = one[free[one]]
    hit = np.zeros(len(h), bool)
    for of in feats:
        mine = one[of[one] != NONE]
        in_bad = np.bincount(of[mine[bad[mine]]], minlength=NONE + 1)
        in_good = np.bincount(of[mine[~bad[mine]]], minlength=NONE + 1)
        own = np.unique(of[mine[bad[mine]]].astype(np.int64) * len(toxic) + doc[mine[bad[mine]]]) // max(1, len(toxic))
        docs = np.bincount(own, minlength=NONE + 1)
        share = ((in_bad + 0.5) / (in_bad.sum() + 1)) / ((in_good + 0.5) / (in_good.sum() + 1))
        good = (in_bad >= least) & (docs >= least_docs) & (share >= odds)
        good[NONE] = False
        hit |= good[of]
    return bad & hit


def sample_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, first word of each text, chain bounds and features of the sample, gathered chunk by chunk."""
    hashes, counts, bounds, feats, n = [], [], [np.zeros(1, np.int64)], [], 0
    for _, raw, docs in W.pieces(pa.record_batch({"text": pa.array(texts, pa.string())})):
        buf = W.FOLD[raw]
        w = W.split(buf, docs)
        hashes.append(w.hashes)
        counts.append(w.counts())
        bounds.append(chains(raw, w)[1:] + n)
        feats.append(features(buf, w))
        n += len(w.hashes)
    every = np.empty((1 + len(PREFIXES), n), np.int32)
    at = 0
    while feats:
        part = feats.pop(0)
        every[:, at : at + part.shape[1]] = part
        at += part.shape[1]
    return np.concatenate(hashes), np.concatenate([[0], np.cumsum(np.concatenate(counts))]), np.concatenate(bounds), every


def train(texts: list[str], toxic: np.ndarray, steps: int = 30, ridge: float = 1e-4) -> Model:
    """Fit on the driver; the sample is bounded, so is this."""
    hashes, first, bounds, feats = sample_features(texts)
    label = token_labels(hashes, first, feats, toxic).astype(float)
    del hashes
    weight, move, bias = np.zeros(NONE + 1), np.zeros((2, 2)), -2.0
    inner = np.ones(len(label), bool)
    inner[bounds[1:] - 1] = False
    t = np.flatnonzero(inner)
    seen = np.bincount((label[t] * 2 + label[t + 1]).astype(int), minlength=4).reshape(2, 2)
    del inner, t
    met = np.zeros(NONE + 1, bool)
    for row in feats:
        met[row] = True
    met[NONE] = False
    grad_w, grad_m, grad_b, n = np.full(NONE + 1, 1e-8), np.full((2, 2), 1e-8), 1e-8, max(1, len(label))
    for _ in range(steps):
        unary = _unary(weight, feats) + bias
        forward, backward = messages(unary, bounds, move)
        off = _sigmoid(forward + backward) - label
        gw = (sum(np.bincount(row, off, NONE + 1) for row in feats) + ridge * n * weight / max(1, met.sum())) * met
        gm = pair_sums(forward, backward, unary, bounds, move) - seen
        gb = off.sum()
        grad_w, grad_m, grad_b = grad_w + gw * gw, grad_m + gm * gm, grad_b + gb * gb
        weight, move, bias = weight - 0.4 * gw / np.sqrt(grad_w), move - 0.3 * gm / np.sqrt(grad_m), bias - 0.3 * gb / np.sqrt(grad_b)
    model = Model(weight, float(bias), move, np.zeros(4))
    model.doc = _logistic(doc_features(_marginals(model, feats, bounds), first), toxic.astype(float))
    return model


def _unary(weight: np.ndarray, feats: np.ndarray) -> np.ndarray:
    out = np.zeros(feats.shape[1])
    for row in feats:
        out += weight[row]
    return out


def _marginals(model: Model, feats: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    forward, backward = messages(_unary(model.weight, feats) + model.bias, bounds, model.move)
    return _sigmoid(forward + backward)


def doc_features(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """1, largest marginal, log(1 + sum of squared marginals), the same as a root share of the words."""
    n = np.diff(first)
    most, total, some = np.zeros(len(n)), np.zeros(len(n)), np.flatnonzero(n)
    if len(some):
        most[some] = np.maximum.reduceat(p, first[some])
        total[some] = np.add.reduceat(p * p, first[some])
    return np.stack([np.ones(len(n)), most, np.log1p(total), np.sqrt(total / np.maximum(n, 1))], 1)


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1e-2) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = _sigmoid(x @ beta)
        grad = x.T @ (p - y) + ridge * beta
        hess = (x * (p * (1 - p))[:, None]).T @ x + (ridge + 1e-9) * np.eye(len(beta))
        move = np.linalg.solve(hess, grad)
        beta -= move / max(1.0, np.abs(move).max())
    return beta


def sample(documents: DataFrame, labels: DataFrame, max_train: int, max_bytes: int = MAX_BYTES) -> tuple[list[str], np.ndarray]:
    fold = F.crc32(F.col("id").cast("string")) % 4
    ids = labels.select(F.col("doc_id").alias("id"), "toxic").where("id is not null and toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic")).where(fold != 2)
    ids = ids.orderBy(F.xxhash64("id"), "id").limit(max_train)
    rows = documents.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("id")).select("id", F.coalesce("text", F.lit("")).alias("text"), "toxic").distinct()
    # ids are bounded, but neither their texts nor the rows of one id, so the running size is too before anything is gathered
    sizes = rows.groupBy("id").agg(F.sum(F.octet_length("text")).alias("size"))  # one row an id, of which there are at most max_train
    some = sizes.withColumn("before", F.sum("size").over(Window.orderBy(F.xxhash64("id"), "id"))).where(F.col("before") <= max_bytes).select(F.col("id").alias("chosen"))
    rows = rows.join(F.broadcast(some), F.col("id") == F.col("chosen")).drop("chosen").toPandas()
    rows = rows.sort_values(["id", "text"])
    return rows.text.tolist(), (rows.toxic == 1).to_numpy()


def spans_of(p: np.ndarray, bounds: np.ndarray, w: W.Words, buf: np.ndarray) -> dict[int, str]:
    """start:end of the runs of toxic words of each document that has some."""
    hit = np.flatnonzero(p >= 0.5)
    if not len(hit):
        return {}
    chain = np.searchsorted(bounds, hit, "right")
    new = np.append(True, (hit[1:] != hit[:-1] + 1) | (chain[1:] != chain[:-1]))
    begin = np.flatnonzero(new)
    first, last = hit[begin], hit[np.append(begin[1:], len(hit)) - 1]
    points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    d = np.searchsorted(w.first, first, "right") - 1
    a, b = points[w.starts[first]] - points[w.docs[d]], points[w.ends[last]] - points[w.docs[d]]
    found: dict[int, list[str]] = {}
    for i, x, y in zip(d.tolist(), a.tolist(), b.tolist(), strict=True):
        found.setdefault(i, []).append(f"{x}:{y}")
    return {i: ",".join(x) for i, x in found.items()}


def score_toxicity(documents: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, spans of every row of documents(doc_id, text)."""
    small_batches(documents.sparkSession)
    texts, toxic = sample(documents, labels, max_train)
    model = train(texts, toxic) if len(toxic) and 0 < toxic.sum() < len(toxic) else None
    names = [x.split()[0] for x in SCORES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, docs in W.pieces(batch):
                n = len(part)
                spans, score = [""] * n, np.zeros(n)
                if model:
                    fold = W.FOLD[buf]
                    w = W.split(fold, docs)
                    bounds = chains(buf, w)
                    p = _marginals(model, features(fold, w), bounds)
                    score = _sigmoid(doc_features(p, w.first) @ model.doc)
                    for i, x in spans_of(p, bounds, w, buf).items():
                        spans[i] = x
                yield pa.record_batch([part.column(0), part.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(spans)], names=names)

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text").mapInArrow(run, SCORES)
