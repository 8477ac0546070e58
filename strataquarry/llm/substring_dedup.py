"""Exact removal of repeated long word spans by a compacted De Bruijn graph of token k-mers.

The edges of the graph are the texts' `window`-word k-mers. They travel in runs: every window picks one of its shorter
k-mers, the smallest by hash (leftmost on ties), and consecutive windows that pick the same one are one row, about one row in
fifteen words. Equal windows pick equal k-mers at equal places, so they meet under that *node*; nodes met once are dropped.

1. Paths without a branch: a run all of whose windows are repeated (its node has one run, or the run itself is met twice) is
   a piece of path. Two pieces that always follow each other, in every text that holds either, do not branch between them:
   their links are counted, joined with the pieces' counts and back to the places, and a chain of such links compacts to one
   row a place, (key, lo, hi), however long the path.
2. Branches: at other nodes, the ends of repeated spans, windows are compared one by one.
3. Verification at source coordinates: the texts are read again at the compacted spans and at the branching windows, and the
   words that stand there decide, by a 128-bit cryptographic digest. If the places of one path differ in a single word, a
   hash has collided; the runs are then named by digests of their words too and the graph is built anew.

Defined results: null text reads as empty; a text shorter than the window, or without words, keeps every word; texts and words
of any length are read whole; repeated rows, whatever their ids (null or not), are occurrences of one another; columns other
than doc_id and text, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .runtime import cut, forget, release, small_batches, splittable, text_key

NODES = "key binary, node long, edge long, lo int, hi int"
READ = "key binary, path boolean, node long, edge long, words binary, lo int, hi int, weight long"
READ_NAMES = [x.split()[0] for x in READ.split(", ")]
KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def select_nodes(hashes: np.ndarray, first: np.ndarray, window: int, k: int) -> tuple[np.ndarray, ...]:
    """(node position, first window, last window) of each run of windows that pick the same k-mer; positions are word indices."""
    inside = W.whole(first, window)
    if not inside.any():
        none = np.zeros(0, np.int64)
        return none, none, none
    value = W.Runs(hashes).grams(k)
    at = np.arange(len(value), dtype=np.int32)
    width, span = window - k + 1, 1
    while span < width:
        step = min(span, width - span)
        left, right = value[: len(value) - step], value[step:]
        keep = left <= right
        value = np.where(keep, left, right)
        at = np.where(keep, at[: len(at) - step], at[step:])
        span += step
    starts = np.flatnonzero(inside)
    picked = at[starts]
    new = np.empty(len(starts), bool)
    new[0] = True
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))[starts]
    new[1:] = (picked[1:] != picked[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(starts)) - 1
    return picked[begin].astype(np.int64), starts[begin], starts[end]


def joined(buf: np.ndarray, w: W.Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of a chunk joined by single spaces, and where each begins and ends there."""
    size = w.ends - w.starts
    begin = np.cumsum(size + 1) - (size + 1)
    parts = (buf[w.docs[i] : w.docs[i + 1]].tobytes().split() for i in range(len(w.docs) - 1))  # a word ends with its document
    return b" ".join(x for words in parts for x in words), begin, begin + size


def digests(text: bytes, begin: np.ndarray, end: np.ndarray, size: int = 16) -> list[bytes]:
    """Of the words text[begin:end], place by place."""
    blake = hashlib.blake2b
    return [blake(text[a:b], digest_size=size).digest() for a, b in zip(begin.tolist(), end.tolist(), strict=True)]


def _nodes(window: int, k: int, named: bool, bits: int):
    """Runs of windows. named: by a digest of their words instead of the running hash, which has `bits` bits a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, docs in W.pieces(batch):
                w = W.split(buf, docs)
                w.hashes >>= np.uint64(64 - bits)
                node, lo, hi = select_nodes(w.hashes, w.first, window, k)
                if not len(node):
                    continue
                runs, doc = W.Runs(w.hashes), np.searchsorted(w.first, lo, "right") - 1
                if named:
                    text, begin, end = joined(buf, w)
                    edge = np.frombuffer(b"".join(digests(text, begin[lo], end[hi + window - 1], 8)), np.uint64)
                else:
                    edge = W.mix(runs.of(lo, hi + window) ^ ((node - lo) * 65_537 + (hi - lo)).astype(np.uint64))
                base = w.first[doc]
                yield pa.record_batch(
                    [part.column(part.schema.get_field_index("key")).take(pa.array(doc)), pa.array(runs.of(node, node + k).view(np.int64)), pa.array(edge.view(np.int64)), pa.array((lo - base).astype(np.int32)), pa.array((hi - base).astype(np.int32))],
                    names=["key", "node", "edge", "lo", "hi"],
                )

    return run


def _read(window: int):
    """Digests of the words at source coordinates: of whole compacted paths, and of each window of a branching run. A text
    that a join has repeated is read once where its rows stand together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("key")).to_pylist()
            fresh = [k != (keys[i - 1] if i else last) for i, k in enumerate(keys)]
            last = keys[-1] if keys else last
            batch = batch.filter(pa.array(fresh))
            for part, buf, docs in W.pieces(batch):
                w = W.split(buf, docs, hashed=False)
                todo = part.column(part.schema.get_field_index("todo"))
                flat = todo.flatten()
                if not len(flat):
                    continue
                text, begin, end = joined(buf, w)
                doc = np.repeat(np.arange(len(part)), np.diff(todo.offsets.to_numpy()))
                path, node, edge, lo, hi, weight = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(6))
                n = np.where(path, 1, hi - lo + 1).astype(np.int64)
                row = np.repeat(np.arange(len(n)), n)
                start = lo[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                stop = np.where(path[row], hi[row], start)
                at = w.first[doc[row]]
                marks = digests(text, begin[start + at], end[stop + at + window - 1])
                key = part.column(part.schema.get_field_index("key")).take(pa.array(doc[row]))
                yield pa.record_batch([key, pa.array(path[row]), pa.array(node[row]), pa.array(edge[row]), pa.array(marks, pa.binary()), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32)), pa.array(weight[row])], names=READ_NAMES)

    return run


def _keep(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, docs in W.pieces(batch):
                w = W.split(buf, docs, hashed=False)
                total = int(w.first[-1])
                spans = part.column(part.schema.get_field_index("spans"))
                flat, edge = spans.flatten(), spans.offsets.to_numpy()
                drop = np.zeros(total + 1, np.int64)
                if len(flat):
                    doc = np.repeat(np.arange(len(part)), np.diff(edge))
                    lo, hi = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
                    np.add.at(drop, w.first[doc] + lo, 1)
                    np.add.at(drop, w.first[doc] + hi + window, -1)
                gone = np.cumsum(drop[:-1]) > 0
                sums = np.concatenate([[0], np.cumsum(gone)])
                removed = sums[w.first[1:]] - sums[w.first[:-1]]
                raw, kept = buf.tobytes(), []
                for i in range(len(part)):
                    ws = raw[docs[i] : docs[i + 1]].split()
                    if removed[i]:
                        ws = [x for x, g in zip(ws, gone[w.first[i] : w.first[i + 1]].tolist(), strict=True) if not g]
                    kept.append(b" ".join(ws))
                out = [part.column(part.schema.get_field_index("doc_id")), pa.array(w.counts()), pa.array(removed.astype(np.int64)), pa.array([hashlib.sha256(x).hexdigest() for x in kept])]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    out.append(pa.array([x.decode("utf-8", "replace") for x in kept]))
                    names.append("kept_text")
                yield pa.record_batch(out, names=names)

    return run


def compacted(pieces: DataFrame) -> DataFrame:
    """(key, node, edge, lo, hi) of every place of every path without a branch; node and edge are those of its first piece.

    pieces: key, node, edge, lo, hi. Pieces are linked where every place of the one is followed by the other and every place of
    the other follows the one, so all places of a path have the same pieces."""
    places = pieces.dropDuplicates(["key", "lo"])  # copies of a text count once
    along = Window.partitionBy("key").orderBy("lo")
    before = F.lag(F.struct("node", "edge", "hi")).over(along)
    places = cut(places.withColumn("before", F.when(before["hi"] + 1 == F.col("lo"), before)))
    count = places.groupBy("node", "edge").agg(F.count(F.lit(1)).alias("n"))
    links = places.where("before is not null").groupBy(F.col("before.node").alias("pn"), F.col("before.edge").alias("pe"), "node", "edge").agg(F.count(F.lit(1)).alias("met"))
    links = links.join(count.where("n > 0"), ["node", "edge"]).where("met = n").select("pn", "pe", "node", "edge", "met")
    links = links.join(count.toDF("pn", "pe", "all"), ["pn", "pe"]).where("met = all").select("node", "edge", F.lit(True).alias("linked"))
    marked = splittable(places.select("key", "node", "edge", "lo", "hi"), links, ["node", "edge"], "left")
    first = F.last(F.when(F.col("linked").isNull(), F.struct("node", "edge", "lo")), ignorenulls=True).over(along)
    out = marked.withColumn("first", first).groupBy("key", "first").agg(F.max("hi").alias("hi")).select("key", "first.node", "first.edge", "first.lo", "hi")
    out._cut = places._cut
    return out


def repeated_spans(documents: DataFrame, window: int = 35, k: int = 8, bits: int = 64, named: bool = False) -> DataFrame:
    """(key, lo, hi): windows lo..hi of the text with that key are repeated somewhere. key: see text_key()."""
    spark = documents.sparkSession
    small_batches(spark)
    texts = documents.select(text_key().alias("key"), "text")
    nodes = texts.mapInArrow(_nodes(window, k, named, bits), NODES)
    seen = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("met"), F.min("edge").alias("one"), F.max("edge").alias("other")).where("met > 1")
    # written first: an aggregate under the join would keep Spark from splitting a node that many windows share
    seen = cut(seen.select("node", (F.col("one") != F.col("other")).alias("branching")))
    release(spark)
    met = cut(nodes.join(seen, "node"))
    release(spark)
    branching = met.where("branching").select("key", "node", "edge", "lo", "hi")
    edges = cut(branching.groupBy("node", "edge").agg(F.count(F.lit(1)).alias("weight"), F.min(F.struct("key", "lo", "hi")).alias("at")))
    parallel = branching.join(edges.where("weight > 1").select("node", "edge"), ["node", "edge"], "left_semi")
    found = compacted(met.where("not branching").select("key", "node", "edge", "lo", "hi").unionByName(parallel))
    paths = cut(found)  # its shuffle files go before the texts move
    release(spark)
    forget(met, seen, found)
    branches = edges.select("at.key", F.struct(F.lit(False).alias("path"), "node", "edge", "at.lo", "at.hi", "weight").alias("one"))
    whole = paths.select("key", F.struct(F.lit(True).alias("path"), "node", "edge", "lo", "hi", F.lit(1).cast("long").alias("weight")).alias("one"))
    todo = branches.unionByName(whole).groupBy("key").agg(F.collect_list("one").alias("todo"))
    read = cut(texts.join(todo, "key").mapInArrow(_read(window), READ))
    forget(edges, paths)
    release(spark)
    wrong = read.where("path").groupBy("node", "edge").agg(F.min("words").alias("one"), F.max("words").alias("other")).where("one <> other")
    if not named and not wrong.isEmpty():
        forget(read)
        return repeated_spans(documents, window, k, bits, True)
    windows = read.where("not path").select("key", "words", "lo", "weight")
    again = windows.groupBy("words").agg(F.sum("weight").alias("met")).where("met > 1").select("words")
    single = splittable(windows.where("weight = 1"), again, ["words"], "left_semi").select("key", "lo", F.col("lo").alias("hi"))
    out = read.where("path").select("key", "lo", "hi").unionByName(single).distinct()
    out._cut = read._cut
    return out


def substring_dedup(documents: DataFrame, window: int = 35, k: int = 8, with_text: bool = False, bits: int = 64) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept_text) of every row of documents(doc_id, text). bits: of a word's running hash;
    fewer collide more often and cost time, results do not change."""
    if not 1 <= k <= window:
        raise ValueError("k must lie between 1 and window")
    spark = documents.sparkSession
    found = repeated_spans(documents, window, k, bits)
    spans = cut(found.groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")))
    forget(found)
    release(spark)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), "text").join(spans, "key", "left")
    rows = rows.select("doc_id", "text", F.coalesce("spans", F.array().cast("array<struct<lo:int,hi:int>>")).alias("spans"))
    return rows.mapInArrow(_keep(window, with_text), KEPT + (", kept_text string" if with_text else ""))
