"""Near duplicates by word-shingle Jaccard similarity, with Bayesian candidate pruning.

Equal texts form a class first and act once, with their number. Each class has `BANDS * ROWS` MinHash values of its word
5-shingles, a byte each; five in a row make one LSH key. Classes that share a key are compared value by value: after every
`STEP` values a pair goes when the posterior probability (uniform prior) that its similarity reaches the threshold falls
below `TOLERANCE`. Survivors link candidate groups, and within those every surviving pair is verified on the exact sets.

Pairs never become rows. Groups are cut into blocks of a bounded size, every two blocks of a group meet in one place, and
what leaves is one row a class and place: its links there and the smallest class it hangs together with. A group of any
size is therefore spread over many tasks, no link is lost to a cap, and no task holds more than two blocks.

Defined results: a null or empty text, or one without words, has no shingles and no links; a text of one to four words is one
shingle of all its words; texts of any length count whole; a similarity equal to the threshold links; equal texts are linked
whatever their length if they have words; a null doc_id never names a class; repeated rows are equal texts; other columns pass
through one_of_each() whatever their names and are otherwise ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .components import components
from .runtime import cut, forget, release, small_batches, splittable, text_key, unused

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS, STEP, TOLERANCE = 24, 5, 24, 1e-5
BLOCK_ROWS, BLOCK_BYTES = 1_024, 4 << 20
SLAB = 1 << 18
SIGNATURES = "key binary, doc_id long, n_shingles int, sig binary, bands array<long>"

_rng = np.random.Generator(np.random.PCG64(4_242))
_FLIP = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
_ODD = _rng.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingles(w: W.Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every shingle in order of documents, repeats included."""
    n = w.counts()
    runs, at = W.Runs(w.hashes), np.flatnonzero(W.whole(w.first, k))
    doc = np.searchsorted(w.first, at, "right") - 1
    short = np.flatnonzero((n > 0) & (n < k))
    docs = np.concatenate([doc, short])
    values = np.concatenate([runs.grams(k)[at] if len(at) else np.zeros(0, np.uint64), runs.of(w.first[short], w.first[short + 1])])
    order = np.argsort(docs, kind="stable")
    return docs[order], values[order]


def minhash(doc: np.ndarray, values: np.ndarray, n_docs: int) -> np.ndarray:
    """n_docs x (BANDS * ROWS) bytes; rows of documents without shingles are zero."""
    out = np.zeros((n_docs, BANDS * ROWS), np.uint8)
    if not len(doc):
        return out
    start = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    low = (values >> np.uint64(32)).astype(np.uint32)
    for i in range(BANDS * ROWS):
        least = np.minimum.reduceat((low ^ _FLIP[i]) * _ODD[i], start)
        out[doc[start], i] = (least * np.uint32(0x9E3779B1)) >> np.uint32(24)
    return out


def _signatures(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, docs in W.pieces(batch):
                w = W.split(buf, docs)
                doc, values = shingles(w, k)
                sig = minhash(doc, values, len(part))
                wide = sig.reshape(len(part), BANDS, ROWS).astype(np.int64)
                key = np.broadcast_to(np.arange(BANDS, dtype=np.int64), wide.shape[:2]).copy()
                for r in range(ROWS):
                    key = key << 8 | wide[:, :, r]
                n = np.bincount(doc, minlength=len(part)).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(0, key.size + 1, BANDS, dtype=np.int32)), pa.array(key.ravel()))
                yield pa.record_batch([part.column(0), part.column(1), pa.array(n), pa.array([x.tobytes() for x in sig], pa.binary()), bands], names=["key", "doc_id", "n_shingles", "sig", "bands"])

    return run


@lru_cache
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """Matches a pair needs after each STEP values to stay: P(similarity >= threshold | matches) >= tolerance."""
    grid = (np.arange(4_000) + 0.5) / 4_000
    match = grid + (1 - grid) / 256  # a byte agrees by chance as well
    out = []
    for n in range(STEP, BANDS * ROWS + 1, STEP):
        for m in range(n + 1):
            log = m * np.log(match) + (n - m) * np.log1p(-match + 1e-12)
            p = np.exp(log - log.max())
            if p[grid >= threshold].sum() / p.sum() >= tolerance:
                out.append(m)
                break
    return tuple(out)


def partners(group: np.ndarray, side: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Range of later rows each row is compared with. Rows stand by group, then side; two: the group joins two blocks."""
    n = len(group)
    new = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if n else np.zeros(0, np.int64)
    size = np.diff(np.append(new, n))
    end = np.repeat(new + size, size)
    first = np.add.reduceat((side == 0).astype(np.int64), new) if n else np.zeros(0, np.int64)
    middle = np.repeat(new + first, size)
    lo = np.where(two, middle, np.arange(n) + 1)
    return np.where(two & (side == 1), end, lo), end


def surviving(sig: np.ndarray, lo: np.ndarray, hi: np.ndarray, need: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs that Bayesian pruning leaves, in slabs of bounded size."""
    n = hi - lo
    sums = np.concatenate([[0], np.cumsum(n)])
    at = 0
    while at < len(n):
        to = max(at + 1, int(np.searchsorted(sums, sums[at] + SLAB, "right")) - 1)
        left = np.repeat(np.arange(at, to), n[at:to])
        right = lo[left] + np.arange(len(left)) - (sums[left] - sums[at])
        at = to
        met = np.zeros(len(left), np.int16)
        for step, least in enumerate(need):
            cols = slice(step * STEP, (step + 1) * STEP)
            met += (sig[left, cols] == sig[right, cols]).sum(1, dtype=np.int16)
            stay = met >= least
            left, right, met = left[stay], right[stay], met[stay]
            if not len(left):
                break
        if len(left):
            yield left, right


def roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest row each row hangs together with."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], most: int) -> Iterator[pa.Table]:
    """Tables of whole groups of sorted batches, of about `most` bytes unless a group is larger."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and size >= most:
            last = [held[-1].column(k)[-1].as_py() for k in keys]
            same = np.ones(batch.num_rows, bool)
            for k, v in zip(keys, last, strict=True):
                same &= np.array([x == v for x in batch.column(k).to_pylist()])
            cut_at = int(np.argmin(same)) if not same.all() else batch.num_rows
            if cut_at < batch.num_rows:
                if cut_at:
                    held.append(batch.slice(0, cut_at))
                yield pa.Table.from_batches(held)
                held, size, batch = [], 0, batch.slice(cut_at)
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.Table.from_batches(held)


def _numbers(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Group number of each row of a sorted table."""
    new = np.zeros(table.num_rows, bool)
    for k in keys:
        col = table.column(k).combine_chunks()
        v = col.dictionary_encode().indices.to_numpy() if pa.types.is_binary(col.type) else col.to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.cumsum(new)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


GROUP = ["group", "i", "j"]


def _candidates(threshold: float, tolerance: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        need = least_matches(threshold, tolerance)
        for table in whole_groups(batches, GROUP, 4 << 20):
            group, side = _numbers(table, GROUP), table.column("side").to_numpy()
            lo, hi = partners(group, side, table.column("i").to_numpy() != table.column("j").to_numpy())
            found = list(surviving(_matrix(table.column("sig"), BANDS * ROWS), lo, hi, need))
            if not found:
                continue
            root = roots(table.num_rows, *(np.concatenate(x) for x in zip(*found, strict=True)))
            key, at = table.column("key").combine_chunks(), np.flatnonzero(root != np.arange(table.num_rows))
            yield pa.record_batch([key.take(pa.array(at)), key.take(pa.array(root[at]))], names=["a", "b"])

    return run


def exact(values: np.ndarray, first: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs (sorted by left) reach the threshold; values: shingle sets as numbers, back to back."""
    out = np.zeros(len(left), bool)
    mark = np.zeros(int(values.max(initial=0)) + 1, bool)
    size = np.diff(first)
    start = np.flatnonzero(np.append(True, left[1:] != left[:-1]))
    for s, e in zip(start.tolist(), np.append(start[1:], len(left)).tolist(), strict=True):
        a = int(left[s])
        own = values[first[a] : first[a + 1]]
        mark[own] = True
        for c in range(s, e, 4_096):
            r = right[c : min(e, c + 4_096)]
            n = size[r]
            index = np.repeat(first[r] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            both = np.add.reduceat(mark[values[index]].astype(np.int64), np.cumsum(n) - n)
            out[c : c + len(r)] = both >= threshold * (n + len(own) - both) - 1e-9
        mark[own] = False
    return out


def _verify(threshold: float, tolerance: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        need = least_matches(threshold, tolerance)
        for table in whole_groups(batches, GROUP, 4 << 20):
            n, copies = table.num_rows, table.column("copies").to_numpy()
            group, side = _numbers(table, GROUP), table.column("side").to_numpy()
            lo, hi = partners(group, side, table.column("i").to_numpy() != table.column("j").to_numpy())
            sets = table.column("shingles").to_pylist()
            first = np.concatenate([[0], np.cumsum([len(x) // 8 for x in sets])]).astype(np.int64)
            values = np.unique(np.frombuffer(b"".join(sets), np.uint64), return_inverse=True)[1]
            del sets
            links, pairs = np.zeros(n, np.int64), []
            for left, right in surviving(_matrix(table.column("sig"), BANDS * ROWS), lo, hi, need):
                good = exact(values, first, left, right, threshold)
                left, right = left[good], right[good]
                np.add.at(links, left, copies[right])
                np.add.at(links, right, copies[left])
                if len(left):
                    pairs.append((left, right))
            root = roots(n, *(np.concatenate(x) for x in zip(*pairs, strict=True))) if pairs else np.arange(n)
            key, at = table.column("key").combine_chunks(), np.flatnonzero(links)
            yield pa.record_batch([key.take(pa.array(at)), key.take(pa.array(root[at])), pa.array(links[at])], names=["key", "root", "links"])

    return run


def _shingle_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for part, buf, docs in W.pieces(batch):
                doc, values = shingles(W.split(buf, docs), k)
                order = np.lexsort((values, doc))
                doc, values = doc[order], values[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (values[1:] != values[:-1])
                doc, values = doc[new], values[new]
                first = np.searchsorted(doc, np.arange(len(part) + 1))
                sets = pa.array([values[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())
                yield pa.record_batch([*(c for i, c in enumerate(part.columns) if i != at), sets], names=[*(x for x in part.schema.names if x != "text"), "shingles"])

    return run


def block_pairs(rows: DataFrame, group: str, blocks: str, key: str = "key") -> DataFrame:
    """Rows dealt to every pair of blocks of their group: group, i, j, side and the rest; sorted for whole_groups()."""
    own = F.pmod(F.xxhash64(key), F.col(blocks)).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1)))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).withColumn("side", (F.col("own") > F.col("other")).cast("int"))
    dealt = dealt.withColumnRenamed(group, "group").drop("own", "other", blocks)
    return dealt.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "side")


def classes_of(documents: DataFrame, k: int = SHINGLE) -> DataFrame:
    """One row a text with words: key, rep (smallest doc_id), copies, n_shingles, sig, bands."""
    rows = documents.select(text_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_signatures(k), SIGNATURES)
    found = rows.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.max("n_shingles").alias("n_shingles"), F.max("sig").alias("sig"), F.max("bands").alias("bands"))
    return cut(found.where("n_shingles > 0"))


def near_links(documents: DataFrame, classes: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE, tolerance: float = TOLERANCE) -> DataFrame:
    """(key, root, links) at every place a class was verified: its links there, and a class it hangs together with."""
    banded = classes.select("key", F.explode("bands").alias("band"))
    full = banded.groupBy("band").agg(F.count(F.lit(1)).alias("met")).where("met > 1")
    full = cut(full.select("band", F.ceil(F.col("met") / BLOCK_ROWS).cast("int").alias("blocks")))
    met = banded.join(full, "band").join(classes.select("key", "sig"), "key")
    edges = block_pairs(met, "band", "blocks").mapInArrow(_candidates(threshold, tolerance), "a binary, b binary").distinct()
    groups = components(edges)
    forget(full)
    release(documents.sparkSession)
    member = groups.join(classes.select("key", "rep", "copies", "n_shingles", "sig"), groups.node == F.col("key")).drop("node")
    size = member.groupBy("label").agg(F.greatest(F.ceil(F.sum("n_shingles") * 8 / BLOCK_BYTES), F.ceil(F.count(F.lit(1)) / (2 * BLOCK_ROWS))).cast("int").alias("blocks"))
    member = cut(splittable(member, size, ["label"]))
    forget(groups)
    texts = documents.select(text_key().alias("k"), F.col("doc_id").cast("long").alias("d"), "text")
    chosen = texts.join(member, (F.col("k") == F.col("key")) & F.col("d").eqNullSafe(F.col("rep"))).select("label", "blocks", "key", "copies", "sig", "text")
    sets = chosen.mapInArrow(_shingle_sets(k), "label binary, blocks int, key binary, copies long, sig binary, shingles binary").dropDuplicates(["key"])
    found = cut(block_pairs(sets, "label", "blocks").mapInArrow(_verify(threshold, tolerance), "key binary, root binary, links long"))
    forget(member)
    return found


def near_classes(documents: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE, tolerance: float = TOLERANCE) -> DataFrame:
    """One row a text with words: key, rep, copies, links (other documents at the threshold or above), class_id."""
    small_batches(documents.sparkSession)
    classes = classes_of(documents, k)
    found = near_links(documents, classes, threshold, k, tolerance)
    release(documents.sparkSession)
    label = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("key").agg(F.sum("links").alias("more"))
    out = classes.select("key", "rep", "copies").join(links, "key", "left").join(label, F.col("key") == F.col("node"), "left")
    out = out.select("key", "rep", "copies", (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("links"), F.coalesce("label", "key").alias("label"))
    least = out.groupBy("label").agg(F.min("rep").alias("class_id"))
    out = cut(splittable(out, least, ["label"]).select("key", "rep", "copies", "links", "class_id"))
    forget(classes, found, label)
    return out


def jaccard_join(documents: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, class_id (smallest doc_id of its near-duplicate class) and n_links of every row of documents(doc_id, text)."""
    found = near_classes(documents, threshold, k, tolerance).select("key", "links", "class_id")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"))
    return rows.join(found, "key", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("links", F.lit(0)).alias("n_links"))


def one_of_each(documents: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE, tolerance: float = TOLERANCE) -> DataFrame:
    """Rows of documents, one a near-duplicate class: that of the smallest doc_id. Texts without words all stay."""
    own, key, rep, least = unused(documents, "own", "key", "rep", "least")
    found = near_classes(documents, threshold, k, tolerance).select(F.col("key").alias(key), F.col("rep").alias(rep), F.col("class_id").alias(least))
    columns = documents.columns
    keyed = documents.select(text_key().alias(own), "doc_id").groupBy(own, "doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(own)
    twins = cut(keyed.join(found, F.col(own) == F.col(key), "left_semi").distinct())
    release(documents.sparkSession)
    rows = documents.withColumn(own, text_key()).join(found, F.col(own) == F.col(key), "left")
    first = F.col(least).eqNullSafe(F.col(rep)) & F.col(rep).eqNullSafe(F.col("doc_id").cast("long"))
    kept = rows.where(F.col(key).isNull() | first).select(own, *columns)
    if not twins.isEmpty():  # rows that stand there more than once, id and all
        kept = kept.join(twins, own, "left_anti").unionByName(kept.join(twins, own, "left_semi").dropDuplicates([own]))
    return kept.select(*columns)
