"""Centroid clustering by Lloyd's rounds with Yinyang's filters.

Components become the integers floor(1024 * x), so distances, sums and means are exact and every round's result is that of a
plain scan. Centroids start as the vectors with the smallest salted hashes of their ids. They are clustered into groups once;
a vector keeps its centroid, an upper bound on the distance to it, and for every group one lower bound on the distance to
the group's other centroids. After a round the upper bound grows by its centroid's drift and each lower bound shrinks by the
largest drift of its group. A vector whose upper bound lies under all its lower bounds keeps its centroid unread (the
global filter, tried again once the upper bound is made exact); of the others, only groups whose lower bound is reached are
scanned, each centroid of them exactly. Bounds are doubles widened by more than their rounding, and equality never passes a
filter, so ties are decided by the exact scan: the smaller number.

Each round is one pass: a task reads its vectors with their bounds, and writes both back together with one row of exact
component sums and counts for each centroid. The next centroids come from those rows alone (column pruning leaves the
vectors unread), (centroids x components) numbers on the driver however many vectors there are. No vector is ever shuffled.
A round's table is written before the last one goes, so a lost executor repeats its own tasks.

Defined results: vectors of another length, null ones, and those with a null or non-finite component are left out; repeated
rows count each; a missing id is hashed as the empty text; equal hashes start in the order of their components; with fewer
vectors than centroids every vector starts one; an empty centroid stays where it is; other columns, whatever their names,
are ignored; an empty table gives an empty result. A component so large that a distance could leave 64 bits
(2^27 after scaling, at 64 components) is an error.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import cut, forget, small_batches

DIM, CLUSTERS, ROUNDS, SEED, SCALE = 64, 8, 10, 3, 1024
#: Centroids a group holds on average.
GROUP = 3
#: Numbers of one block of distances.
_BLOCK = 1 << 20
_UP, _DOWN = 1 + 1e-9, 1 - 1e-9
_FAR = np.iinfo(np.int64).max
_STATE = "vec_id long, v array<int>, cluster int, distance long, upper double, lower array<double>, sums array<long>, n long, inertia long, computed long"
_SCHEMA = pa.schema([
    ("vec_id", pa.int64()), ("v", pa.list_(pa.int32())), ("cluster", pa.int32()), ("distance", pa.int64()), ("upper", pa.float64()), ("lower", pa.list_(pa.float64())),
    ("sums", pa.list_(pa.int64())), ("n", pa.int64()), ("inertia", pa.int64()), ("computed", pa.int64()),
])


def integer_vectors(embeddings: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """(vec_id long, v array<int>) of the vectors that count."""
    x = F.col("embedding").cast("array<double>")
    counts = F.when(F.size("embedding") == dim, ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    most = min(2**31 - 1, math.isqrt((2**63 - 1) // dim) // 2)
    integer = F.transform(x, lambda c: F.when(F.abs(c * scale) < most, F.floor(c * scale).cast("int")).otherwise(F.raise_error(F.lit("distances to this vector leave 64 bits")).cast("int")))
    return embeddings.where(F.coalesce(counts, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), integer.alias("v"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(h.alias("h"), "v").orderBy("h", "v").limit(clusters).collect()
    return np.array([r.v for r in rows], np.int64).reshape(len(rows), len(rows[0].v) if rows else 0)


def grouping(centroids: np.ndarray, size: int = GROUP, rounds: int = 5) -> np.ndarray:
    """The group of each centroid, groups of about `size`: a few rounds of means over the centroids themselves."""
    x = centroids.astype(np.float64)
    groups, of = max(1, -(-len(x) // size)), np.zeros(len(x), np.int64)
    middle = x[:groups].copy()
    for _ in range(rounds):
        of = np.array([((middle - row) ** 2).sum(1).argmin() for row in x], np.int64)
        for g in range(groups):
            if (of == g).any():
                middle[g] = x[of == g].mean(0)
    return np.unique(of, return_inverse=True)[1]


def _squares(v: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    d = v - centroid
    return np.einsum("ij,ij->i", d, d)


def _bound(squares: np.ndarray, widen: float) -> np.ndarray:
    return np.where(squares == _FAR, np.inf, np.sqrt(squares.astype(np.float64)) * widen)


def _least(bound: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The smallest bound of each group."""
    return np.stack([bound[:, group == g].min(1) for g in range(group.max() + 1)], 1)


def first_step(v: np.ndarray, centroids: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Clusters, squared distances, upper and lower bounds, and the number of distances computed, of vectors without bounds."""
    d = np.stack([_squares(v, c) for c in centroids], 1)
    rows, cluster = np.arange(len(v)), d.argmin(1)
    own = d[rows, cluster]
    d[rows, cluster] = _FAR
    return cluster, own, _bound(own, _UP), _least(_bound(d, _DOWN), group), d.size


def step(v: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: np.ndarray, group: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """The same after centroids moved by `drift` (never too small); a squared distance that no filter asked for is -1."""
    cluster, distance, computed = cluster.copy(), np.full(len(v), -1, np.int64), 0
    largest = np.array([drift[group == g].max() for g in range(group.max() + 1)])
    upper, lower = (upper + drift[cluster]) * _UP, lower - largest
    lower *= np.where(lower > 0, _DOWN, _UP)
    nearest = lower.min(1)
    past = np.flatnonzero(upper >= nearest)
    for c in np.unique(cluster[past]):  # the bound that is exact may yet do
        at = past[cluster[past] == c]
        distance[at] = _squares(v[at], centroids[c])
    computed += len(past)
    upper[past] = _bound(distance[past], _UP)
    past = past[upper[past] >= nearest[past]]
    for i in range(0, len(past), max(1, _BLOCK // len(centroids))):
        at = past[i : i + max(1, _BLOCK // len(centroids))]
        rows, old = np.arange(len(at)), cluster[at]
        hit = upper[at, None] >= lower[at]  # groups past their filter
        d = np.full((len(at), len(centroids)), _FAR)
        # a centroid that drifted less than the fastest of its group lies beyond this
        bound = lower[at][:, group] + (largest[group] - drift) * _DOWN
        bound *= np.where(bound > 0, _DOWN, _UP)
        scan = hit[:, group] & (upper[at, None] >= bound)
        scan[rows, old] = False
        for c in range(len(centroids)):
            if scan[:, c].any():
                d[scan[:, c], c] = _squares(v[at[scan[:, c]]], centroids[c])
        computed += int(scan.sum())
        d[rows, old] = distance[at]
        best = d.argmin(1)
        cluster[at], distance[at] = best, d[rows, best]
        upper[at] = _bound(distance[at], _UP)
        known = d != _FAR
        bound = np.where(known, _bound(d, _DOWN), bound)
        bound[rows, best] = np.inf
        # a group that was not scanned keeps its bound, but for the centroid that a vector has just left
        left = (best != old)[:, None] & (group[old][:, None] == np.arange(lower.shape[1]))
        kept = np.where(left, np.minimum(lower[at], _bound(d[rows, old], _DOWN)[:, None]), lower[at])
        lower[at] = np.where(hit, _least(bound, group), kept)
    return cluster, distance, upper, lower, computed


class _Totals:
    """Exact sums of what a task has assigned to each centroid."""

    def __init__(self, clusters: int, dim: int):
        self.sums, self.n, self.inertia, self.computed = np.zeros((clusters, dim), np.int64), np.zeros(clusters, np.int64), np.zeros(clusters, np.int64), 0

    def add(self, v: np.ndarray, cluster: np.ndarray, distance: np.ndarray, computed: int) -> None:
        order = np.argsort(cluster, kind="stable")
        found, first = np.unique(cluster[order], return_index=True)
        self.sums[found] += np.add.reduceat(v[order], first, 0)
        self.n += np.bincount(cluster, minlength=len(self.n))
        self.inertia[found] += np.add.reduceat(distance[order], first)
        self.computed += computed

    def batch(self) -> pa.RecordBatch:
        rows = [{"cluster": c, "sums": self.sums[c].tolist(), "n": int(n), "inertia": int(self.inertia[c]), "computed": self.computed if i == 0 else 0} for i, (c, n) in enumerate((c, n) for c, n in enumerate(self.n) if n)]
        return pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def _assign(centroids: np.ndarray, group: np.ndarray, drift: np.ndarray | None, exact: bool):
    """A task of a round; exact: every distance is wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = _Totals(*centroids.shape)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            v = rows["v"].flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.int64)
            if drift is None:
                cluster, distance, upper, lower, computed = first_step(v, centroids, group)
            else:
                bounds = rows["lower"].flatten().to_numpy().reshape(batch.num_rows, -1)
                cluster, distance, upper, lower, computed = step(v, rows["cluster"].to_numpy().astype(np.int64), rows["upper"].to_numpy(), bounds, centroids, group, drift)
            if exact:
                for c in np.unique(cluster[distance < 0]):
                    at = np.flatnonzero((distance < 0) & (cluster == c))
                    distance[at] = _squares(v[at], centroids[c])
            totals.add(v, cluster, distance, computed)
            n, groups = lower.shape
            none = [pa.nulls(n, t) for t in (pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64())]
            offsets = pa.array(np.arange(0, n * groups + 1, groups, dtype=np.int32))
            yield pa.record_batch([rows["vec_id"], rows["v"], pa.array(cluster.astype(np.int32)), pa.array(distance), pa.array(upper), pa.ListArray.from_arrays(offsets, pa.array(lower.ravel())), *none], schema=_SCHEMA)
        if totals.n.any():
            yield totals.batch()

    return run


def _next(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Exact means, rounded down; (centroids x components) sums reach the driver."""
    each = state.where("n is not null").select("cluster", "n", F.posexplode("sums").alias("place", "sum"))
    out = centroids.copy()
    for c, place, total, n in zip(*each.groupBy("cluster", "place").agg(F.sum("sum"), F.sum("n")).toArrow().to_pydict().values(), strict=True):
        out[c, place] = total // n
    return out


def cluster_rounds(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED, group_size: int = GROUP) -> tuple[DataFrame, np.ndarray, list[int]]:
    """The last round's table (vec_id, cluster, distance of its rows without n), the final centroids, and distances computed in each assignment."""
    small_batches(embeddings.sparkSession)
    vectors = integer_vectors(embeddings, dim, scale)
    centroids = first_centroids(vectors, clusters, seed)
    if not len(centroids):
        return embeddings.sparkSession.createDataFrame([], _STATE), centroids, []
    group, work = grouping(centroids, group_size), []
    state, drift = vectors, None
    for i in range(rounds + 1):
        last, state = state, cut(state.mapInArrow(_assign(centroids, group, drift, i == rounds), _STATE))
        if hasattr(last, "_cut"):
            forget(last)
        work.append(state.where("n is not null").agg(F.sum("computed")).first()[0])
        if i < rounds:
            moved = _next(state, centroids)
            drift = np.array([math.sqrt(sum(int(x) ** 2 for x in row)) for row in moved - centroids]) * _UP
            centroids, rows = moved, state.where("n is null").select("vec_id", "v", "cluster", "upper", "lower")
            rows._cut = state._cut
            state = rows
    return state, centroids, work


def cluster_vectors(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector of embeddings(vec_id, embedding) that counts."""
    state, centroids, _ = cluster_rounds(embeddings, clusters, rounds, dim, scale, seed)
    sums = {r.cluster: r.inertia for r in state.where("n is not null").groupBy("cluster").agg(F.sum("inertia").alias("inertia")).collect()}
    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids.tolist()]
    final = [(c, sums.get(c, 0), sum(sums.values()), digest) for c, digest in enumerate(digests)]
    table = embeddings.sparkSession.createDataFrame(final, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.where("n is null").select("vec_id", "cluster", "distance").join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
