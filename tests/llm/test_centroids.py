import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataquarry.llm import centroids as ce

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, clusters, rounds, dim, seed=3):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in e]) for i, e in rows if e is not None and len(e) == dim and all(x is not None and math.isfinite(x) for x in e)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:clusters]
    c = [list(v) for _, v in start]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, x, strict=True)), j) for j, x in enumerate(c))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for j in range(len(c)):
            mine = [v for (_, v), o in zip(kept, of, strict=True) if o == j]
            if mine:
                c[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    final = [(i, *nearest(v)) for i, v in kept]
    inertia = [sum(d for _, d, j in final if j == k) for k in range(len(c))]
    return sorted(((i, j, d, inertia[j], sum(inertia), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, d, j in final), key=repr)


def vectors(rng, n, dim, spots=6, spread=0.2):
    middles = rng.normal(size=(spots, dim))
    return [(i, [float(x) for x in (middles[rng.integers(spots)] + rng.normal(scale=spread, size=dim)).astype(np.float32)]) for i in range(n)]


@pytest.mark.parametrize(("seed", "clusters", "dim", "spread"), [(1, 8, 64, 0.2), (2, 5, 3, 1.0), (3, 12, 2, 0.0)])
def test_equals_brute_force(spark, seed, clusters, dim, spread):
    """Also with equal distances (spread 0) and repeated rows; what does not count is left out."""
    rng = np.random.default_rng(seed)
    rows = vectors(rng, 150, dim, spread=spread)
    rows += [(7, rows[7][1]), (None, rows[8][1]), (900, None), (901, []), (902, rows[0][1][:-1]), (903, [None, *rows[0][1][1:]]), (904, [float("nan"), *rows[0][1][1:]]), (905, [float("-inf"), *rows[0][1][1:]]), (906, [0.0] * dim), (907, [-0.0005] * dim)]
    df = spark.createDataFrame([(i, e, None) for i, e in rows], SCHEMA).withColumns({"v": F.lit(1), "cluster": F.lit("c"), "n": F.lit(None)}).repartition(3)
    got = ce.cluster_vectors(df, clusters, 6, dim).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, clusters, 6, dim)


def test_filters_save_distances(spark):
    """On separate spots most vectors pass unread after the first assignment."""
    rng = np.random.default_rng(5)
    rows = [(i, e, 0) for i, e in vectors(rng, 600, 16, spots=9, spread=0.05)]
    _, centroids, work = ce.cluster_rounds(spark.createDataFrame(rows, SCHEMA), clusters=9, rounds=8, dim=16)
    assert work[0] == 600 * len(centroids) and sum(work[1:]) < 0.4 * 8 * 600 * len(centroids)


def test_steps_keep_their_bounds():
    """After any drift: the exact cluster, an upper bound over the distance, lower bounds under those to the other centroids of each group."""
    rng = np.random.default_rng(11)
    for k, dim in ((1, 3), (2, 2), (7, 4), (20, 5)):
        v = rng.integers(-60, 60, (400, dim))
        c = rng.integers(-60, 60, (k, dim))
        c[k // 2] = c[0]  # equal centroids: the smaller number
        group = ce.grouping(c, 3)
        cluster, _, upper, lower, _ = ce.first_step(v, c, group)
        for _ in range(6):
            moved = c + rng.integers(-9, 9, c.shape) * rng.integers(0, 2, (k, 1))
            drift = np.sqrt(((moved - c) ** 2).sum(1).astype(float)) * ce._UP
            c = moved
            cluster, distance, upper, lower, _ = ce.step(v, cluster, upper, lower, c, group, drift)
            d = ((v[:, None] - c[None]) ** 2).sum(2)
            assert (cluster == d.argmin(1)).all() and ((distance == d.min(1)) | (distance < 0)).all()
            assert (upper >= np.sqrt(d.min(1))).all()
            root = np.sqrt(d.astype(float))
            root[np.arange(len(v)), cluster] = np.inf
            assert all((lower[:, g] <= root[:, group == g].min(1)).all() for g in range(group.max() + 1))


def test_few_vectors_and_empty_table(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0], 0), (2, [0.5, -1.0], 0)], SCHEMA)
    assert sorted(map(tuple, ce.cluster_vectors(df, dim=2).collect())) == brute([(1, [0.0, 1.0]), (2, [0.5, -1.0])], 8, 10, 2)
    out = ce.cluster_vectors(df.limit(0), dim=2)
    assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_components_beyond_64_bit_distances(spark):
    with pytest.raises(Exception, match="leave 64 bits"):
        ce.cluster_vectors(spark.createDataFrame([(1, [3e38] * 64, 0)], SCHEMA)).collect()
