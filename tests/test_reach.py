import random

from strataquarry.operators import reach


def plain_waves(nodes, edges):
    wait = {n: {t for s, t in edges if s == n and t != n and t in nodes} for n in nodes}
    out, wave = {}, 0
    while True:
        layer = [n for n in wait if n not in out and all(t in out for t in wait[n])]
        if not layer:
            break
        out |= dict.fromkeys(layer, wave)
        wave += 1
    return out | dict.fromkeys(set(nodes) - set(out), wave)


def plain_components(edges):
    nodes = {x for e in edges for x in e if None not in e}
    reach_of = {}
    for n in nodes:
        seen, todo = set(), [n]
        while todo:
            x = todo.pop()
            for s, t in edges:
                if s == x and t is not None and t not in seen:
                    seen.add(t)
                    todo.append(t)
        reach_of[n] = seen
    own = {n: {m for m in reach_of[n] if n in reach_of.get(m, ())} for n in nodes if n in reach_of[n]}
    return {n: (min(c), len(c)) for n, c in own.items()}


def random_graph(rng, n, m):
    """Sparse edges with strands and rings put in."""
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
    for start in (100, 200):
        strand = list(range(start, start + rng.randrange(2, 9)))
        edges += list(zip(strand, strand[1:]))
        edges += [(rng.randrange(n), strand[0]), (strand[-1], rng.randrange(n))]
    ring = list(range(300, 304))
    return edges + list(zip(ring, ring[1:] + ring[:1]))


def many_graphs(count, n, m, acyclic):
    """Random graphs side by side."""
    edges = []
    for seed in range(count):
        rng = random.Random(seed)
        edges += [(a + 1000 * seed, b + 1000 * seed) for a, b in random_graph(rng, n, m) if not acyclic(seed) or a != b for a, b in [(max(a, b), min(a, b)) if acyclic(seed) else (a, b)]]
    return edges


def test_components_equal_plain_search(spark):
    edges = many_graphs(6, 13, 15, lambda seed: seed == 5) + [(50, 50), (51, None), (None, 3)]
    got = {r.node: (r.component, r.size) for r in reach.components(spark.createDataFrame(edges, "source int, target int")).collect()}
    assert got == plain_components([e for e in edges if None not in e]) and len({c for c, _ in got.values()}) > 6


def test_waves_equal_layers(spark):
    """With and without cycles; edges to strangers, repeated ones and loops do not count."""
    edges = many_graphs(6, 12, 10, lambda seed: seed % 3 > 0)
    edges += [edges[0], (5, 5), (5, 99_999)]
    nodes = {x for e in edges for x in e} - {99_999} | {77}
    got = {r.node: r.wave for r in reach.waves(spark.createDataFrame([(n,) for n in nodes], "node int"), spark.createDataFrame(edges, "source int, target int")).collect()}
    assert got == plain_waves(nodes, edges)


def test_long_ring(spark):
    """A ring of 100,000 nodes, with a strand into it and one out of it, is one component in a logarithmic number of rounds."""
    n = 100_000
    ids = spark.range(n)
    ring = ids.selectExpr("(id * 7919) % 100000 as source", "((id + 1) * 7919) % 100000 as target")
    strands = spark.range(500).selectExpr("-id - 1 as source", "-id as target").union(spark.range(500).selectExpr(f"case when id = 0 then 5 else {n} + id end as source", f"{n} + id + 1 as target"))
    out = reach.components(ring.union(strands))
    assert [tuple(r) for r in out.groupBy("component", "size").count().collect()] == [(0, n, n)]


def test_deep_strand_in_few_rounds(spark, monkeypatch):
    """10,000 nodes, each waiting for the last one: no job per layer."""
    rounds = []
    plain = reach.cut
    monkeypatch.setattr(reach, "cut", lambda df: rounds.append(1) or plain(df))
    n = 10_000
    out = reach.waves(spark.range(n).toDF("node"), spark.range(1, n).selectExpr("id as source", "id - 1 as target"))
    assert len(rounds) < 30
    assert out.where("wave = node").count() == n


def test_empty(spark):
    none = spark.createDataFrame([], "source int, target int")
    assert reach.components(none).count() == 0
    assert reach.waves(none.selectExpr("source as node"), none).count() == 0
    assert [tuple(r) for r in reach.waves(spark.range(1).toDF("node"), none).collect()] == [(0, 0)]
