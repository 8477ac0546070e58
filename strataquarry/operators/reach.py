"""Depth and cycles of large directed graphs.

Rounds that walk one edge at a time need as many rounds as a graph is deep. Here, stretches without branches are contracted
first by pointer doubling (a row takes over what the row it points at points at), so they cost the logarithm of their length;
only branching layers are walked. Every round is one equi-join whose lineage is cut. No pairs of nodes are ever formed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import land as cut


def _double(chain: DataFrame, n: int) -> tuple[DataFrame, bool]:
    """chain(node, root, base, step) with root outside the chain, where rings allow it, and `ring` for the rows they don't.

    A row says value(node) = max(base, value(root) + step); n rows. Also whether there is any ring."""
    reach = 1
    while True:
        ahead = chain.select(F.col("node").alias("root"), F.col("root").alias("_root"), F.col("base").alias("_base"), F.col("step").alias("_step"))
        found = chain.drop("ring").join(ahead, "root", "left")
        base = F.greatest("base", F.coalesce(F.col("_base") + F.col("step"), F.col("base")))
        chain = cut(found.select("node", F.coalesce("_root", "root").alias("root"), base.alias("base"), (F.col("step") + F.coalesce("_step", F.lit(0))).alias("step"), F.col("_root").isNotNull().alias("ring")))
        open_rows = chain.where("ring").count()
        if not open_rows or reach >= n:
            return chain, open_rows > 0
        reach *= 2


def waves(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, wave): a node stands one wave after the last node it depends on, edges(source, target); cycles and what depends on them are one last wave.

    A node with one dependency left is contracted into what that one comes down to, a longest path being a sum of weights, and
    gets its wave at the end; nodes without dependencies get theirs at once. What neither reaches stays for the last wave."""
    every = cut(nodes.select("node").distinct())
    ways = edges.where("source <> target").select("source", "target").distinct()
    ways = ways.join(every.select(F.col("node").alias("source")), "source", "left_semi").join(every.select(F.col("node").alias("target")), "target", "left_semi")
    ways = cut(ways.select("source", "target", F.lit(1).cast("long").alias("weight")))
    rows = every.select("node", F.lit(0).cast("long").alias("base"), F.lit(False).alias("stuck"))
    done = every.limit(0).select("node", F.lit(0).cast("long").alias("wave"))
    later = []
    while True:
        out = ways.groupBy(F.col("source").alias("node")).agg(F.count(F.lit(1)).alias("n"), F.max("target").alias("root"), F.max("weight").alias("step"))
        state = cut(rows.join(out, "node", "left").withColumn("n", F.coalesce("n", F.lit(0))))
        free, single = state.agg(F.count_if(F.col("n") == 0), F.count_if(~F.col("stuck") & (F.col("n") == 1))).first()
        if not free and not single:
            break
        levels = state.where("n = 0").select("node", F.col("base").alias("wave"))
        done = done.unionByName(levels)
        rest = state.where("n > 1 or stuck and n > 0").select("node", "base", "stuck")
        chain = state.where("n = 1 and not stuck").select("node", "root", "base", "step")
        if single:
            chain, rings = _double(chain, single)
            later.append(chain.where("not ring").drop("ring"))
            if rings:
                rest = rest.unionByName(state.join(chain.where("ring").select("node"), "node", "left_semi").select("node", "base", F.lit(True).alias("stuck")))
            chain = later[-1]
        kept = ways.join(rest.select(F.col("node").alias("source")), "source", "left_semi")
        kept = kept.join(chain.select(F.col("node").alias("target"), "root", "base", "step"), "target", "left")
        kept = kept.select("source", F.coalesce("root", "target").alias("target"), (F.col("weight") + F.coalesce("step", F.lit(0))).alias("weight"), (F.col("base") + F.col("weight")).alias("least"))
        kept = kept.join(levels.select(F.col("node").alias("target"), "wave"), "target", "left").withColumn("least", F.greatest("least", F.col("wave") + F.col("weight")))
        kept = cut(kept)
        lift = kept.groupBy(F.col("source").alias("node")).agg(F.max("least").alias("least"))
        rows = cut(rest.join(lift, "node", "left").select("node", F.greatest("base", F.coalesce("least", F.lit(0))).alias("base"), "stuck"))
        ways = kept.where("wave is null").groupBy("source", "target").agg(F.max("weight").alias("weight"))
    for chain in reversed(later):
        found = chain.join(done.select(F.col("node").alias("root"), "wave"), "root")
        done = cut(done.unionByName(found.select("node", F.greatest("base", F.col("wave") + F.col("step")).alias("wave"))))
    last = done.agg(F.coalesce(F.max("wave") + 1, F.lit(0)).cast("long")).first()[0]
    return done.unionByName(every.join(done.select("node"), "node", "left_anti").withColumn("wave", F.lit(last).cast("long"))).select("node", F.col("wave").cast("int").alias("wave"))


def _ends(ways: DataFrame) -> DataFrame:
    """(node, o, i, next, prev): ways out and in, and one of each."""
    none = F.lit(None).cast(ways.schema["source"].dataType)
    a = ways.select(F.col("source").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i"), F.col("target").alias("next"), none.alias("prev"))
    b = ways.select(F.col("target").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i"), none.alias("next"), F.col("source").alias("prev"))
    return a.unionByName(b).groupBy("node").agg(F.sum("o").alias("o"), F.sum("i").alias("i"), F.max("next").alias("next"), F.max("prev").alias("prev"))


def _strands(through: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """(node, head, tail) of strands of n nodes with one way in and one out, and (node, rep) of whole rings of them."""
    own = through.select("node")
    rows = through.join(own.select(F.col("node").alias("next"), F.lit(True).alias("on")), "next", "left").join(own.select(F.col("node").alias("prev"), F.lit(True).alias("back")), "prev", "left")
    rows = cut(rows.select("node", "next", "prev", F.coalesce("on", F.lit(False)).alias("on"), F.coalesce("back", F.lit(False)).alias("back")))
    step = rows.select("node", F.when(F.col("on"), F.col("next")).otherwise(F.col("node")).alias("last"), F.col("node").alias("low"), F.col("on").alias("open"))
    reach = 1
    while True:
        ahead = step.select(F.col("node").alias("last"), F.col("last").alias("_last"), F.col("low").alias("_low"), F.col("open").alias("_open"))
        step = cut(step.join(ahead, "last").select("node", F.col("_last").alias("last"), F.least("low", "_low").alias("low"), F.col("_open").alias("open")))
        if reach >= n or not step.where("open").count():
            break
        reach *= 2
    tails = rows.where("not on").select(F.col("node").alias("last"), F.col("next").alias("tail"))
    heads = step.join(rows.where("not back").select("node", F.col("prev").alias("head")), "node").select("last", "head")
    strands = step.where("not open").select("node", "last").join(tails.join(heads, "last"), "last").select("node", "head", "tail")
    return cut(strands), cut(step.where("open").select("node", F.col("low").alias("rep")))


def _without(ways: DataFrame, gone: DataFrame) -> DataFrame:
    return ways.join(gone.select(F.col("node").alias("source")), "source", "left_anti").join(gone.select(F.col("node").alias("target")), "target", "left_anti").select("source", "target")


def _coloured(ways: DataFrame) -> DataFrame:
    """(node, rep) of at least one strongly connected component, singletons included: the smallest node that reaches a node colours it,
    and what reaches the node of its own colour is that one's component."""
    colour = cut(ways.select(F.explode(F.array("source", "target")).alias("node")).distinct().withColumn("c", F.col("node")))
    while True:
        least = ways.join(colour.select(F.col("node").alias("source"), "c"), "source").groupBy(F.col("target").alias("node")).agg(F.min("c").alias("least"))
        new = cut(colour.join(least, "node", "left").select("node", F.least("c", F.coalesce("least", "c")).alias("c"), (F.col("least") < F.col("c")).alias("moved")))
        colour = new.drop("moved")
        if not new.where("moved").count():
            break
    inside = ways.join(colour.select(F.col("node").alias("source"), F.col("c").alias("c")), "source").join(colour.select(F.col("node").alias("target"), F.col("c").alias("d")), "target").where("c = d").select("source", "target", "c")
    inside = cut(inside)
    found = front = cut(colour.where("node = c"))
    while True:
        front = cut(inside.join(front.select(F.col("node").alias("target")), "target", "left_semi").select(F.col("source").alias("node"), "c").distinct().join(found.select("node"), "node", "left_anti"))
        if front.isEmpty():
            return found.select("node", F.col("c").alias("rep"))
        found = cut(found.unionByName(front))


def components(edges: DataFrame) -> DataFrame:
    """(node, component, size) of nodes that reach themselves through edges(source, target); a component is named by its smallest node.

    Nodes without a way in or out go, strands of nodes with one way in and one out become one edge each and rings of them are
    components; the rest is coloured forward and searched backward. A strand belongs to the component of its two ends, if they share one."""
    ways = cut(edges.where("source is not null and target is not null").select("source", "target").distinct())
    loops = ways.where("source = target").select(F.col("source").alias("node"))
    none = loops.limit(0).select("node", F.col("node").alias("rep"))
    found, levels = none, []
    ways = ways.where("source <> target")
    while True:
        ends = cut(_ends(ways))
        total, loose, through = ends.agg(F.count(F.lit(1)), F.count_if(F.expr("o = 0 or i = 0")), F.count_if(F.expr("o = 1 and i = 1"))).first()
        if not total:
            break
        if loose or through:
            if through:
                strands, rings = _strands(ends.where("o = 1 and i = 1"), through)
                found = found.unionByName(rings)
                levels.append(strands)
                bridges = strands.where("head <> tail").select(F.col("head").alias("source"), F.col("tail").alias("target")).distinct()
                ways = _without(ways, ends.where("o = 1 and i = 1")).unionByName(bridges).distinct()
            ways = cut(_without(ways, ends.where("o = 0 or i = 0")))
        else:
            new = cut(_coloured(ways))
            found = found.unionByName(new)
            ways = cut(_without(ways, new))
    for strands in reversed(levels):
        reps = lambda c, r: found.select(F.col("node").alias(c), F.col("rep").alias(r))  # noqa: E731, B023
        ended = strands.join(reps("head", "h"), "head", "left").join(reps("tail", "t"), "tail", "left")
        inside = cut(ended.where(F.coalesce("h", "head") == F.coalesce("t", "tail")))
        own = inside.where("h is null").select(F.col("head").alias("node"), F.col("head").alias("rep")).distinct()
        found = cut(found.unionByName(own).unionByName(inside.select("node", F.coalesce("h", "head").alias("rep"))))
    alone = loops.join(found.select("node"), "node", "left_anti").select("node", F.col("node").alias("rep"))
    members = cut(found.unionByName(alone).join(loops.withColumn("loop", F.lit(1)), "node", "left"))
    named = members.groupBy("rep").agg(F.min("node").alias("component"), F.count(F.lit(1)).alias("size"), F.max("loop").alias("loop")).where("size > 1 or loop = 1")
    return members.select("node", "rep").join(named, "rep").select("node", "component", "size")


def on_cycle(edges: DataFrame) -> DataFrame:
    """Nodes that wait for themselves through edges(source, target), however long the way."""
    return components(edges).select("node")
