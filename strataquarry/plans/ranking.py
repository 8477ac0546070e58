"""Ranking queries: percentiles, tiers, weighted scores, diversity, quotas."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as T
from ..operators import history, rank
from .tables import Catalogue, Tables

Q = Catalogue()


def _at(f: str, n: str = "n") -> str:
    return f"greatest(0, least({n} - 1, round_even({f} * ({n} - 1), 0)))::BIGINT + 1"


@Q.add("WITH r AS (SELECT l_returnflag, l_quantity AS v, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) AS i, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem) SELECT l_returnflag, max(n) AS n, " + ", ".join(f"max(v) FILTER (WHERE i = {_at(f)}) AS {c}" for c, f in (("min", "0.0"), ("p33", "0.33"), ("median", "0.5"), ("p67", "0.67"), ("p90", "0.9"), ("max", "1.0"))) + " FROM r GROUP BY 1")
def q28_nearest_rank(t: Tables):
    return rank.distribution(t.lineitem, ["l_returnflag"], "l_quantity")


@Q.add(f"WITH r AS (SELECT p_brand, p_retailprice AS v, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice) AS i, count(*) OVER (PARTITION BY p_brand) AS n FROM part) SELECT p_brand, CASE WHEN max(n) < 3 THEN min(v) ELSE max(v) FILTER (WHERE i = {_at('(1.0::DOUBLE / 3)')}) END AS low, CASE WHEN max(n) < 3 THEN max(v) ELSE max(v) FILTER (WHERE i = {_at('(2.0::DOUBLE / 3)')}) END AS high FROM r GROUP BY 1")
def q29_tercile_cuts(t: Tables):
    return rank.terciles(t.part, ["p_brand"], "p_retailprice")


SUPPLIER = "SELECT s_suppkey, s_nationkey, s_acctbal, count(DISTINCT l_orderkey) AS a, count(DISTINCT l_partkey) AS b, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS c, count(DISTINCT l_linenumber) AS d, sum(l_quantity) AS e FROM supplier JOIN lineitem ON l_suppkey = s_suppkey GROUP BY ALL"


def _suppliers(t: Tables):
    # several distinct counts in one aggregate would multiply the rows before the shuffle; orders are a level of their own instead
    once = t.lineitem.groupBy("l_suppkey", "l_orderkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("c"), F.bit_or(F.expr("shiftleft(1L, l_linenumber)")).alias("d"), F.sum("l_quantity").alias("e"))
    per = once.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("a"), F.sum("c").alias("c"), F.bit_count(F.bit_or("d")).cast("long").alias("d"), F.sum("e").alias("e"))
    parts = t.lineitem.select("l_suppkey", "l_partkey").distinct().groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("b"))
    per = per.join(parts, "l_suppkey").select("l_suppkey", "a", "b", "c", "d", "e")
    return t.supplier.join(per, F.col("s_suppkey") == F.col("l_suppkey"))


def _norm(c: str) -> str:
    return f"CASE WHEN max({c}) OVER () <= min({c}) OVER () THEN 1.0 ELSE ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) END"


@Q.add(f"WITH s AS ({SUPPLIER}), z AS (SELECT s_suppkey, round({_norm('a')} * 0.35 + {_norm('b')} * 0.15 + {_norm('c')} * 0.10 + {_norm('d')} * 0.10 + {_norm('e')} * 0.10 + {_norm('s_acctbal')} * 0.20, 9) AS score FROM s) SELECT s_suppkey, score, row_number() OVER (ORDER BY score DESC, s_suppkey) AS rank FROM z")
def q30_weighted_rank(t: Tables):
    weights = dict(zip(("a", "b", "c", "d", "e", "s_acctbal"), rank.HISTORY_WEIGHTS.values(), strict=True))
    return rank.weighted_rank(_suppliers(t), [], weights, "s_suppkey", digits=9).select("s_suppkey", "score", "rank")


@Q.add("SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN 0 ELSE year(o_orderdate) * 372 + month(o_orderdate) * 31 + day(o_orderdate) END AS ordinal FROM orders")
def q31_date_ordinal(t: Tables):
    stamp = F.when(F.col("o_orderkey") % 97 == 0, "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return t.orders.select("o_orderkey", T.merged_ordinal(stamp).cast("long").alias("ordinal"))


@Q.add("SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand")
def q32_group_order(t: Tables):
    return t.part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "p_brand")


@Q.add("SELECT l_orderkey, l_partkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey DESC) AS r FROM lineitem) WHERE r = 1")
def q34_argmax_struct(t: Tables):
    return t.lineitem.groupBy("l_orderkey").agg(F.max(F.struct("l_extendedprice", "l_partkey")).alias("m")).select("l_orderkey", "m.l_partkey", "m.l_extendedprice")


@Q.add("SELECT CASE WHEN c_acctbal <= 1000 THEN 'easy' WHEN c_acctbal <= 6000 THEN 'medium' ELSE 'hard' END AS tier, count(*) AS n FROM customer GROUP BY 1")
def q35_tier_values(t: Tables):
    return t.customer.groupBy(N.tier_of(F.col("c_acctbal"), F.lit(1000), F.lit(6000)).alias("tier")).agg(F.count(F.lit(1)).alias("n"))


@Q.add("SELECT c_custkey, least(2, (row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) - 1) * 3 // count(*) OVER (PARTITION BY c_mktsegment))::INT AS tier FROM customer")
def q36_equal_thirds(t: Tables):
    return N.equal_thirds(t.customer, ["c_mktsegment"], [F.col("c_acctbal"), F.col("c_custkey")]).select("c_custkey", "tier")


@Q.add(f"""WITH s AS ({SUPPLIER}), z AS (SELECT s_suppkey, {_norm('a')} AS n1, {_norm('b')} AS n2, {_norm('c')} AS n3, {_norm('e')} AS n4, {_norm('s_acctbal')} AS n5 FROM s), r AS (SELECT *, (n1 + n2 + n3 + n4 + n5) / 5 AS m FROM z)
SELECT s_suppkey, round(m, 6) AS composite, (['easy', 'medium', 'hard'])[least(2, (row_number() OVER (ORDER BY m, s_suppkey) - 1) * 3 // count(*) OVER ()) + 1] AS tier, (SELECT string_agg(f, ',' ORDER BY v DESC, i) FROM (SELECT f, v, i FROM (VALUES ('a', n1, 1), ('b', n2, 2), ('c', n3, 3), ('e', n4, 4), ('s_acctbal', n5, 5)) AS q(f, v, i) ORDER BY v DESC, i LIMIT 2)) AS dominant FROM r""")
def q37_difficulty_mean(t: Tables):
    rows = rank.difficulty(_suppliers(t), [], ("a", "b", "c", "e", "s_acctbal"), "s_suppkey")
    return rows.select("s_suppkey", F.round("composite", 6).alias("composite"), "tier", F.array_join("dominant", ",").alias("dominant"))


@Q.add("WITH b AS (SELECT p_partkey, split_part(p_name, ' ', 2) AS bare FROM part) SELECT p_partkey, count(*) OVER (PARTITION BY bare) - 1 AS lookalikes FROM b")
def q38_lookalikes(t: Tables):
    named = F.replace("p_name", F.lit(" "), F.lit("."))
    return rank.lookalikes(t.part.select(named.alias("id")), t.part.select(F.col("p_partkey").alias("task_id"), named.alias("subject"))).select(F.col("task_id").alias("p_partkey"), "lookalikes")


@Q.add("""WITH g AS (SELECT s_suppkey, s_nationkey, s_acctbal / 10000 AS score, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey DESC) AS place FROM supplier), a AS (SELECT *, score - 0.35 * (place - 1) AS adjusted FROM g), r AS (SELECT *, row_number() OVER (ORDER BY adjusted DESC, s_suppkey DESC) AS rank FROM a)
SELECT s_suppkey, s_nationkey, round(adjusted, 6) AS adjusted, rank FROM r WHERE rank <= 10""")
def q40_diversity_greedy(t: Tables):
    rows = t.supplier.withColumn("score", F.col("s_acctbal") / 10000)
    return rank.diverse_top(rows, [], "s_nationkey", "score", "s_suppkey", 10).select("s_suppkey", "s_nationkey", F.round("adjusted", 6).alias("adjusted"), F.col("rank").cast("long").alias("rank"))


def _pool(t: Tables):
    source = F.element_at(F.array(F.lit("history"), F.lit("excision"), F.lit("net_new")), (F.col("s_suppkey") % 3 + 1).cast("int"))
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_regionkey").alias("region"), F.format_string("s%09d", "s_suppkey").alias("task_id"), source.alias("source"), F.col("n_name").alias("group"), (F.col("s_acctbal") / 10000).alias("score"))


@Q.add("""WITH RECURSIVE p AS (SELECT n_regionkey AS region, 's' || lpad(s_suppkey::VARCHAR, 9, '0') AS task_id, (['history', 'excision', 'net_new'])[s_suppkey % 3 + 1] AS source, n_name AS g, s_acctbal / 10000 AS score FROM supplier JOIN nation ON s_nationkey = n_nationkey), h AS (SELECT region, least(4, count(*) FILTER (WHERE source = 'history')) AS floor FROM p GROUP BY 1),
s(region, n, ids, gs, sources) AS (SELECT region, 0, []::VARCHAR[], []::VARCHAR[], []::VARCHAR[] FROM h UNION ALL
SELECT region, n + 1, list_append(ids, b.task_id), list_append(gs, b.g), list_append(sources, b.source) FROM (SELECT s.region, s.n, s.ids, s.gs, s.sources, max_by({'task_id': p.task_id, 'g': p.g, 'source': p.source}, {'v': p.score - 0.35::DOUBLE * len(list_filter(s.gs, lambda x : x = p.g)), 'id': p.task_id}) AS b
FROM s JOIN h ON h.region = s.region JOIN p ON p.region = s.region WHERE s.n < 10 AND NOT list_contains(s.ids, p.task_id) AND len(list_filter(s.sources, lambda x : x = p.source)) < CASE p.source WHEN 'excision' THEN 4 WHEN 'net_new' THEN 3 ELSE 10 END AND (p.source = 'history' OR len(list_filter(s.sources, lambda x : x = 'history')) >= h.floor) GROUP BY s.region, s.n, s.ids, s.gs, s.sources) AS k),
f AS (SELECT region, max_by(ids, n) AS ids FROM s GROUP BY 1) SELECT f.region, ids[i] AS task_id, i - 1 AS position, CASE WHEN i <= h.floor THEN 'minimum_history' ELSE 'ranked' END AS reason FROM f JOIN h USING (region), LATERAL (SELECT unnest(range(1, len(ids) + 1)) AS i) AS l""")
def q41_quota_greedy(t: Tables):
    return rank.select_quota(_pool(t), ["region"]).select("region", "task_id", F.col("position").cast("long").alias("position"), "reason")


@Q.add("""WITH p AS (SELECT n_regionkey AS region, s_suppkey % 4 AS part, (['history', 'excision', 'net_new'])[s_suppkey % 3 + 1] AS source, n_name AS g FROM supplier JOIN nation ON s_nationkey = n_nationkey), s AS (SELECT region, part, count(*) AS n, count(DISTINCT g) AS g, count(*) FILTER (WHERE source = 'history') AS h, count(*) FILTER (WHERE source = 'excision') AS e, count(*) FILTER (WHERE source = 'net_new') AS w FROM p GROUP BY ALL)
SELECT region, part, 'total' AS rule, n AS have, 10::BIGINT AS need FROM s WHERE n < 10 UNION ALL SELECT region, part, 'modules', g, 4 FROM s WHERE g < 4 UNION ALL SELECT region, part, 'minimum_history', h, 4 FROM s WHERE h < 4 UNION ALL SELECT region, part, 'maximum_excision', e, 4 FROM s WHERE e > 4 UNION ALL SELECT region, part, 'maximum_net_new', w, 3 FROM s WHERE w > 3""")
def q42_shortfalls(t: Tables):
    return rank.shortfalls(_pool(t).withColumn("part", F.substring("task_id", 2, 9).cast("long") % 4), ["region", "part"])


@Q.add("""WITH r AS (SELECT *, event_type = 'purchase' AND value > 60 AS ok FROM events), n AS (SELECT *, CASE WHEN ok AND row_number() OVER (PARTITION BY user_id % 10, user_id ORDER BY (NOT ok)::INT, event_id) = 1 THEN 1 ELSE 0 END AS fresh FROM r), w AS (SELECT user_id % 10 AS pool, event_id, (count(*) FILTER (WHERE ok) OVER o >= 5 AND sum(fresh) OVER o >= 3)::INT AS done FROM n WINDOW o AS (PARTITION BY user_id % 10 ORDER BY event_id ROWS UNBOUNDED PRECEDING)), p AS (SELECT *, sum(done) OVER (PARTITION BY pool ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS past FROM w)
SELECT pool, count(*) AS validated, max(event_id) AS last FROM p WHERE past = 0 OR (past = 1 AND done = 1) GROUP BY 1""")
def q76_until_enough(t: Tables):
    ok = (F.col("event_type") == "purchase") & (F.col("value") > 60)
    rows = rank.until_enough(t.events.withColumn("pool", F.col("user_id") % 10), ["pool"], [F.col("event_id")], ok, "user_id", 5, 3)
    return rows.groupBy("pool").agg(F.count(F.lit(1)).alias("validated"), F.max("event_id").alias("last"))
