"""Relational queries: views, bridges, links, chains, layers, set comparison, range attribution."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import coverage, graph, history
from ..sources import sinks
from .tables import Catalogue, Tables

Q = Catalogue()


@Q.add("SELECT count(*) FILTER (WHERE l_returnflag = 'A') AS returned, count(*) FILTER (WHERE l_linestatus = 'O') AS open_lines, count(*) FILTER (WHERE l_quantity > 25) AS large, count(*) AS n FROM lineitem")
def q01_conditional_counts(t: Tables):
    c = F.col
    return graph.conditional_counts(t.lineitem, [], {"returned": c("l_returnflag") == "A", "open_lines": c("l_linestatus") == "O", "large": c("l_quantity") > 25, "n": F.lit(True)})


@Q.add("SELECT DISTINCT c_mktsegment, o_orderpriority FROM customer JOIN orders ON c_custkey = o_custkey")
def q02_distinct_bridge(t: Tables):
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey")).select("c_mktsegment", "o_orderpriority").distinct()


@Q.add("SELECT o_orderpriority, count(DISTINCT c_custkey) AS customers FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1 ORDER BY customers DESC, o_orderpriority")
def q03_bridge_matrix(t: Tables):
    bridge = t.orders.select("o_custkey", "o_orderpriority").distinct().join(t.customer.select("c_custkey"), F.col("c_custkey") == F.col("o_custkey"))
    return bridge.groupBy("o_orderpriority").agg(F.count_distinct("c_custkey").alias("customers")).orderBy(F.desc("customers"), "o_orderpriority")


@Q.add("SELECT DISTINCT a.o_custkey FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey WHERE a.o_orderpriority = '1-URGENT' AND b.o_orderpriority = '5-LOW'")
def q04_shared_members(t: Tables):
    return graph.shared_members(t.orders, "o_custkey", "o_orderpriority", "1-URGENT", "5-LOW")


@Q.add("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_partkey = 7 AND l_returnflag <> 'N' ORDER BY l_orderkey, l_linenumber")
def q05_filtered_lookup(t: Tables):
    return t.lineitem.where("l_partkey = 7 and l_returnflag <> 'N'").select("l_orderkey", "l_linenumber", "l_quantity").orderBy("l_orderkey", "l_linenumber")


@Q.add("SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 1) GROUP BY 1")
def q06_semi_known(t: Tables):
    known = t.supplier.join(t.nation.where("n_regionkey = 1"), F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
    return graph.known_only(t.lineitem, "l_suppkey", known, "s_suppkey").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@Q.add("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def q07_upsert_last_wins(t: Tables):
    return sinks.last_wins(t.events.select("user_id", "event_type", "event_id", "value", "ts"), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@Q.add("SELECT min(doc_id) AS doc_id FROM documents GROUP BY text")
def q08_insert_ignore(t: Tables):
    rows = t.documents.select("doc_id", F.sha2("text", 256).alias("text_sha"))
    return sinks.first_wins(rows, ["text_sha"], ["doc_id"]).select("doc_id")


@Q.add("SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'customers_ordering', count(DISTINCT o_custkey) FROM orders UNION ALL SELECT 'users', count(DISTINCT user_id) FROM events")
def q09_table_counts(t: Tables):
    count = lambda df, name, e: df.agg(e.alias("n")).select(F.lit(name).alias("name"), "n")
    return count(t.orders, "orders", F.count(F.lit(1))).unionByName(count(t.lineitem, "lineitem", F.count(F.lit(1)))).unionByName(count(t.orders, "customers_ordering", F.count_distinct("o_custkey"))).unionByName(count(t.events, "users", F.count_distinct("user_id")))


@Q.add("""WITH e AS (SELECT event_id, user_id AS custkey FROM events JOIN customer ON user_id = c_custkey), s AS (SELECT event_id, CAST(regexp_extract(props, ': ([0-9]+)', 1) AS BIGINT) AS custkey FROM events WHERE regexp_extract(props, ': ([0-9]+)', 1) <> '')
SELECT custkey, method, count(*) AS n FROM (SELECT event_id, custkey, 'exact' AS method FROM e UNION ALL SELECT s.event_id, s.custkey, 'message' FROM s JOIN customer ON c_custkey = s.custkey WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.event_id = s.event_id AND e.custkey = s.custkey)) GROUP BY 1, 2""")
def q10_link_two_methods(t: Tables):
    known = t.customer.select(F.col("c_custkey").alias("custkey"))
    exact = t.events.select("event_id", F.col("user_id").alias("custkey")).join(known, "custkey", "left_semi").select("event_id", "custkey", F.lit("exact").alias("method"))
    said = t.events.select("event_id", F.regexp_extract("props", ": ([0-9]+)", 1).try_cast("long").alias("custkey")).where("custkey is not null")
    said = said.join(known, "custkey", "left_semi").select("event_id", "custkey", F.lit("message").alias("method"))
    return history.with_precedence(exact, said, ["event_id", "custkey"]).groupBy("custkey", "method").agg(F.count(F.lit(1)).alias("n"))


@Q.add("SELECT l_orderkey, round(sum(CASE WHEN l_returnflag <> 'N' THEN l_quantity END), 2) AS additions, round(sum(l_extendedprice), 2) AS deletions, count(*) AS files, count(*) > 1 AS is_merge FROM lineitem GROUP BY 1")
def q11_explode_sum(t: Tables):
    change = F.struct(F.col("l_linenumber").cast("string").alias("path"), F.when(F.col("l_returnflag") != "N", F.col("l_quantity")).alias("additions"), F.col("l_extendedprice").alias("deletions"))
    commits = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(change).alias("changed_files"), F.collect_list(F.col("l_linenumber").cast("string")).alias("parent_shas"))
    out = history.numstat_sums(commits.withColumnRenamed("l_orderkey", "sha"))
    return out.select(F.col("sha").alias("l_orderkey"), F.round("additions", 2).alias("additions"), F.round("deletions", 2).alias("deletions"), "files", "is_merge")


@Q.add("WITH RECURSIVE w(k, wave) AS (SELECT p_partkey, 0 FROM part WHERE p_partkey <= 1 UNION ALL SELECT p_partkey, wave + 1 FROM part JOIN w ON p_partkey // 2 = w.k AND p_partkey > 1) SELECT k AS node, max(wave) AS wave FROM w GROUP BY 1")
def q16_layer_waves(t: Tables):
    return graph.waves(t.part.select(F.col("p_partkey").alias("node")), t.part.where("p_partkey > 1").select(F.col("p_partkey").alias("source"), F.expr("p_partkey div 2").alias("target")))


@Q.add("""WITH r AS (SELECT l_partkey, 'order:' || l_orderkey AS caller, l_orderkey || ':' || l_linenumber AS anchor FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size = 1), n AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY anchor) AS rank, count(*) OVER (PARTITION BY l_partkey) AS total FROM r)
SELECT 'part:' || l_partkey AS target_path, caller, anchor, rank, total, total > 8 AS truncated FROM n WHERE rank <= 8""")
def q17_top8_impact(t: Tables):
    part = lambda c: F.concat(F.lit("part:"), c)
    order = F.concat(F.lit("order:"), "l_orderkey")
    edges = t.lineitem.select(F.lit("calls").alias("kind"), order.alias("source"), part("l_partkey").alias("target"), F.col("l_orderkey").cast("string").alias("path"), F.col("l_linenumber").alias("line"), F.lit("").alias("expression"))
    symbols = t.part.select(part("p_partkey").alias("id"), part("p_partkey").alias("path")).unionByName(t.orders.select(F.concat(F.lit("order:"), "o_orderkey").alias("id"), F.concat(F.lit("order:"), "o_orderkey").alias("path")))
    changed = t.part.where("p_size = 1").select(part("p_partkey").alias("path"))
    return graph.impact(edges, symbols, changed).select("target_path", "caller", "anchor", F.col("rank").cast("long").alias("rank"), "total", "truncated")


@Q.add("""WITH a AS (SELECT DISTINCT l_orderkey, l_linenumber AS n FROM lineitem), b AS (SELECT DISTINCT l_orderkey, CASE WHEN l_quantity = 50 THEN l_linenumber + 10 ELSE l_linenumber END AS n FROM lineitem WHERE l_discount < 0.1), f AS (SELECT a.n AS an, b.n AS bn FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey AND a.n = b.n)
SELECT count(*) FILTER (WHERE an = bn) AS matched, count(*) FILTER (WHERE bn IS NULL) AS only_left, count(*) FILTER (WHERE an IS NULL) AS only_right, round(count(*) FILTER (WHERE an = bn) / count(*), 6) AS rate FROM f""")
def q18_match_rate(t: Tables):
    left = t.lineitem.select("l_orderkey", F.col("l_linenumber").alias("n"))
    right = t.lineitem.where("l_discount < 0.1").select("l_orderkey", F.when(F.col("l_quantity") == 50, F.col("l_linenumber") + 10).otherwise(F.col("l_linenumber")).alias("n"))
    return graph.match_rate(left, right, ["l_orderkey", "n"]).withColumn("rate", F.round("rate", 6))


BANDS = "(VALUES ('all', 0, 2000, 0), ('low', 900, 950, 1), ('high', 950, 999, 2), ('core', 930, 970, 3), ('inner', 940, 945, 4)) AS b(band, lo, hi, ordinal)"


def _bands(t: Tables):
    return t.spark.sql(f"SELECT 1 AS k, * FROM {BANDS}")


@Q.add(f"SELECT p_partkey, band FROM (SELECT p_partkey, band, row_number() OVER (PARTITION BY p_partkey ORDER BY hi - lo, ordinal DESC) AS r FROM part JOIN {BANDS} ON floor(p_retailprice) BETWEEN lo AND hi) WHERE r = 1")
def q19_innermost_interval(t: Tables):
    lines = t.part.select(F.lit(1).alias("k"), "p_partkey", F.floor("p_retailprice").alias("line"))
    return coverage.innermost(lines, _bands(t), ["k"], low="lo", high="hi", order=["ordinal"]).select("p_partkey", F.col("span.band").alias("band"))


@Q.add("SELECT regexp_replace(trim(split_part(lang || '.' || source || '|run', '|', 1)), '^(.*)\\.([^.]*)$', '\\1::\\2') AS node, count(*) AS n FROM documents GROUP BY 1")
def q20_context_to_node(t: Tables):
    from ..functions.text import context_to_node

    return t.documents.groupBy(context_to_node(F.concat("lang", F.lit("."), "source", F.lit("|run"))).alias("node")).agg(F.count(F.lit(1)).alias("n"))


@Q.add(f"SELECT band, count(*) AS lines, count(DISTINCT l_suppkey) AS tests FROM lineitem JOIN (SELECT p_partkey, band, row_number() OVER (PARTITION BY p_partkey ORDER BY hi - lo, ordinal DESC) AS r FROM part JOIN {BANDS} ON floor(p_retailprice) BETWEEN lo AND hi) ON p_partkey = l_partkey AND r = 1 GROUP BY 1")
def q21_attributed_coverage(t: Tables):
    lines = t.part.select(F.lit(1).alias("k"), "p_partkey", F.floor("p_retailprice").alias("line"))
    owner = coverage.innermost(lines, _bands(t), ["k"], low="lo", high="hi", order=["ordinal"]).select("p_partkey", F.col("span.band").alias("band"))
    return t.lineitem.join(owner, F.col("l_partkey") == F.col("p_partkey")).groupBy("band").agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("l_suppkey").alias("tests"))


@Q.add("WITH c AS (SELECT greatest(3, round_even(0.15 * count(DISTINCT l_suppkey), 0))::BIGINT AS ceiling FROM lineitem) SELECT s_suppkey, ceiling, s_nationkey > ceiling AS above FROM supplier, c")
def q22_scaled_ceiling(t: Tables):
    from ..functions.numeric import ceiling_of

    total = t.lineitem.agg(F.count_distinct("l_suppkey").alias("n")).select(ceiling_of(F.col("n")).cast("long").alias("ceiling"))
    return t.supplier.crossJoin(F.broadcast(total)).select("s_suppkey", "ceiling", (F.col("s_nationkey") > F.col("ceiling")).alias("above"))


COVERED = "SELECT p_partkey, p_size AS body, count(DISTINCT l_orderkey) AS tests, count(DISTINCT l_linenumber) AS covered, p_type AS kind, p_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5') AS is_test, p_name LIKE '%ring' OR p_name LIKE '%bolt' AS doc FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY ALL"


def _covered(t: Tables):
    per = t.lineitem.groupBy("l_partkey").agg(F.count_distinct("l_orderkey").alias("tests"), F.count_distinct("l_linenumber").alias("covered"))
    rows = t.part.join(per, F.col("p_partkey") == F.col("l_partkey"), "left")
    kind = F.when(F.col("p_type") == "ECONOMY", "function").when(F.col("p_type") == "SMALL", "method").otherwise("class")
    from ..functions.numeric import coverage_ratio

    rows = rows.select("p_partkey", F.col("p_size").alias("body_lines"), F.coalesce("tests", F.lit(0)).alias("tests"), F.coalesce("covered", F.lit(0)).alias("covered"), kind.alias("kind"), F.col("p_brand").isin(*(f"Brand#{i}" for i in range(1, 6))).alias("is_test"), (F.col("p_name").endswith("ring") | F.col("p_name").endswith("bolt")).alias("has_docstring"), F.lit(30).alias("ceiling"))
    return coverage.band(rows.withColumn("ratio", coverage_ratio(F.col("covered"), F.col("body_lines"))))


FOCUS = f"""SELECT *, kind IN ('ECONOMY', 'SMALL') AND tests > 0 AND NOT is_test AS possible, least(1.0, covered / body) AS ratio FROM ({COVERED})"""


@Q.add(f"SELECT count(*) FILTER (WHERE possible) AS possible, count(*) FILTER (WHERE possible AND tests BETWEEN 2 AND 30 AND doc AND ratio >= 0.6 AND body >= 4) AS ready, count(*) AS n FROM ({FOCUS})")
def q24_ready_band(t: Tables):
    return _covered(t).agg(F.count_if("possible").alias("possible"), F.count_if("ready").alias("ready"), F.count(F.lit(1)).alias("n"))


@Q.add("SELECT l_suppkey, count(DISTINCT l_partkey) AS n, string_agg(DISTINCT l_partkey::VARCHAR, ',' ORDER BY l_partkey::VARCHAR) AS parts FROM lineitem GROUP BY 1")
def q25_inverted_index(t: Tables):
    index = coverage.tests_index(t.lineitem.select(F.col("l_suppkey").alias("test_id"), F.col("l_partkey").cast("string").alias("symbol_id")).distinct())
    return index.select(F.col("test_id").alias("l_suppkey"), F.size("symbols").cast("long").alias("n"), F.array_join("symbols", ",").alias("parts"))


REASON = "CASE WHEN tests = 0 THEN 'no_covering_test' WHEN is_test THEN 'is_itself_a_test' WHEN kind NOT IN ('ECONOMY', 'SMALL') THEN 'not_a_callable' END"


@Q.add(f"WITH r AS (SELECT {REASON} AS reason FROM ({COVERED})) SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM r GROUP BY 1 UNION ALL SELECT 'considered', count(*) FROM r")
def q26_funnel_reasons(t: Tables):
    totals, drops, _ = history.funnel(_covered(t).withColumn("reason", coverage.excision_reason()), "p_partkey")
    rows = totals.select(F.explode(F.create_map(F.lit("considered"), "considered", F.lit("kept"), "kept")).alias("reason", "n"))
    return rows.unionByName(drops.withColumnRenamed("dropped", "n"))


@Q.add(f"SELECT {REASON} AS reason, p_partkey FROM ({COVERED}) WHERE reason IS NOT NULL")
def q27_funnel_items(t: Tables):
    return history.funnel(_covered(t).withColumn("reason", coverage.excision_reason()), "p_partkey")[2]


@Q.add("WITH e AS (SELECT user_id AS source, (user_id + 1) % 150 AS target FROM events) SELECT count(*) AS n, count(DISTINCT (source, target)) AS pairs FROM e")
def q43_edge_bag_and_set(t: Tables):
    e = t.events.select(F.col("user_id").alias("source"), ((F.col("user_id") + 1) % 150).alias("target"))
    return e.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("source", "target").alias("pairs"))
