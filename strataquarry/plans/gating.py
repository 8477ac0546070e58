"""Gate queries: comparing runs, determinism, roll-ups, bridges to reports, usage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numeric as N
from ..operators import dependencies, gates, texts
from ..sources import manifests, reports
from .tables import Catalogue, Tables

Q = Catalogue()

# Two runs out of events: before and after mid-January, one case a user and event type.
RUNS = """r AS (SELECT user_id, event_type AS test_id, ts < TIMESTAMP '2024-01-16' AS early, avg(value) AS v, count(*) AS n FROM events GROUP BY ALL),
k AS (SELECT user_id, test_id, early, CASE WHEN v > 40 THEN 'passed' ELSE 'failed' END AS status, CASE WHEN v > 40 THEN 'passed' WHEN n = 1 THEN 'infrastructure' WHEN v > 25 THEN 'assertion' ELSE 'behavioral_exception' END AS failure_class FROM r WHERE n > 1 OR v > 15),
b AS (SELECT * FROM k WHERE early), a AS (SELECT * FROM k WHERE NOT early)"""


def _runs(t: Tables):
    early = F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-16 00:00:00"))
    r = t.events.groupBy("user_id", F.col("event_type").alias("test_id"), early.alias("early")).agg(N.mean_in_order(F.col("value"), F.col("event_id")).alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1 or v > 15")
    v, n = F.col("v"), F.col("n")
    klass = F.when(v > 40, "passed").when(n == 1, "infrastructure").when(v > 25, "assertion").otherwise("behavioral_exception")
    k = r.select("user_id", "test_id", "early", F.when(v > 40, "passed").otherwise("failed").alias("status"), klass.alias("failure_class"), F.lit(True).alias("collected"))
    return k.where("early").drop("early"), k.where("not early").drop("early")


@Q.add("""SELECT user_id, CASE WHEN event_type = 'signup' THEN 'n' || event_id ELSE 't.c' || user_id || '::n' || event_id END AS test_id, CASE event_type WHEN 'view' THEN 'passed' WHEN 'click' THEN 'skipped' ELSE 'failed' END AS status, CASE event_type WHEN 'view' THEN 'passed' WHEN 'click' THEN 'skipped' WHEN 'signup' THEN 'infrastructure' WHEN 'purchase' THEN 'assertion' ELSE CASE WHEN value > 40 THEN 'behavioral_exception' ELSE 'infrastructure' END END AS failure_class,
CASE event_type WHEN 'view' THEN '' WHEN 'click' THEN '' WHEN 'signup' THEN 'ImportError: m' WHEN 'purchase' THEN 'assert 1 == ' || user_id ELSE 'KeyError: ''x'' at line N' END AS signature, event_type <> 'signup' AS collected FROM events""")
def q44_junit_rows(t: Tables):
    """One report a user, one case an event: passed, skipped, asserting, failing in the repository or elsewhere, or not collected."""
    e, u, name = F.col("event_type"), F.col("user_id").cast("string"), F.concat(F.lit(' name="n'), F.col("event_id").cast("string"), F.lit('"'))
    case = F.concat(F.lit('<testcase classname="'), F.when(e == "signup", "").otherwise(F.concat(F.lit("t.c"), u)), F.lit('"'), name)
    frame = F.when(F.col("value") > 40, "pkg/core.py:3: in run").otherwise("/usr/lib/python3/x.py:9: in f")
    body = F.when(e == "view", "/>").when(e == "click", '><skipped message="later"/></testcase>').when(e == "signup", '><error message="ImportError: m">trace</error></testcase>')
    body = body.when(e == "purchase", F.concat(F.lit('><failure message="assert 1 == '), u, F.lit('">E   assert 1 == '), u, F.lit("</failure></testcase>"))).otherwise(F.concat(F.lit("><failure message=\"KeyError: 'x' at line 7\">"), frame, F.lit("</failure></testcase>")))
    xml = F.concat(F.lit("<testsuite>"), F.array_join(F.collect_list(F.concat(case, body)), "\n"), F.lit("</testsuite>"))
    return reports.junit_cases(t.events.groupBy("user_id").agg(xml.alias("xml")).withColumnRenamed("user_id", "run")).withColumnRenamed("run", "user_id")


@Q.add("""WITH m AS (SELECT user_id, CASE event_type WHEN 'error' THEN 'ImportError: no module' WHEN 'view' THEN 'assert x == y' WHEN 'click' THEN 'KeyError: k' WHEN 'signup' THEN 'ValueError: v' ELSE 'AssertionError' END AS message, CASE WHEN value > 50 THEN 'pkg/core.py:3: in run' WHEN value > 20 THEN '/usr/lib/python3/a.py:1: in f' ELSE '' END AS trace FROM events)
SELECT CASE WHEN message LIKE 'ImportError%' THEN 'infrastructure' WHEN message LIKE 'assert%' OR message LIKE 'AssertionError%' THEN 'assertion' WHEN trace LIKE 'pkg%' THEN 'behavioral_exception' WHEN trace <> '' THEN 'infrastructure' ELSE 'behavioral_exception' END AS failure_class, count(*) AS n FROM m GROUP BY 1""")
def q45_failure_class(t: Tables):
    e, v = F.col("event_type"), F.col("value")
    message = F.when(e == "error", "ImportError: no module").when(e == "view", "assert x == y").when(e == "click", "KeyError: k").when(e == "signup", "ValueError: v").otherwise("AssertionError")
    trace = F.when(v > 50, "pkg/core.py:3: in run").when(v > 20, "/usr/lib/python3/a.py:1: in f").otherwise("")
    return t.events.groupBy(reports.failure_class(F.lit("failure"), message, trace).alias("failure_class")).agg(F.count(F.lit(1)).alias("n"))


@Q.add(f"WITH {RUNS} SELECT a.user_id, a.test_id, CASE WHEN b.status IS NULL THEN 'absent_before' WHEN b.status = 'passed' THEN 'passing_both' WHEN b.failure_class IN ('assertion', 'behavioral_exception') THEN 'ran_and_failed' ELSE 'failed_on_load' END AS outcome FROM a LEFT JOIN b ON a.user_id = b.user_id AND a.test_id = b.test_id WHERE a.status = 'passed'")
def q47_screen(t: Tables):
    return gates.screen(*_runs(t), ["user_id", "test_id"])


@Q.add(f"""WITH {RUNS}, t AS (SELECT user_id, 'error' AS test_id FROM (SELECT DISTINCT user_id FROM b) WHERE user_id % 5 <> 0), j AS (SELECT u.user_id, t.test_id IS NOT NULL AS designated, b2.status, b2.failure_class FROM (SELECT DISTINCT user_id FROM b) u LEFT JOIN t ON t.user_id = u.user_id LEFT JOIN b b2 ON b2.user_id = t.user_id AND b2.test_id = t.test_id)
SELECT user_id, CASE WHEN NOT designated THEN 'no_targets_designated' WHEN status IS NULL THEN 'targets_not_collected' WHEN status <> 'failed' THEN 'targets_did_not_fail' WHEN failure_class NOT IN ('assertion', 'behavioral_exception') THEN 'failed_for_wrong_reason' END AS reason_code, reason_code IS NULL AS passed FROM j""")
def q48_gate_ladder(t: Tables):
    before, _ = _runs(t)
    targets = before.where("user_id % 5 <> 0").select("user_id").distinct().withColumn("test_id", F.lit("error"))
    return gates.fail_before(before, targets, ["user_id"]).select("user_id", "reason_code", "passed")


@Q.add(f"""WITH {RUNS}, f AS (SELECT coalesce(a.user_id, b.user_id) AS user_id, b.status AS bs, a.status AS s, b.failure_class AS bc, a.failure_class AS c FROM a FULL JOIN b ON a.user_id = b.user_id AND a.test_id = b.test_id), g AS (SELECT user_id, count(*) FILTER (WHERE s IS NULL) AS gone, count(*) FILTER (WHERE c = 'infrastructure' AND coalesce(bc, 'passed') <> 'infrastructure') AS infra, count(*) FILTER (WHERE bs = 'passed' AND coalesce(s, '') <> 'passed') AS worse FROM f GROUP BY 1)
SELECT user_id, CASE WHEN gone > 0 THEN 'tests_disappeared' WHEN infra > 0 THEN 'new_infrastructure_failures' WHEN worse > 0 THEN 'new_failures' END AS reason_code, gone + infra + worse = 0 AS passed FROM g""")
def q49_collateral(t: Tables):
    return gates.collateral(*_runs(t), ["user_id"]).select("user_id", "reason_code", "passed")


@Q.add("""WITH r AS (SELECT user_id, event_id % 3 AS run, event_type AS test_id, CASE WHEN max(value) > 20 THEN 'passed' ELSE 'failed' END AS status, (count(*) > 9)::VARCHAR AS signature FROM events GROUP BY ALL), n AS (SELECT user_id, count(DISTINCT run) AS runs FROM r GROUP BY 1), p AS (SELECT user_id, test_id, count(DISTINCT run) AS i, count(DISTINCT status) AS s, count(DISTINCT signature) AS g FROM r GROUP BY 1, 2)
SELECT user_id, CASE WHEN max(runs) < 2 THEN 'insufficient_repeats' WHEN count(*) FILTER (WHERE i < runs) > 0 THEN 'unstable_collection' WHEN count(*) FILTER (WHERE s > 1) > 0 THEN 'unstable_status' WHEN count(*) FILTER (WHERE g > 1) > 0 THEN 'unstable_signature' END AS reason_code FROM p JOIN n USING (user_id) GROUP BY 1""")
def q50_determinism(t: Tables):
    runs = t.events.groupBy("user_id", (F.col("event_id") % 3).alias("run"), F.col("event_type").alias("test_id")).agg(F.when(F.max("value") > 20, "passed").otherwise("failed").alias("status"), (F.count(F.lit(1)) > 9).cast("string").alias("signature"))
    return gates.determinism(runs, ["user_id"]).select("user_id", "reason_code")


@Q.add(f"""WITH {RUNS}, u AS (SELECT DISTINCT user_id FROM events UNION SELECT -1), v AS (SELECT user_id, test_id AS gate, status = 'passed' AS ok FROM a)
SELECT u.user_id, coalesce(bool_and(ok), false) AS all_gates_passed, coalesce(string_agg(gate, ',' ORDER BY gate) FILTER (WHERE NOT ok), '') AS failed_gates FROM u LEFT JOIN v ON u.user_id = v.user_id GROUP BY 1""")
def q53_rollup_empty_false(t: Tables):
    _, after = _runs(t)
    verdicts = after.select("user_id", F.col("test_id").alias("gate"), (F.col("status") == "passed").alias("passed"), F.col("failure_class").alias("reason_code"))
    users = t.events.select("user_id").unionByName(t.spark.range(1).select(F.lit(-1).cast("long").alias("user_id")))
    return gates.roll_up(verdicts, ["user_id"], users).select("user_id", "all_gates_passed", F.array_join("failed_gates", ",").alias("failed_gates"))


@Q.add("""WITH o AS (SELECT o_custkey, bool_and(l_linenumber > 2) AS test_only, bool_and(l_returnflag <> 'N') AS always_guarded, string_agg(DISTINCT CASE WHEN l_returnflag <> 'N' THEN l_returnflag END, ',' ORDER BY CASE WHEN l_returnflag <> 'N' THEN l_returnflag END) AS guards, (SELECT 1) AS x, array_to_string(list_slice(list(l_orderkey || ':' || l_linenumber ORDER BY l_orderkey, l_linenumber), 1, 5), ',') AS anchors FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)
SELECT o_custkey, test_only, always_guarded, coalesce(guards, '') AS guards, anchors, CASE WHEN always_guarded THEN 'optional' WHEN test_only THEN 'test' ELSE 'runtime' END AS bucket FROM o""")
def q61_import_facts(t: Tables):
    rows = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select("o_custkey", (F.col("l_linenumber") > 2).alias("t"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("guard"), F.concat_ws(":", "l_orderkey", "l_linenumber").alias("anchor"), "l_orderkey", "l_linenumber")
    out = dependencies.facts(rows, ["o_custkey"], "t", "guard", "anchor", ["l_orderkey", "l_linenumber"])
    return out.select("o_custkey", "test_only", "always_guarded", F.array_join("guards", ",").alias("guards"), F.array_join("anchors", ",").alias("anchors"), "bucket")


@Q.add("""WITH a AS (SELECT DISTINCT replace(p_name, ' ', '_') AS name FROM part WHERE p_size < 25), b AS (SELECT DISTINCT upper(replace(p_name, ' ', '.')) AS name FROM part WHERE p_size >= 25)
SELECT 'only_left' AS side, name FROM a WHERE lower(replace(name, '_', '-')) NOT IN (SELECT lower(replace(name, '.', '-')) FROM b) UNION ALL SELECT 'only_right', name FROM b WHERE lower(replace(name, '.', '-')) NOT IN (SELECT lower(replace(name, '_', '-')) FROM a)""")
def q62_name_audit(t: Tables):
    a = t.part.where("p_size < 25").select(F.replace("p_name", F.lit(" "), F.lit("_")).alias("name"))
    b = t.part.where("p_size >= 25").select(F.upper(F.replace("p_name", F.lit(" "), F.lit("."))).alias("name"))
    left, right = dependencies.name_audit(a, b)
    return left.select(F.lit("only_left").alias("side"), "name").unionByName(right.select(F.lit("only_right").alias("side"), "name"))


@Q.add("SELECT replace(p_name, ' ', '-') AS name, arg_max(p_size, p_partkey)::VARCHAR AS version FROM part WHERE p_partkey % 5 IN (0, 2) GROUP BY 1")
def q63_lock_lines(t: Tables):
    """The part table as one lock file: plain and continued pins, indented origins, comments, options. The last pin of a name wins."""
    pin = F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("=="), F.col("p_size").cast("string"))
    k = F.col("p_partkey") % 5
    line = F.when(k == 0, pin).when(k == 1, F.concat(F.lit("    # via "), pin)).when(k == 2, F.concat(pin, F.lit(" \\"))).when(k == 3, F.concat(F.lit("# "), pin)).otherwise(F.concat(F.lit("-e "), pin))
    return manifests.locked_packages(t.part.select(F.col("p_partkey").alias("ordinal"), line.alias("value")))


@Q.add("""WITH s AS (SELECT user_id, event_type, (CASE event_type WHEN 'error' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END) AS priority, count(*) AS units, event_type = 'click' AS required FROM events GROUP BY ALL), w AS (SELECT *, least(units, 20) AS want FROM s), d AS (SELECT *, coalesce(sum(CASE WHEN required THEN 0 ELSE want END) OVER (PARTITION BY user_id ORDER BY priority ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM w)
SELECT user_id, event_type, units, (CASE WHEN required THEN want ELSE greatest(0, least(want, 40 - used)) END)::BIGINT AS shown FROM d""")
def q65_budget_render(t: Tables):
    e = F.col("event_type")
    s = t.events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("units"))
    s = s.withColumns({"priority": F.when(e == "error", 1).when(e == "view", 2).when(e == "click", 3).when(e == "signup", 4).otherwise(5), "cap": F.lit(20), "required": e == "click"})
    return texts.budgeted(s, ["user_id"]).select("user_id", "event_type", "units", "shown")


@Q.add("""WITH c AS (SELECT user_id, list(DISTINCT event_type) AS cited FROM events WHERE value > 100 GROUP BY 1), k AS (SELECT user_id, list(DISTINCT event_type) AS known FROM events WHERE value < 100 AND event_type <> 'signup' GROUP BY 1), j AS (SELECT k.user_id, coalesce(cited, []) AS cited, known FROM k LEFT JOIN c ON c.user_id = k.user_id)
SELECT user_id, len(list_filter(cited, lambda x : NOT list_contains(known, x))) = 0 AND len(cited) > 0 AS grounded, len(cited) AS cited, round(len(list_intersect(cited, known)) / len(known), 6) AS coverage FROM j""")
def q66_grounding(t: Tables):
    c = t.events.where("value > 100").groupBy("user_id").agg(F.collect_set("event_type").alias("c"))
    k = t.events.where("value < 100 and event_type <> 'signup'").groupBy("user_id").agg(F.collect_set("event_type").alias("k"))
    j = k.join(c, "user_id", "left").withColumn("g", texts.grounding(F.coalesce("c", F.array().cast("array<string>")), F.col("k")))
    return j.select("user_id", "g.grounded", F.col("g.cited").cast("long").alias("cited"), F.round("g.coverage", 6).alias("coverage"))


@Q.add("SELECT event_type AS model, count(*) AS calls, sum(user_id)::BIGINT AS prompt_tokens, sum(event_id)::BIGINT AS completion_tokens, round(sum(value), 2) AS cost FROM events GROUP BY ROLLUP (event_type)")
def q67_usage_ledger(t: Tables):
    calls = t.events.select(F.col("event_type").alias("model"), F.col("user_id").alias("prompt_tokens"), F.col("event_id").alias("completion_tokens"), F.col("value").alias("cost"))
    return texts.usage(calls).withColumn("cost", F.round("cost", 2))


@Q.add("""WITH s AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem), g AS (SELECT DISTINCT s_nationkey, s_suppkey FROM supplier), c AS (SELECT l_orderkey, s_nationkey, count(*) AS shared FROM s JOIN g ON l_suppkey = s_suppkey GROUP BY 1, 2)
SELECT l_orderkey, s_nationkey, shared FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY shared DESC, s_nationkey) AS r FROM c) WHERE r = 1""")
def q70_overlap_argmax(t: Tables):
    left = t.lineitem.select("l_orderkey", F.col("l_suppkey").alias("item"))
    right = t.supplier.select("s_nationkey", F.col("s_suppkey").alias("item"), F.col("s_nationkey").alias("o"))
    return texts.best_overlap(left, right, "l_orderkey", "s_nationkey", "item", "o")


@Q.add("WITH m AS (SELECT doc_id, CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END AS quality FROM documents) SELECT m.doc_id, coalesce(l.quality, m.quality) AS quality, m.quality AS measured_quality, CASE WHEN l.quality IS NULL THEN 'measured' ELSE 'adjudicated' END AS origin FROM m LEFT JOIN labels l ON l.doc_id = m.doc_id")
def q71_override_merge(t: Tables):
    measured = t.documents.select("doc_id", F.when(F.col("n_chars") > 1000, 1).otherwise(0).alias("quality"))
    return texts.override(measured, t.labels.select("doc_id", "quality"), "doc_id", "quality")


@Q.add(f"WITH {RUNS}, f AS (SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.test_id, b.test_id) AS test_id, CASE WHEN a.status IS NULL THEN 'disappeared' WHEN b.status IS NULL THEN 'appeared' WHEN b.status = 'passed' AND a.status <> 'passed' THEN 'regression' WHEN b.status <> 'passed' AND a.status = 'passed' THEN 'repair' END AS change FROM a FULL JOIN b ON a.user_id = b.user_id AND a.test_id = b.test_id) SELECT * FROM f WHERE change IS NOT NULL")
def q72_run_diff(t: Tables):
    return gates.run_diff(*_runs(t), ["user_id", "test_id"])


@Q.add("SELECT event_type AS code, count(*) AS n FROM events GROUP BY 1")
def q74_code_counts(t: Tables):
    return manifests.rule_counts(t.events.select(F.lit("x").alias("tool"), F.col("event_type").alias("code"))).select("code", "n")


@Q.add("""WITH s AS (SELECT user_id, CASE event_type WHEN 'click' THEN 'emit' WHEN 'view' THEN 'bundle' ELSE event_type END AS stage, CASE WHEN max(value) > 320 THEN 'failed' WHEN min(value) < 0.5 THEN 'degraded' WHEN count(*) < 8 THEN 'skipped' ELSE 'ok' END AS status, round(sum(value), 2) AS seconds FROM events GROUP BY 1, 2, event_type)
SELECT user_id, bool_and(status <> 'failed') AS ok, count(DISTINCT CASE WHEN status IN ('ok', 'degraded') AND stage IN ('emit', 'bundle') THEN stage END) = 2 AS deliverable_complete, round(sum(seconds), 2) AS seconds FROM s GROUP BY 1""")
def q75_stage_rollup(t: Tables):
    stage = F.when(F.col("event_type") == "click", "emit").when(F.col("event_type") == "view", "bundle").otherwise(F.col("event_type"))
    status = F.when(F.max("value") > 320, "failed").when(F.min("value") < 0.5, "degraded").when(F.count(F.lit(1)) < 8, "skipped").otherwise("ok")
    s = t.events.groupBy("user_id", stage.alias("stage")).agg(status.alias("status"), F.round(F.sum("value"), 2).alias("seconds"))
    return gates.stage_rollup(s, ["user_id"]).withColumn("seconds", F.round("seconds", 2))


@Q.add("SELECT CASE WHEN o_orderstatus = 'F' THEN split_part(o_orderpriority, '-', 1) WHEN o_totalprice > 100000 THEN 'eligible' ELSE 'gates' END AS reason, count(*) AS n FROM orders GROUP BY 1")
def q78_validation_summary(t: Tables):
    tasks = t.orders.select(F.when(F.col("o_orderstatus") == "F", F.replace("o_orderpriority", F.lit("-"), F.lit(":"))).alias("rejected"), (F.col("o_totalprice") > 100000).alias("all_gates_passed"))
    return gates.validation_summary(tasks, [])
