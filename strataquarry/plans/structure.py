"""Source trees, graphs, gates and texts over rows that are made from the driver tables; each query calls the operator it stands for."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import numeric as N
from ..functions import text as T
from ..functions.lineage import cut
from ..operators import coverage, evidence, gates, graph, history, parse, rank, rewrite, texts
from .gating import RUNS, _runs
from .intake import _pick, _s
from .tables import Catalogue, Tables

Q = Catalogue()

# A tree of one module a supplier. Module s imports f of module s / 2 under another name, defines a class (of the base module's K
# if s is even), a method that calls what was imported, and a function that calls the class.
TREE = "t AS (SELECT s_suppkey AS s, s_suppkey // 2 AS h, 'pkg/m' || s_suppkey || '.py' AS path, 'pkg.m' || s_suppkey AS module FROM supplier)"
MODULE = 'import os\nfrom pkg.m%d import f%d as g\nfrom pkg.base import K\n\n\nclass C%d(%s):\n    """Class %d."""\n\n    def run(self):\n        return g(len(os.sep))\n\n\ndef f%d(x):\n    return C%d().run()\n'


def _tree(t: Tables):
    s = F.col("s_suppkey")
    h = F.expr("s_suppkey div 2")
    code = F.format_string(MODULE, h, h, s, F.when(s % 2 == 0, "K").otherwise("Gone"), s, s, s)
    files = t.supplier.select(F.concat(F.lit("pkg/m"), _s(s), F.lit(".py")).alias("path"), code.alias("content"))
    return files.unionByName(t.spark.sql("SELECT 'pkg/base.py' AS path, 'class K:\n    pass\n' AS content UNION ALL SELECT 'pkg/__init__.py', ''"))


def _parsed(t: Tables):
    files = cut(parse.module_names(_tree(t).withColumn("is_test", T.is_test_path(F.col("path")))))
    return files, parse.tables(cut(parse.parse_files(files)))  # read by every kind of edge, parsed once


@Q.add(f"WITH {TREE} SELECT path, module FROM t UNION ALL SELECT 'pkg/base.py', 'pkg.base' UNION ALL SELECT 'pkg/__init__.py', 'pkg'")
def q110_module_names(t: Tables):
    return parse.module_names(_tree(t)).select("path", "module")


@Q.add(f"""WITH {TREE} SELECT path || '::' || module AS id, 'module' AS kind, 1 AS line, 1 AS end_line, NULL AS parent, '' AS signature, '' AS docstring FROM t UNION ALL SELECT path || '::' || module || '.C' || s, 'class', 6, 10, path || '::' || module, '', 'Class ' || s || '.' FROM t
UNION ALL SELECT path || '::' || module || '.C' || s || '.run', 'method', 9, 10, path || '::' || module || '.C' || s, 'run(self)', '' FROM t UNION ALL SELECT path || '::' || module || '.f' || s, 'function', 13, 14, path || '::' || module, 'f' || s || '(x)', '' FROM t
UNION ALL SELECT 'pkg/base.py::pkg.base', 'module', 1, 2, NULL, '', '' UNION ALL SELECT 'pkg/base.py::pkg.base.K', 'class', 1, 2, 'pkg/base.py::pkg.base', '', '' UNION ALL SELECT 'pkg/__init__.py::pkg', 'module', 1, 1, NULL, '', ''""")
def q111_symbols(t: Tables):
    _, p = _parsed(t)
    return p["symbols"].select("id", "kind", "line", "end_line", "parent", F.coalesce("signature", F.lit("")).alias("signature"), F.coalesce("docstring", F.lit("")).alias("docstring"))


@Q.add(f"""WITH {TREE}, e AS (SELECT *, path || '::' || module AS me, 'pkg/m' || h || '.py::pkg.m' || h AS other FROM t)
SELECT 'contains' AS kind, me AS source, me || '.C' || s AS target, path, 6 AS line, 'C' || s AS expression FROM e UNION ALL SELECT 'contains', me || '.C' || s, me || '.C' || s || '.run', path, 9, 'run' FROM e UNION ALL SELECT 'contains', me, me || '.f' || s, path, 13, 'f' || s FROM e UNION ALL SELECT 'contains', 'pkg/base.py::pkg.base', 'pkg/base.py::pkg.base.K', 'pkg/base.py', 1, 'K'
UNION ALL SELECT 'imports', me, other, path, 2, 'pkg.m' || h || '.f' || h FROM e UNION ALL SELECT 'imports', me, 'pkg/base.py::pkg.base', path, 3, 'pkg.base.K' FROM e UNION ALL SELECT 'inherits', me || '.C' || s, 'pkg/base.py::pkg.base.K', path, 6, 'K' FROM e WHERE s % 2 = 0
UNION ALL SELECT 'calls', me || '.C' || s || '.run', other || '.f' || h, path, 10, 'g' FROM e UNION ALL SELECT 'calls', me || '.f' || s, me || '.C' || s, path, 14, 'C' || s FROM e""")
def q112_graph_edges(t: Tables):
    files, p = _parsed(t)
    return graph.build(files, p["symbols"], p["imports"], p["calls"])[0].select(*graph.EDGE_KEY)


@Q.add(f"""WITH {TREE}, e AS (SELECT *, path || '::' || module AS me FROM t) SELECT 'import' AS kind, 'os' AS expression, me AS source, path, 1 AS line, 'stdlib_module' AS reason FROM e UNION ALL SELECT 'base', 'Gone', me || '.C' || s, path, 6, 'unresolved_base' FROM e WHERE s % 2 = 1 UNION ALL SELECT 'call', 'len', me || '.C' || s || '.run', path, 10, 'builtin' FROM e""")
def q113_unresolved(t: Tables):
    files, p = _parsed(t)
    return graph.build(files, p["symbols"], p["imports"], p["calls"])[1].select("kind", "expression", "source", "path", "line", "reason")


@Q.add(f"""WITH {TREE}, n AS (SELECT count(*) AS n, count(*) FILTER (WHERE s % 2 = 0) AS even FROM t) SELECT name, v::BIGINT AS n FROM n, LATERAL (SELECT unnest(['files', 'test_files', 'symbols', 'edges:contains', 'edges:imports', 'edges:inherits', 'edges:calls', 'unresolved:stdlib_module', 'unresolved:unresolved_base', 'unresolved:builtin']) AS name, unnest([n + 2, 0, 4 * n + 3, 3 * n + 1, 2 * n, even, 2 * n, n, n - even, n]) AS v) AS l""")
def q114_graph_statistics(t: Tables):
    files, p = _parsed(t)
    edges, loose = graph.build(files, p["symbols"], p["imports"], p["calls"])
    return graph.statistics(files, p["symbols"], edges, loose)


@Q.add("""WITH m AS (SELECT p_partkey AS k, length(bin(p_partkey)) - 1 AS d FROM part WHERE p_partkey >= 2) SELECT 'pkg/m' || k || '.py' AS path, 'deep' AS bound_name, CASE WHEN d <= 7 THEN 'pkg/m1.py::pkg.m1.deep' ELSE 'pkg/m' || k // 2 || '.py::pkg.m' || k // 2 END AS target FROM m""")
def q115_reexport_chase(t: Tables):
    """A name handed on through k -> k / 2 -> ... -> 1; six hops behind the first import are followed, else its module stands."""
    k = F.col("p_partkey")
    path, module = F.concat(F.lit("pkg/m"), _s(k), F.lit(".py")), F.concat(F.lit("pkg.m"), _s(k))
    files = t.part.where(k >= 1).select(path.alias("path"), module.alias("module"))
    null = F.lit(None).cast("string")
    imports = t.part.where(k >= 2).select(path.alias("path"), F.lit(1).alias("line"), F.concat(F.lit("pkg.m"), _s(F.expr("p_partkey div 2"))).alias("module"), F.lit("deep").alias("name"), null.alias("alias"), F.lit(0).alias("level"), F.lit("").alias("scope"), null.alias("guard"), F.lit("deep").alias("bound_name"), F.lit(0).alias("ordinal"))
    return graph.bindings(imports, files, t.spark.sql("SELECT 'pkg/m1.py::pkg.m1.deep' AS id"))


@Q.add("""WITH e AS (SELECT event_id, event_id % 4 AS level, event_id % 3 = 0 AS pack, list_slice(['a', 'b', 'c', 'd'], 1, (event_id % 5)::BIGINT) AS here, CASE WHEN event_id % 2 = 0 THEN 'x.' || event_type ELSE '' END AS module FROM events), d AS (SELECT *, greatest(len(here) - CASE WHEN pack THEN level - 1 ELSE level END, 0) AS keep FROM e)
SELECT event_id, CASE WHEN level = 0 THEN module ELSE array_to_string(list_concat(list_slice(here, 1, least(keep, len(here))), CASE WHEN module <> '' THEN [module] ELSE [] END), '.') END AS absolute FROM d""")
def q116_relative_imports(t: Tables):
    i = F.col("event_id")
    here = F.array_join(F.slice(F.array(*map(F.lit, "abcd")), F.lit(1), (i % 5).cast("int")), ".")
    module = F.when(i % 2 == 0, F.concat(F.lit("x."), "event_type")).otherwise("")
    return t.events.select("event_id", T.resolve_relative(here, module, (i % 4).cast("int"), i % 3 == 0).alias("absolute"))


CALLS = "e AS (SELECT DISTINCT l_suppkey AS a, (l_partkey % 40) AS b FROM lineitem WHERE l_suppkey < 60)"


@Q.add(f"WITH {CALLS}, c AS (SELECT 'f' || n || '.py' AS path FROM range(30, 36) r(n)), hit AS (SELECT DISTINCT 'f' || a || '.py' AS path FROM e WHERE b BETWEEN 30 AND 35 AND a NOT BETWEEN 30 AND 35), u AS (SELECT path, 0 AS way FROM c UNION ALL SELECT path, 1 FROM hit WHERE path NOT IN (SELECT path FROM c)) SELECT path, way FROM u ORDER BY way, path LIMIT 25")
def q117_scope_files(t: Tables):
    name = lambda c: F.concat(F.lit("f"), _s(c), F.lit(".py"))
    a, b = F.col("l_suppkey"), F.col("l_partkey") % 40
    edges = t.lineitem.where("l_suppkey < 60").select(F.lit("calls").alias("kind"), F.concat(name(a), F.lit("::g")).alias("source"), F.concat(name(b), F.lit("::g")).alias("target"), name(a).alias("path"), F.lit(1).alias("line"), F.lit("g").alias("expression")).distinct()
    files = t.spark.range(100).select(name("id").alias("path"))
    return evidence.scope_files(edges, files.select("path", F.concat("path", F.lit("::g")).alias("id")), t.spark.range(30, 36).select(name("id").alias("path")), callers=True)


@Q.add("""WITH RECURSIVE e AS (SELECT p_partkey AS s, p_partkey // 2 AS t FROM part UNION SELECT p_partkey, (p_partkey + 1) % 30 FROM part WHERE p_partkey < 30), r AS (SELECT s, t FROM e WHERE s < 200 UNION SELECT r.s, e.t FROM r JOIN e ON e.s = r.t) SELECT DISTINCT s AS node FROM r WHERE s = t""")
def q118_on_cycle(t: Tables):
    k = F.col("p_partkey")
    halves = t.part.select(k.alias("source"), F.expr("p_partkey div 2").alias("target"))
    ring = t.part.where(k < 30).select(k.alias("source"), ((k + 1) % 30).alias("target"))
    return graph.on_cycle(halves.unionByName(ring))


FILES = "f AS (SELECT DISTINCT split_part(p_name, ' ', 1) || '/' || split_part(p_name, ' ', 2) || '.py' AS path FROM part WHERE p_size < 2 UNION SELECT DISTINCT split_part(p_name, ' ', 1) || '.py' FROM part WHERE p_size > 49)"
NODES = "n AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b, 'test_' || p_size % 5 AS t FROM part)"
ARGUMENTS = f"{FILES}, {NODES}, g AS (SELECT a || '.' || b || '.Case::' || t AS node, CASE WHEN a || '/' || b || '.py' IN (SELECT path FROM f) THEN a || '/' || b || '.py::Case::' || t WHEN a || '.py' IN (SELECT path FROM f) THEN a || '.py::' || b || '::Case::' || t ELSE a || '.' || b || '.Case::' || t END AS argument FROM n)"


def _arguments(t: Tables):
    a, b = F.substring_index("p_name", " ", 1), F.substring_index("p_name", " ", -1)
    files = t.part.where("p_size < 2").select(F.concat(a, F.lit("/"), b, F.lit(".py")).alias("path")).unionByName(t.part.where("p_size > 49").select(F.concat(a, F.lit(".py")).alias("path")))
    nodes = t.part.select(F.concat(F.replace("p_name", F.lit(" "), F.lit(".")), F.lit(".Case::test_"), _s(F.col("p_size") % 5)).alias("node"))
    return evidence.file_argument(nodes, files), files


@Q.add(f"WITH {ARGUMENTS} SELECT node, argument FROM g")
def q119_file_arguments(t: Tables):
    return _arguments(t)[0]


@Q.add(f"WITH {ARGUMENTS} SELECT split_part(argument, '::', 1) AS path, string_agg(DISTINCT replace(substr(argument, strpos(argument, '::') + 2), '::', '.'), ',' ORDER BY replace(substr(argument, strpos(argument, '::') + 2), '::', '.')) AS names FROM g WHERE argument LIKE '%.py::%' GROUP BY 1")
def q120_designated_tests(t: Tables):
    arguments, files = _arguments(t)
    return evidence.designate(arguments.select("argument"), files).select("path", F.array_join("names", ",").alias("names"))


@Q.add("SELECT 'Test' || p_size AS name, min('m' || p_partkey || CASE WHEN p_partkey % 2 = 0 THEN '.go' ELSE '.rs' END) AS path FROM part WHERE p_size % 3 = 0 GROUP BY p_size")
def q121_declared_in(t: Tables):
    even = F.col("p_partkey") % 2 == 0
    name = F.concat(F.lit("Test"), _s("p_size"))
    files = t.part.select(F.concat(F.lit("m"), _s("p_partkey"), F.when(even, ".go").otherwise(".rs")).alias("path"), F.concat(F.lit("// func Testing\n"), F.when(even, F.concat(F.lit("func "), name, F.lit("(t *T) {}"))).otherwise(F.concat(F.lit("fn "), name, F.lit("<T>() {}")))).alias("content"))
    return evidence.declared_in(t.part.where("p_size % 3 = 0").select(name.alias("name")), files)


KIND_PATHS = "k AS (SELECT DISTINCT (['src', 'tests', 'test', 'testing', 'Tests', 'spec'])[p_size % 6 + 1] || '/' || (['test_a.py', 'a_test.py', 'b.py', 'tests', 'x.spec.ts', 'contest.py', 'TestB.java'])[p_partkey % 7 + 1] AS path FROM part)"


@Q.add(f"""WITH {KIND_PATHS}, s AS (SELECT *, split_part(path, '/', 1) AS dir, split_part(path, '/', 2) AS name FROM k) SELECT path, name LIKE 'test\\_%' ESCAPE '\\' OR name LIKE '%\\_test.py' ESCAPE '\\' OR dir IN ('test', 'tests', 'testing') AS strict, name LIKE 'test\\_%' ESCAPE '\\' OR name LIKE '%\\_test.py' ESCAPE '\\' OR dir = 'tests' AS loose,
regexp_matches(lower(path), 'test_|_test\\.|\\.test\\.|\\.spec\\.|/tests/|/test/|/spec/') OR lower(name) LIKE 'test%' AS any_language FROM s""")
def q122_test_paths(t: Tables):
    path = F.concat(_pick(F.col("p_size") % 6, "src", "tests", "test", "testing", "Tests", "spec"), F.lit("/"), _pick(F.col("p_partkey") % 7, "test_a.py", "a_test.py", "b.py", "tests", "x.spec.ts", "contest.py", "TestB.java"))
    p = F.col("path")
    return t.part.select(path.alias("path")).distinct().select("path", T.is_test_path(p).alias("strict"), evidence.looks_like_test(p).alias("loose"), evidence.looks_like_test_any(p).alias("any_language"))


@Q.add(f"WITH {TREE}, w AS (SELECT DISTINCT 'pkg/m' || c_custkey % 120 || '.py::pkg.m' || c_custkey % 120 || '.f' || c_custkey % 120 AS id, c_custkey % 120 AS s FROM customer) SELECT w.id, CASE WHEN t.s IS NULL THEN '' ELSE 'f' || w.s || '(x)' END AS signature, CASE WHEN t.s IS NULL THEN '' ELSE 'pkg.m' || w.s END AS module FROM w LEFT JOIN t USING (s)")
def q123_contracts(t: Tables):
    n = _s(F.col("c_custkey") % 120)
    wanted = t.customer.select(F.concat(F.lit("pkg/m"), n, F.lit(".py::pkg.m"), n, F.lit(".f"), n).alias("id"))
    return evidence.contract_of(_parsed(t)[1]["symbols"], wanted).select("id", "signature", "module")


@Q.add(f"WITH {RUNS}, v AS (SELECT user_id, bool_and(status = 'passed') AS ok FROM a GROUP BY 1) SELECT c_custkey AS user_id FROM customer JOIN v ON v.user_id = c_custkey WHERE ok AND c_custkey % 7 <> 0")
def q124_eligible(t: Tables):
    _, after = _runs(t)
    verdicts = after.select("user_id", F.col("test_id").alias("gate"), (F.col("status") == "passed").alias("passed"), F.col("failure_class").alias("reason_code"))
    tasks = t.customer.select(F.col("c_custkey").alias("user_id"), F.when(F.col("c_custkey") % 7 == 0, "dropped").alias("rejected"))
    return gates.eligible(tasks, verdicts, ["user_id"]).select("user_id")


@Q.add("""WITH d AS (SELECT l_orderkey AS number, CASE l_linenumber % 3 WHEN 0 THEN 'pkg/m' || l_partkey % 5 || '.py' WHEN 1 THEN 'tests/test_m' || l_partkey % 5 || '.py' ELSE 'docs/d' || l_partkey % 5 || '.md' END AS path, l_quantity::BIGINT AS churn, l_linenumber % 3 AS kind, l_partkey % 5 AS m FROM lineitem), p AS (SELECT number, count(*) AS files_changed, sum(churn)::BIGINT AS churn, count(*) FILTER (WHERE kind = 0) AS source_files_changed, count(*) FILTER (WHERE kind = 1) AS test_files_changed, string_agg(DISTINCT CASE WHEN m < 4 THEN 'pkg.m' || m ELSE path END, ',' ORDER BY CASE WHEN m < 4 THEN 'pkg.m' || m ELSE path END) FILTER (WHERE kind = 0) AS modules, arg_max(path, churn * 1000 + m) FILTER (WHERE kind = 0) AS p0, arg_max(path, churn * 1000 + m) FILTER (WHERE kind = 1) AS p1 FROM d GROUP BY 1)
SELECT 'pr-' || o_orderkey AS candidate_id, files_changed, churn, source_files_changed, test_files_changed, coalesce(modules, '') AS modules, coalesce(p0, p1) AS primary_path, CASE WHEN o_orderstatus = 'P' THEN 'not_merged' WHEN o_custkey % 10 = 0 THEN 'head_unknown' WHEN o_custkey % 7 = 0 THEN 'no_parent' WHEN coalesce(source_files_changed + test_files_changed, 0) = 0 THEN 'no_python_change' END AS reason FROM orders LEFT JOIN p ON number = o_orderkey""")
def q125_history_candidates(t: Tables):
    kind, m, key = F.col("l_linenumber") % 3, _s(F.col("l_partkey") % 5), F.col("o_orderkey")
    path = F.when(kind == 0, F.concat(F.lit("pkg/m"), m, F.lit(".py"))).when(kind == 1, F.concat(F.lit("tests/test_m"), m, F.lit(".py"))).otherwise(F.concat(F.lit("docs/d"), m, F.lit(".md")))
    deltas = t.lineitem.select(F.col("l_orderkey").alias("number"), path.alias("path"), F.col("l_quantity").cast("long").alias("churn"))
    modules = t.spark.range(4).select(F.concat(F.lit("pkg/m"), _s("id"), F.lit(".py")).alias("path"), F.concat(F.lit("pkg.m"), _s("id")).alias("module"))
    pulls = t.orders.select(key.alias("number"), F.col("o_orderpriority").alias("title"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("string")).alias("merged_at"), F.lit(None).cast("string").alias("body"))
    heads = t.orders.where("o_custkey % 10 <> 0").select(key.alias("number"), F.concat(F.lit("h"), _s(key)).alias("head_sha"), F.when(F.col("o_custkey") % 7 != 0, F.concat(F.lit("b"), _s(key))).alias("base_sha"))
    tests = t.orders.select(key.alias("number"), F.lit(1).alias("added_tests"), F.lit(0).alias("modified_tests")).limit(0)
    out = history.history_candidates(pulls, heads, deltas, modules, tests)
    own = F.when(F.col("source_files_changed") > 0, F.array_join("modules", ",")).otherwise("")
    return out.select("candidate_id", "files_changed", "churn", "source_files_changed", "test_files_changed", own.alias("modules"), "primary_path", "reason")


@Q.add("""WITH c AS (SELECT p_partkey, 'p.m' || p_partkey % 7 || '.f' || p_partkey AS id, 'p.m' || p_partkey % 7 AS module, p_size AS body, p_partkey % 2 = 0 AS doc FROM part WHERE p_size > 25 AND p_partkey % 7 <> 6 AND p_partkey % 5 <> 0), k AS (SELECT *, row_number() OVER (PARTITION BY module ORDER BY (NOT doc)::INT, -body, id) AS n, row_number() OVER (ORDER BY (NOT doc)::INT, -body, id) AS place FROM c), f AS (SELECT * FROM k WHERE n = 1 ORDER BY place LIMIT 4), l AS (SELECT * FROM k WHERE (SELECT count(*) FROM f) = 4 AND place > (SELECT max(place) FROM f) ORDER BY place LIMIT 1) SELECT id FROM f UNION ALL SELECT id FROM l""")
def q126_uncovered_targets(t: Tables):
    m = _s(F.col("p_partkey") % 7)
    name, path = F.concat(F.lit("p.m"), m, F.lit(".f"), _s("p_partkey")), F.concat(F.when(F.col("p_partkey") % 7 == 6, "docs/m").otherwise("p/m"), m, F.lit(".py"))
    covered = t.part.select(name.alias("id"), path.alias("path"), F.lit("function").alias("kind"), name.alias("qualified_name"), F.col("p_size").alias("body_lines"), F.when(F.col("p_size") > 25, 0).otherwise(3).alias("tests"), F.lit(False).alias("is_test"), (F.col("p_partkey") % 2 == 0).alias("has_docstring"))
    symbols = t.part.select(name.alias("id"), (F.col("p_partkey") % 5 != 0).alias("is_public"))
    files = t.part.select(path.alias("path")).distinct().unionByName(t.spark.sql("SELECT 'p/__init__.py' AS path"))
    return coverage.uncovered_targets(covered, symbols, files, 5).select("id")


@Q.add("""WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'Merge branch x' WHEN o_orderkey % 51 = 0 THEN '  sync: y' ELSE 'merged ' || o_orderpriority END AS title, CASE WHEN o_orderstatus = 'P' THEN 'excision' ELSE 'history' END AS source, count(*) * count(*) AS files, sum(l_quantity)::BIGINT * count(*) * 4 AS churn FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL), m AS (SELECT median(files) AS f, median(churn) AS c FROM o WHERE source = 'history')
SELECT o_orderkey, CASE WHEN source <> 'history' THEN NULL WHEN regexp_matches(trim(title), '^(stable|main|master|merge\\b|sync\\b|release\\b)', 'i') THEN 'generic_or_merge_title' WHEN files > greatest(25, floor(f * 4)) AND churn > greatest(2000, floor(c * 6)) THEN 'change_too_broad:' || files || '_files:' || churn || '_lines' END AS reason FROM o, m""")
def q39_coherent_history(t: Tables):
    k = F.col("o_orderkey")
    title = F.when(k % 50 == 0, "Merge branch x").when(k % 51 == 0, "  sync: y").otherwise(F.concat(F.lit("merged "), "o_orderpriority"))
    n = F.count(F.lit(1))
    tasks = t.orders.join(t.lineitem, F.col("l_orderkey") == k).groupBy("o_orderkey", title.alias("title"), F.when(F.col("o_orderstatus") == "P", "excision").otherwise("history").alias("source")).agg((n * n).alias("files_changed"), (F.sum("l_quantity").cast("long") * n * 4).alias("churn"))
    return rank.coherent(tasks).select("o_orderkey", "reason")


BAD = "CASE p_size % 6 WHEN 0 THEN 'reads_git_history' WHEN 1 THEN 'reads_solution_path' WHEN 2 THEN 'reads_diff_artifact' WHEN 3 THEN 'inspects_own_source' END"


@Q.add(f"""WITH f AS (SELECT p_brand, 't' || p_partkey || '.py' AS path, {BAD} AS bad FROM part WHERE p_partkey % 90 = 7 OR p_size % 6 > 3), g AS (SELECT p_brand, count(bad) AS n, string_agg(path, ',' ORDER BY path) FILTER (WHERE bad = 'reads_git_history') AS a, string_agg(path, ',' ORDER BY path) FILTER (WHERE bad = 'reads_diff_artifact') AS b FROM f GROUP BY 1) SELECT p_brand, n = 0 AS passed, CASE WHEN n > 0 THEN 'verifier_can_read_answer' END AS reason_code, coalesce(a, '') AS git_paths, coalesce(b, '') AS diff_paths FROM g""")
def q127_verifier_integrity(t: Tables):
    content = _pick(F.col("p_size") % 6, 'run(["git", "log"])', "open('x/solution/a.py')", "read('my.patch')", "inspect.getsource(f)", "assert digit == 1", "import solutions")
    files = t.part.where("p_partkey % 90 = 7 or p_size % 6 > 3").select("p_brand", F.concat(F.lit("t"), _s("p_partkey"), F.lit(".py")).alias("path"), content.alias("content"))
    return gates.integrity(files, ["p_brand"]).select("p_brand", "passed", "reason_code", F.array_join("reads_git_history", ",").alias("git_paths"), F.array_join("reads_diff_artifact", ",").alias("diff_paths"))


@Q.add("""WITH f AS (SELECT p_type, (['.git/config', 'solution/a.py', 'src/solution/a.py', 'a/b.patch', 'x/__pycache__/y.pyc', 'ok.py', 'my.diff', 'evidence', 'diff.py', 'lib/evidence.py'])[p_size % 10 + 1] AS path FROM part WHERE p_type <> 'SMALL' OR p_size % 10 IN (2, 5, 8, 9)), g AS (SELECT p_type, array_to_string(list_slice(list_sort(list(DISTINCT path) FILTER (WHERE path IN ('.git/config', 'solution/a.py', 'a/b.patch', 'x/__pycache__/y.pyc', 'my.diff', 'evidence'))), 1, 25), ',') AS paths FROM f GROUP BY 1) SELECT p_type, coalesce(paths, '') = '' AS passed, CASE WHEN coalesce(paths, '') <> '' THEN 'answer_reachable_from_input' END AS reason_code, coalesce(paths, '') AS paths FROM g""")
def q128_bundle_audit(t: Tables):
    path = _pick(F.col("p_size") % 10, ".git/config", "solution/a.py", "src/solution/a.py", "a/b.patch", "x/__pycache__/y.pyc", "ok.py", "my.diff", "evidence", "diff.py", "lib/evidence.py")
    files = t.part.where("p_type <> 'SMALL' or p_size % 10 in (2, 5, 8, 9)").select("p_type", path.alias("path"))
    return gates.bundle_audit(files, ["p_type"]).select("p_type", "passed", "reason_code", F.array_join("paths", ",").alias("paths"))


@Q.add("""WITH f AS (SELECT 't' || p_partkey || '.py' AS path, p_size, p_partkey % 3 AS m FROM part) SELECT path, 2::BIGINT AS line, 'patched_internals' AS kind, NULL AS name FROM f WHERE m = 0 UNION ALL SELECT path, 3, 'exact_representation', NULL FROM f WHERE m = 1 UNION ALL SELECT path, 4, 'type_identity', NULL FROM f WHERE m = 2 UNION ALL SELECT path, 5, 'private_references', CASE WHEN p_size % 2 = 0 THEN '_alpha' ELSE '_beta' END FROM f""")
def q52_coupling_scan(t: Tables):
    m, even = F.col("p_partkey") % 3, F.col("p_size") % 2 == 0
    line = lambda on, code: F.when(on, code).otherwise("x = 1")
    content = F.concat_ws("\n", F.lit("# mock.patch('a') and assert repr(x)"), line(m == 0, "with mock.patch ('pkg.a'):"), line(m == 1, "    assert str(x) == 'a'"), line(m == 2, "assert type(x) is  int "), F.when(even, "_beta_x(_alpha, _beta)").otherwise("_gamma; obj._beta()"), F.lit("  # _alpha"), F.lit("dispatch(1); sprite == repr_of"))
    files = t.part.select(F.concat(F.lit("t"), _s("p_partkey"), F.lit(".py")).alias("path"), content.alias("content"))
    return gates.coupling(files, t.spark.sql("SELECT * FROM VALUES ('_alpha'), ('_beta') AS v(name)")).select("path", F.col("line").cast("long").alias("line"), "kind", "name")


@Q.add("SELECT coalesce(problem, 'valid') AS problem, count(*) AS n FROM (SELECT CASE WHEN event_id % 5 = 0 THEN 'missing:n' WHEN event_id % 7 = 0 THEN 'not_int:n' WHEN event_id % 11 = 0 THEN 'not_date:d' END AS problem FROM events) AS v GROUP BY 1")
def q129_guarded_records(t: Tables):
    i = F.col("event_id")
    rows = t.events.select(F.when(i % 5 == 0, None).when(i % 7 == 0, "seven").otherwise(_s(i)).alias("n"), F.when(i % 11 == 0, "someday").otherwise("2024-01-01").alias("d"))
    good, bad = evidence.guard_records(rows, {"n": "int", "d": "date"})
    return good.select(F.lit("valid").alias("problem")).unionByName(bad.select("problem")).groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


@Q.add(f"""WITH {RUNS}, f AS (SELECT coalesce(a.user_id, b.user_id) AS user_id, b.status AS was, a.status AS now FROM a FULL JOIN b ON a.user_id = b.user_id AND a.test_id = b.test_id), g AS (SELECT user_id, count(was) AS b, count(now) AS o, count(*) FILTER (WHERE now IS NULL) AS gone, count(*) FILTER (WHERE was = 'passed' AND now <> 'passed') AS worse, count(*) FILTER (WHERE was IS NULL) AS new FROM f GROUP BY 1), m AS (SELECT user_id, CASE WHEN b = 0 THEN 'no_baseline' WHEN o = 0 THEN 'container_produced_no_results' WHEN gone > 0 THEN 'tests_missing_in_container' WHEN worse > 0 THEN 'differs' WHEN new > 0 THEN 'matches_with_additions' ELSE 'matches' END AS match FROM g)
SELECT user_id, match, CASE WHEN user_id % 5 = 0 THEN 'build_failed' WHEN user_id % 7 = 0 THEN 'nondeterministic' WHEN user_id % 11 = 0 THEN 'tests_failed' WHEN match LIKE 'matches%' THEN 'verified' WHEN match = 'no_baseline' THEN 'deterministic_unverified' ELSE 'baseline_mismatch' END AS container, CASE WHEN user_id % 5 = 0 THEN 'regressed' WHEN user_id % 3 = 0 THEN 'not_clean' WHEN user_id % 2 = 0 THEN 'complete_unverified' WHEN user_id % 7 = 0 THEN 'complete_no_tests' ELSE 'complete' END AS hygiene FROM m""")
def q130_status_ladders(t: Tables):
    before, after = _runs(t)
    u = F.col("user_id")
    rows = evidence.baseline_match(after, before, ["user_id"])
    container = evidence.container_status(F.when(u % 5 == 0, "failed").otherwise("built"), u % 7 != 0, F.col("match"), u % 11 != 0)
    hygiene = evidence.hygiene_status(F.when(u % 5 == 0, 1).otherwise(0), (u % 3 == 0).cast("int"), F.lit(0), F.when(u % 7 == 0, "no_tests").otherwise("measured"), F.when(u % 2 == 0, "unavailable").otherwise("measured"))
    return rows.select("user_id", "match", container.alias("container"), hygiene.alias("hygiene"))


SPECS = ("fits AS (SELECT v, s, CASE s WHEN '>=3.8' THEN v >= 8 WHEN '<3.12' THEN v < 12 WHEN '!=3.10' THEN v <> 10 WHEN '==3.9.*' THEN v = 9 WHEN '~= 3.7' THEN v >= 7 WHEN '>3.5,<=3.40' THEN v > 5 AND v <= 40 END AS ok "
         "FROM (SELECT DISTINCT p_size AS v FROM part), (VALUES ('>=3.8'), ('<3.12'), ('!=3.10'), ('==3.9.*'), ('~= 3.7'), ('>3.5,<=3.40')) AS x(s))")  # fmt: skip


@Q.add(f"WITH {SPECS} SELECT s AS spec, count(*) FILTER (WHERE ok) AS fitting, '3.' || max(v) FILTER (WHERE ok) AS newest FROM fits GROUP BY 1")
def q131_version_specs(t: Tables):
    versions = t.part.select(F.concat(F.lit("3."), _s("p_size")).alias("version")).distinct()
    out = None
    for spec in (">=3.8", "<3.12", "!=3.10", "==3.9.*", "~= 3.7", ">3.5,<=3.40"):
        specs = F.array(*map(F.lit, spec.split(",")))
        fit = versions.where(F.forall(specs, lambda s: N.satisfies(F.col("version"), s))).agg(F.count(F.lit(1)).alias("fitting"))
        one = fit.crossJoin(evidence.newest_interpreter(versions, specs)).select(F.lit(spec).alias("spec"), "fitting", F.col("version").alias("newest"))
        out = one if out is None else out.unionByName(one)
    return out


STAGES = ("hygiene", "deps", "container", "graph", "coverage", "testgen", "validate", "adjudicate", "select", "emit", "bundle", "ingest")


@Q.add("""WITH e AS (SELECT event_id, (['hygiene', 'deps', 'container', 'graph', 'coverage', 'testgen', 'validate', 'adjudicate', 'select', 'emit', 'bundle', 'ingest'])[event_id % 12 + 1] AS stage, user_id % 3 AS a, user_id % 2 AS b, CASE WHEN event_id % 13 = 0 THEN 'skipped' ELSE 'ok' END AS status FROM events),
x AS (SELECT *, (['complete', 'locked', 'verified'])[a + 1] AS result FROM e)
SELECT stage, CASE WHEN status <> 'ok' THEN status WHEN stage = 'hygiene' AND (b = 1 AND a <> 0 OR b = 0) THEN 'failed' WHEN stage = 'deps' AND (a <> 1 OR b = 0) THEN 'failed' WHEN stage IN ('container', 'graph') AND a <> 2 THEN 'failed' WHEN stage IN ('coverage', 'testgen') THEN 'failed' WHEN stage = 'validate' AND a < 2 THEN 'failed' WHEN stage = 'adjudicate' AND (a > 0 OR b = 1) THEN 'degraded' WHEN stage = 'select' AND b = 0 THEN 'failed' WHEN stage = 'emit' AND (a <> 2 OR b = 0) THEN 'failed' WHEN stage = 'bundle' AND (a <> 2 OR b = 1) THEN 'failed' ELSE 'ok' END AS status, count(*) AS n FROM x GROUP BY ALL""")
def q132_stage_rules(t: Tables):
    a, b = F.col("user_id") % 3, F.col("user_id") % 2
    stages = t.events.select(
        _pick(F.col("event_id") % 12, *STAGES).alias("stage"), F.when(F.col("event_id") % 13 == 0, "skipped").otherwise("ok").alias("status"), _pick(a, "complete", "locked", "verified").alias("result"),
        (b == 1).alias("regressions_verified"), (b == 1).alias("environment_available"), (a * 5).alias("eligible"), F.when(b == 1, "a note").alias("note"), a.alias("fell_back"), (b == 1).alias("satisfied"), F.when(a == 2, 10).alias("task_count"), F.lit(None).cast("int").alias("leaking"), F.lit(0).alias("invalid"), b.alias("missing"),
    )
    return gates.stage_semantics(stages, gates.stage_rules()).groupBy("stage", "status").agg(F.count(F.lit(1)).alias("n"))


@Q.add("""WITH g AS (SELECT DISTINCT 'tests/t' || p_size % 9 || '.py' AS path, 'C::test_' || p_partkey % 40 || '[' || p_size % 3 || ']' AS test, p_size % 9 AS f, p_partkey % 40 AS k FROM part WHERE p_size > 40 EXCEPT SELECT 'tests/t' || p_size % 9 || '.py', 'C::test_' || p_partkey % 40 || '[' || p_size % 3 || ']', p_size % 9, p_partkey % 40 FROM part WHERE p_size <= 8) SELECT path, test FROM g WHERE f < 6 AND k % 4 <> 0""")
def q133_removed_on_purpose(t: Tables):
    """Gone after, in files 0 to 5, and not one of the names that divide by four, which are still declared."""
    path, test = F.concat(F.lit("tests/t"), _s(F.col("p_size") % 9), F.lit(".py")), F.concat(F.lit("C::test_"), _s(F.col("p_partkey") % 40), F.lit("["), _s(F.col("p_size") % 3), F.lit("]"))
    of = lambda where: t.part.where(where).select(path.alias("path"), test.alias("test"))
    declared = t.part.where("p_partkey % 4 = 0").select(path.alias("path"), F.concat(F.lit("C.test_"), _s(F.col("p_partkey") % 40)).alias("name")).distinct()
    declared = declared.select("name").distinct().crossJoin(t.spark.range(9).select(F.concat(F.lit("tests/t"), _s("id"), F.lit(".py")).alias("path")))
    return gates.removed_on_purpose(of("p_size > 40"), of("p_size <= 8"), declared, t.spark.range(6).select(F.concat(F.lit("tests/t"), _s("id"), F.lit(".py")).alias("path")))


DIFF = "d AS (SELECT p_partkey AS k, 't' || p_partkey AS task_id, p_size FROM part)"


def _diffs(t: Tables):
    k = _s("p_partkey")
    diff = F.concat(F.lit("--- a/x.py\n+++ b/x.py\n+"), F.when(F.col("p_size") % 2 == 0, "\tasync  ").otherwise(""), F.lit("def fresh_"), k, F.lit("(a):\r\n+\t_hidden_"), k, F.lit(": int = 1\n+  old_name = 2\n+call(x) == 3\n-def gone(): pass\n context = 1\n+\n"))
    return t.part.select(F.concat(F.lit("t"), k).alias("task_id"), diff.alias("diff"))


@Q.add(f"WITH {DIFF} SELECT task_id, n AS name, n LIKE '\\_%' ESCAPE '\\' AS private FROM (SELECT task_id, unnest(CASE WHEN p_size % 2 = 0 THEN ['_hidden_' || k] ELSE ['fresh_' || k, '_hidden_' || k] END || CASE WHEN p_size % 2 = 0 THEN ['fresh_' || k] ELSE [] END) AS n, k FROM d) AS v WHERE NOT (k % 3 = 0 AND n LIKE 'fresh%')")
def q55_novel_names(t: Tables):
    """Names that added lines define (tabs and async before them, annotations behind), but for those that the base tree has."""
    base = t.part.select(F.concat(F.lit("t"), _s("p_partkey")).alias("task_id"), F.explode(F.array(F.lit("old_name"), F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("fresh_"), _s("p_partkey"))).otherwise("x"))).alias("name"))
    return texts.novel_names(_diffs(t), base)


@Q.add(f"WITH {DIFF} SELECT task_id, k % 5 <> 0 AND k % 4 <> 1 AS clean, CASE WHEN k % 4 = 1 THEN 'call ( x ) =' ELSE '' END AS copied, CASE WHEN k % 5 = 0 THEN '_hidden_' || k ELSE '' END AS private_names, CASE WHEN k % 2 = 0 AND k % 3 <> 0 THEN 'fresh_' || k ELSE '' END AS public_names FROM d")
def q134_leak_verdicts(t: Tables):
    k = F.col("p_partkey")
    said = F.concat(F.lit("Make it work. "), F.when(k % 4 == 1, "Do CALL ( x ) == 3 first. ").otherwise(""), F.when(k % 5 == 0, F.concat(F.lit("Set _hidden_"), _s(k), F.lit(". "))).otherwise(""), F.when(k % 2 == 0, F.concat(F.lit("Add `fresh_"), _s(k), F.lit("`; not fresh_"), _s(k), F.lit("x. "))).otherwise(""))
    task = F.concat(F.lit("t"), _s(k)).alias("task_id")
    base = t.part.where("p_partkey % 3 = 0").select(task, F.concat(F.lit("fresh_"), _s(k)).alias("name"))
    out = texts.leak_verdict(t.part.select(task, said.alias("text")), _diffs(t), base)
    return out.select("task_id", "clean", F.array_join("copied_spans", ",").alias("copied"), F.array_join("private_names", ",").alias("private_names"), F.array_join("public_names", ",").alias("public_names"))


@Q.add("""WITH k AS (SELECT DISTINCT 'src/' || split_part(p_name, ' ', 1) || '/' || split_part(p_name, ' ', 2) || CASE p_size % 3 WHEN 0 THEN '/__init__.py' WHEN 1 THEN '.py' ELSE '.md' END AS path, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b, p_size % 3 AS e FROM part) SELECT path, CASE WHEN e = 2 THEN path WHEN path = 'src/red/ring.py' THEN 'red.ring' ELSE a || '.' || b END AS module FROM k UNION ALL SELECT 'lib/x/y.py', 'lib.x.y' UNION ALL SELECT 'src/red/ring.py', 'red.ring' WHERE NOT EXISTS (SELECT 1 FROM k WHERE path = 'src/red/ring.py')""")
def q33_prefix_modules(t: Tables):
    """src/ is the prefix that the one known module shows."""
    path = F.concat(F.lit("src/"), F.replace("p_name", F.lit(" "), F.lit("/")), _pick(F.col("p_size") % 3, "/__init__.py", ".py", ".md"))
    paths = t.part.select(path.alias("path")).unionByName(t.spark.sql("SELECT 'lib/x/y.py' AS path UNION ALL SELECT 'src/red/ring.py'")).distinct()
    return history.prefix_modules(paths, t.spark.sql("SELECT 'src/red/ring.py' AS path, 'red.ring' AS module"))


RUST = 'use crate::net::m%d;\nuse std::fmt;\n\npub fn run%d(x: i32) -> i32 {\n    let s = "}{";\n    if x > 0 { return 1; }\n    x\n}\n\n#[test]\nfn checks%d() {\n    run%d(1);\n}\n'
TS = "import { a } from './net/m%d';\nconst q = require(\"left\");\nexport const f%d = async (x) => {\n  return x;\n};\nit('adds %d', () => {\n});\n"


@Q.add("""SELECT 'a/s' || s_suppkey || '.rs' AS path, kind, replace(name, '#', s_suppkey::VARCHAR) AS name, line, end_line, is_test FROM supplier, (VALUES ('import', 'crate::net::m#', 1, 1, false), ('import', 'std::fmt', 2, 2, false), ('function', 'run#', 4, 8, false), ('function', 'checks#', 11, 13, true)) AS v(kind, name, line, end_line, is_test) WHERE s_suppkey % 2 = 0
UNION ALL SELECT 'a/s' || s_suppkey || '.ts', kind, replace(name, '#', s_suppkey::VARCHAR), line, end_line, is_test FROM supplier, (VALUES ('import', './net/m#', 1, 1, false), ('import', 'left', 2, 2, false), ('function', 'f#', 3, 5, false), ('test', 'adds #', 6, 7, true)) AS v(kind, name, line, end_line, is_test) WHERE s_suppkey % 2 = 1""")
def q135_other_languages(t: Tables):
    return parse.parse_other(_other(t)).select("path", "kind", "name", "line", "end_line", "is_test")


def _other(t: Tables):
    s, even = F.col("s_suppkey"), F.col("s_suppkey") % 2 == 0
    code = F.when(even, F.format_string(RUST, s, s, s, s)).otherwise(F.format_string(TS, s, s, s))
    return t.supplier.select(F.concat(F.lit("a/s"), _s(s), F.when(even, ".rs").otherwise(".ts")).alias("path"), F.when(even, "rust").otherwise("typescript").alias("language"), code.alias("content"))


@Q.add("""SELECT 'a/s' || s_suppkey || CASE WHEN s_suppkey % 2 = 0 THEN '.rs' ELSE '.ts' END AS path, 'net/m' || s_suppkey AS wanted, CASE WHEN s_suppkey % 4 = 3 THEN 'm' || s_suppkey || '.x' WHEN s_suppkey % 4 = 1 THEN 'a/net/m' || s_suppkey || '.x' ELSE 'b/net/m' || s_suppkey || '.x' END AS target FROM supplier""")
def q136_suffix_imports(t: Tables):
    """A file beside the importer first, then equal stems, then path suffixes (the nearest, then the smallest path), then the last part alone."""
    m, r = F.concat(F.lit("m"), _s("s_suppkey"), F.lit(".x")), F.col("s_suppkey") % 4
    owned = t.supplier.select(F.explode(F.array_compact(F.array(F.when(r == 3, m), F.when(r == 1, F.concat(F.lit("net/"), m)), F.when(r == 1, F.concat(F.lit("a/net/"), m)), F.when(r % 2 == 0, F.concat(F.lit("c/net/"), m)), F.when(r % 2 == 0, F.concat(F.lit("b/net/"), m))))).alias("path"))
    rows = parse.parse_other(_other(t))
    return graph.suffix_import(parse.wanted_files(rows), owned)


@Q.add("""WITH f AS (SELECT p_partkey AS k, p_size AS body, p_partkey % 20 AS tests, least(p_size, p_partkey % 47) AS cov, p_partkey % 2 = 0 AS doc, p_partkey % 11 = 0 AS is_test, CASE WHEN p_partkey % 4 = 3 THEN 'class' ELSE 'function' END AS kind FROM part), r AS (SELECT *, round_even(least(1.0, cov / body), 3) AS ratio, kind = 'function' AND tests > 0 AND NOT is_test AS possible FROM f WHERE body > 0),
x AS (SELECT *, ratio * 0.35::DOUBLE + (CASE WHEN tests < 2 THEN 0.25 WHEN tests > 12 THEN 0.1 ELSE 1.0 - (tests - 2) / 10 * 0.5 END)::DOUBLE * 0.30::DOUBLE + least(1.0, body / 12.0)::DOUBLE * 0.20::DOUBLE + (CASE WHEN doc THEN 0.15 ELSE 0.0 END)::DOUBLE AS raw FROM r), y AS (SELECT *, raw::VARCHAR::DECIMAL(30, 20) * 10000 AS m, floor(raw::VARCHAR::DECIMAL(30, 20) * 10000) AS q FROM x)
SELECT k AS id, ratio, possible, possible AND tests BETWEEN 2 AND 12 AND doc AND ratio >= 0.6 AND body >= 4 AS ready, CASE WHEN possible THEN (q::BIGINT + CASE WHEN m - q > 0.5 OR m - q = 0.5 AND q::BIGINT % 2 = 1 THEN 1 ELSE 0 END) / 10000 ELSE 0.0 END::DOUBLE AS focus_score FROM y""")
def q23_focus_score(t: Tables):
    return _bands(t).select("id", "ratio", "possible", "ready", "focus_score")


def _bands(t: Tables):
    k, body = F.col("p_partkey"), F.col("p_size")
    rows = t.part.where("p_size > 0").select(k.alias("id"), F.when(k % 4 == 3, "class").otherwise("function").alias("kind"), (k % 20).alias("tests"), (k % 11 == 0).alias("is_test"), F.lit(12).alias("ceiling"), (k % 2 == 0).alias("has_docstring"), body.alias("body_lines"), N.coverage_ratio(F.least(body.cast("long"), k % 47), body).alias("ratio"))
    return coverage.band(rows)


@Q.add("""WITH f AS (SELECT p_partkey AS k, p_size AS body, p_partkey % 20 AS tests, round_even(least(1.0, least(p_size, p_partkey % 47) / p_size), 3) AS ratio, p_partkey % 4 <> 3 AND p_partkey % 20 > 0 AND p_partkey % 11 <> 0 AS possible FROM part WHERE p_size > 0)
SELECT count(*) AS symbols, count(*) FILTER (WHERE tests > 0) AS covered, round(avg(tests) FILTER (WHERE tests > 0), 6) AS tests_per_covered, 12 AS ceiling, count(*) FILTER (WHERE possible) AS possible, count(*) FILTER (WHERE possible AND tests BETWEEN 2 AND 12 AND k % 2 = 0 AND ratio >= 0.6 AND body >= 4) AS ready FROM f""")
def q137_coverage_statistics(t: Tables):
    return coverage.coverage_statistics(_bands(t)).withColumn("tests_per_covered", F.round("tests_per_covered", 6))


@Q.add(f"WITH {RUNS} SELECT user_id, failure_class, count(*) AS n FROM a GROUP BY ALL")
def q138_class_counts(t: Tables):
    return gates.class_counts(_runs(t)[1], ["user_id"])


@Q.add("""WITH c AS (SELECT event_type AS status, value > 30 AS grounded, (user_id % 10) / 10.0 AS coverage FROM events) SELECT status, count(*) AS cards, round(avg(coverage) FILTER (WHERE grounded), 6) AS mean_coverage FROM c GROUP BY 1""")
def q64_card_summary(t: Tables):
    cards = t.events.select(F.col("event_type").alias("status"), (F.col("value") > 30).alias("grounded"), ((F.col("user_id") % 10) / 10.0).alias("coverage"))
    return texts.card_summary(cards).withColumn("mean_coverage", F.round("mean_coverage", 6))


@Q.add("""SELECT 'c' || c_custkey AS capability, CASE WHEN c_custkey % 4 = 0 THEN 'not_collected' WHEN c_custkey % 3 <> 0 THEN 'available' WHEN c_nationkey > 0 THEN 'partial' ELSE 'unavailable' END AS status, CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE c_nationkey END AS count, CASE WHEN c_custkey % 3 = 0 THEN 'limit' END AS reason FROM customer""")
def q139_availability(t: Tables):
    k = F.col("c_custkey")
    return evidence.availability(t.customer.select(F.concat(F.lit("c"), _s(k)).alias("capability"), F.when(k % 4 != 0, F.col("c_nationkey")).alias("count"), F.when(k % 3 == 0, "limit").alias("reason")))


@Q.add("""WITH v AS (SELECT c_nationkey, CASE WHEN c_acctbal < 1000 THEN 'easy' WHEN c_acctbal < 6000 THEN 'medium' ELSE 'hard' END AS tier, CASE WHEN c_custkey % 3 = 0 THEN 'easy' WHEN c_custkey % 3 = 1 THEN 'medium' ELSE 'hard' END AS measured FROM customer) SELECT c_nationkey, count(*) FILTER (WHERE tier = 'easy') AS easy, count(*) FILTER (WHERE tier = 'medium') AS medium, count(*) FILTER (WHERE tier = 'hard') AS hard, count(*) FILTER (WHERE tier = measured) AS agreement FROM v GROUP BY 1""")
def q140_tier_spread(t: Tables):
    b = F.col("c_acctbal")
    rows = t.customer.select("c_nationkey", F.when(b < 1000, "easy").when(b < 6000, "medium").otherwise("hard").alias("tier"), _pick(F.col("c_custkey") % 3, "easy", "medium", "hard").alias("measured_tier"))
    return evidence.tier_spread(rows, ["c_nationkey"])


@Q.add("SELECT count(DISTINCT 'a' || o_custkey || '@' || o_custkey % 7) AS contributors, count(*) FILTER (WHERE o_custkey % 3 = 0) AS merges, count(*) AS commits FROM orders")
def q141_contributors(t: Tables):
    c = F.col("o_custkey")
    return history.contributors(t.orders.select(F.concat(F.lit("a"), _s(c)).alias("author_name"), _s(c % 7).alias("author_email"), (c % 3 == 0).alias("is_merge")))


@Q.add("SELECT p_type AS language, p_brand AS kind, count(*) AS n FROM part GROUP BY ALL")
def q142_language_counts(t: Tables):
    return evidence.language_counts(t.part.select(F.col("p_type").alias("language"), F.col("p_brand").alias("kind")))


@Q.add(f"""WITH {RUNS}, j AS (SELECT u.user_id, b2.status FROM (SELECT DISTINCT user_id FROM a) u CROSS JOIN (VALUES ('view'), ('click')) AS t(test_id) LEFT JOIN a b2 ON b2.user_id = u.user_id AND b2.test_id = t.test_id), g AS (SELECT user_id, count(*) FILTER (WHERE status IS NULL) AS missing, count(*) FILTER (WHERE status <> 'passed') AS failing FROM j GROUP BY 1) SELECT user_id, CASE WHEN missing > 0 THEN 'targets_not_collected' WHEN failing > 0 THEN 'targets_did_not_pass' END AS reason_code, missing + failing = 0 AS passed FROM g""")
def q143_pass_after(t: Tables):
    _, after = _runs(t)
    targets = after.select("user_id").distinct().crossJoin(t.spark.sql("SELECT * FROM VALUES ('view'), ('click') AS v(test_id)"))
    return gates.pass_after(after, targets, ["user_id"]).select("user_id", "reason_code", "passed")


@Q.add("""WITH f AS (SELECT user_id % 20 AS g, 't' || user_id AS test_id, event_type = 'error' AS bad FROM events) SELECT g AS pool, CASE WHEN count(*) FILTER (WHERE bad) > 0 THEN 'tests_disappeared' END AS reason_code, coalesce(array_to_string(list_slice(list_sort(list(DISTINCT test_id) FILTER (WHERE bad)), 1, 25), ','), '') AS tests FROM f GROUP BY 1""")
def q144_collateral_cap(t: Tables):
    """At most 25 of the tests that are gone, by name."""
    u = F.col("user_id")
    of = lambda df: df.select((u % 20).alias("pool"), F.concat(F.lit("t"), _s(u)).alias("test_id"), F.lit("passed").alias("status"), F.lit("passed").alias("failure_class")).distinct()
    lost = t.events.where("event_type = 'error'").select("user_id").distinct()
    after = of(t.events.join(lost, "user_id", "left_anti")).unionByName(t.events.select((u % 20).alias("pool")).distinct().select("pool", F.lit("anchor").alias("test_id"), F.lit("passed").alias("status"), F.lit("passed").alias("failure_class")))
    before = of(t.events).unionByName(after.where("test_id = 'anchor'"))
    return gates.collateral(before, after, ["pool"]).select("pool", "reason_code", F.array_join("tests", ",").alias("tests"))


@Q.add("""SELECT event_id, 'ran ' || event_type || ' in <time> and <time> at <addr> from <tmp> on <timestamp> in src/a' || user_id || '.py:<line>' AS scrubbed, left('KeyError: <path>/f' || user_id || ' at 0xADDR line N offline 12' || repeat('x', user_id % 300), 200) AS signature FROM events""")
def q145_scrub_and_signature(t: Tables):
    u = _s("user_id")
    said = F.concat(F.lit("  ran "), "event_type", F.lit(" in 1.25s and 30 ms at 0xdeadBEEF from /tmp/x"), u, F.lit("/y on 2024-01-02T03:04:05.678Z in src/a"), u, F.lit(".py:12:3 "))
    message = F.concat(F.lit("\n \tKeyError: /home/u-1/p.x/f"), u, F.lit(" at 0x1F line 12 offline 12"), F.repeat(F.lit("x"), (F.col("user_id") % 300).cast("int")), F.lit("\r\nsecond line 3\n"))
    return t.events.select("event_id", T.scrub(said).alias("scrubbed"), T.signature(message).alias("signature"))


@Q.add("""SELECT event_id, CASE event_type WHEN 'view' THEN 'infrastructure' WHEN 'click' THEN 'behavioral_exception' WHEN 'purchase' THEN 'assertion' ELSE 'behavioral_exception' END AS go_class, CASE event_type WHEN 'purchase' THEN 'assertion' WHEN 'signup' THEN 'infrastructure' ELSE 'behavioral_exception' END AS rust_class FROM events""")
def q146_go_and_rust_classes(t: Tables):
    from ..sources import reports

    e = F.col("event_type")
    go = F.when(e == "view", "x.go:3: Undefined: y, expected z").when(e == "click", "PANIC: got 3").when(e == "purchase", "Want 3").otherwise("odd")
    rust = F.when(e == "purchase", "thread panicked at assertion failed").when(e == "click", "thread panicked at src").when(e == "signup", "  ").otherwise("error")
    return t.events.select("event_id", reports.go_failure_class(go).alias("go_class"), reports.rust_failure_class(rust).alias("rust_class"))


@Q.add(f"WITH {DIFF} SELECT task_id, CASE WHEN p_size % 2 = 0 THEN 'async  ' ELSE '' END || 'def fresh_' || k || '(a):|_hidden_' || k || ': int = 1|old_name = 2|call(x) == 3' AS added FROM d")
def q147_added_lines(t: Tables):
    return _diffs(t).select("task_id", F.array_join(T.added_lines(F.col("diff")), "|").alias("added"))


@Q.add("""WITH v AS (SELECT p_partkey, p_size % 3 AS c, p_size % 4 AS m, p_partkey % 3 AS l FROM part), s AS (SELECT *, CASE WHEN c >= 2 THEN ['requires coordinated edits across ' || c || ' source files'] ELSE [] END || CASE WHEN m >= 2 THEN ['spans ' || m || ' modules, so the change cannot be reasoned about locally'] ELSE [] END || CASE WHEN l >= 1 THEN ['the repository defines ' || l || ' similarly named symbols elsewhere, so the right one has to be identified rather than searched for'] ELSE [] END || CASE WHEN l = 2 THEN ['touches 7 lines with 3 tests that must end up passing'] ELSE [] END AS said FROM v)
SELECT p_partkey, 'This task ' || CASE WHEN len(said) > 0 THEN array_to_string(list_slice(said, 1, 2), '; and it ') ELSE 'is a contained change verified by ' || (l + 1) || CASE WHEN l = 0 THEN ' test' ELSE ' tests' END END || '.' AS sentence FROM s""")
def q148_justification(t: Tables):
    rows = t.part.select("p_partkey", (F.col("p_size") % 3).alias("coordinated_change"), (F.col("p_size") % 4).alias("cross_module"), (F.col("p_partkey") % 3).alias("misleading_similarity"), F.lit(0).alias("business_logic"), F.lit(7).alias("churn"), (F.col("p_partkey") % 3 + 1).alias("verifiers"), F.array(*map(F.lit, rank.FACTORS)).alias("ranked"))
    return rows.select("p_partkey", rank.justification().alias("sentence"))


@Q.add("""SELECT event_id, CASE WHEN event_id % 6 < 4 THEN props END AS body FROM events""")
def q149_model_json(t: Tables):
    """Plain, fenced, inside prose, fenced inside prose; then an array and something cut short."""
    i, p = F.col("event_id") % 6, F.col("props")
    said = F.when(i == 0, p).when(i == 1, F.concat(F.lit("```json\n"), p, F.lit("\n```\n"))).when(i == 2, F.concat(F.lit("Here it is: "), p, F.lit(" as asked."))).when(i == 3, F.concat(F.lit("Sure.\n```\n"), p, F.lit("\n```"))).when(i == 4, F.concat(F.lit("["), F.lit("1, 2]"))).otherwise(F.substring(p, 1, 6))
    return t.events.select("event_id", T.strip_model_json(said).alias("body"))


@Q.add("""SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS types, array_to_string(list_slice(list_sort(list(DISTINCT event_id)), 1, 3), ',') AS first_ids, bool_or(value > 90) AS any_large, bool_and(value < 150) AS all_small FROM events GROUP BY 1""")
def q150_array_idioms(t: Tables):
    per = t.events.groupBy("user_id").agg(F.collect_list("event_type").alias("e"), F.collect_list("event_id").alias("i"), F.collect_list("value").alias("v"))
    return per.select("user_id", F.array_join(F.array_sort(F.array_distinct("e")), ",").alias("types"), F.array_join(F.slice(F.array_sort(F.array_distinct("i")), 1, 3).cast("array<string>"), ",").alias("first_ids"), F.exists("v", lambda x: x > 90).alias("any_large"), F.forall("v", lambda x: x < 150).alias("all_small"))


@Q.add("""SELECT p_partkey, 'CMD ["run","' || p_name || '","a\\"b"]' AS command, replace(lower(p_type), ' ', '-') || '-' || p_size || '.x' AS image FROM part""")
def q151_container_names(t: Tables):
    name = F.concat(F.lit("--"), F.upper("p_type"), F.lit(" / "), _s("p_size"), F.lit(".x.-"))
    return t.part.select("p_partkey", evidence.docker_command(F.array(F.lit("run"), F.col("p_name"), F.lit('a"b'))).alias("command"), evidence.image_name(name).alias("image"))


STUB = "CASE WHEN p_partkey % 2 = 0 THEN '    \"\"\"Doc.\"\"\"' || chr(10) ELSE '' END"


@Q.add(f"""SELECT 'a' || p_partkey || '.py' AS path, 'def f' || p_partkey || '(x):' || chr(10) || {STUB} || '    return None' || chr(10) || chr(10) || 'y = 1' || chr(10) AS stubbed,
'--- a/a' || p_partkey || '.py' || chr(10) || '+++ b/a' || p_partkey || '.py' || chr(10) || CASE WHEN p_partkey % 2 = 0 THEN '@@ -1,5 +1,6 @@' ELSE '@@ -1,4 +1,5 @@' END || chr(10) || ' def f' || p_partkey || '(x):' || chr(10) || CASE WHEN p_partkey % 2 = 0 THEN '     \"\"\"Doc.\"\"\"' || chr(10) ELSE '' END || '-    return None' || chr(10) || '+    z = x + ' || p_size || chr(10) || '+    return z' || chr(10) || ' ' || chr(10) || ' y = 1' || chr(10) AS diff FROM part""")
def q152_excised_python(t: Tables):
    """The stub and the unified diff back to the source."""
    k = _s("p_partkey")
    content = F.concat(F.lit("def f"), k, F.lit("(x):\n"), F.when(F.col("p_partkey") % 2 == 0, '    """Doc."""\n').otherwise(""), F.lit("    z = x + "), _s("p_size"), F.lit("\n    return z\n\ny = 1\n"))
    rows = t.part.select(F.concat(F.lit("a"), k, F.lit(".py")).alias("path"), F.lit("python").alias("language"), content.alias("content"), F.concat(F.lit("f"), k).alias("name"), F.lit(1).alias("line"))
    return rewrite.excise(rows).select("path", "stubbed", "diff")


@Q.add("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'fn f' || p_partkey || '(x: i32) -> i32 {' || chr(10) || '    todo!()' || chr(10) || '}' || chr(10) WHEN 1 THEN 'func f' || p_partkey || '(x int) int {' || chr(10) || '    panic("not implemented")' || chr(10) || '}' || chr(10) ELSE '  function f' || p_partkey || '(x) {' || chr(10) || '      throw new Error("Not implemented");' || chr(10) || '  }' || chr(10) END AS stubbed FROM part""")
def q153_excised_braces(t: Tables):
    r, k = F.col("p_partkey") % 3, _s("p_partkey")
    head = F.when(r == 0, F.concat(F.lit("fn f"), k, F.lit("(x: i32) -> i32 {"))).when(r == 1, F.concat(F.lit("func f"), k, F.lit("(x int) int {"))).otherwise(F.concat(F.lit("  function f"), k, F.lit("(x) {")))
    body = F.concat(head, F.lit('\n    // }\n    s = "}{";\n    if (x) { return 1; }\n'), F.when(r == 2, "  }\n").otherwise("}\n"))
    rows = t.part.select(F.concat(F.lit("a"), k).alias("path"), _pick(r, "rust", "go", "javascript").alias("language"), body.alias("content"), F.concat(F.lit("f"), k).alias("name"), F.lit(1).alias("line"), "p_partkey")
    return rewrite.excise(rows).select("p_partkey", "stubbed")


@Q.add("""SELECT 'pkg/a' || p_partkey || '.py' AS path, 'def _help_alt():' || chr(10) || '    return _const + my_help' || chr(10) || 'class _Box_alt: pass' || chr(10) || '_const = _help_alt()' || chr(10) AS content, true AS changed FROM part WHERE p_size % 4 <> 0 UNION ALL SELECT 'tests/a' || p_partkey || '.py', '_help()' || chr(10), false FROM part WHERE p_size % 4 = 0""")
def q154_renamed_internals(t: Tables):
    """Module-level private functions and classes get a suffix everywhere but in tests; assigned names stay."""
    test, k = F.col("p_size") % 4 == 0, _s("p_partkey")
    files = t.part.select(F.concat(F.when(test, "tests/a").otherwise("pkg/a"), k, F.lit(".py")).alias("path"), F.when(test, "_help()\n").otherwise("def _help():\n    return _const + my_help\nclass _Box: pass\n_const = _help()\n").alias("content"))
    return rewrite.rename_private(files, rewrite.private_symbols(files).select("name").distinct())


TESTS = "def helper():\n    return 1\n\n\nclass TestX:\n    def test_m(self):\n        assert %d\n\n\n@mark\ndef test_%d():\n    assert helper() == %d\n"


def _test_files(t: Tables, shift: int = 0):
    n = (F.col("p_size") % 5 + shift).cast("int")
    return t.part.select(F.concat(F.lit("t"), _s("p_partkey"), F.lit(".py")).alias("path"), F.format_string(TESTS, F.col("p_size") % 3, n, F.col("p_size") % 7).alias("content"), F.concat(F.lit("test_"), _s(n)).alias("test"), "p_size")


@Q.add("""SELECT 't' || p_partkey || '.py' AS path, v.name AS name, v.body AS body FROM part, LATERAL (SELECT unnest(['TestX.test_m', 'test_' || p_size % 5]) AS name, unnest(['def test_m(self):' || chr(10) || '    assert ' || p_size % 3, '@mark' || chr(10) || 'def test_' || p_size % 5 || '():' || chr(10) || '    assert helper() == ' || p_size % 7]) AS body) AS v""")
def q155_collected_tests(t: Tables):
    return parse.test_functions(_test_files(t))


@Q.add("""SELECT 't' || p_partkey || '.py' AS path, v.name AS name, v.change AS change FROM part, LATERAL (SELECT unnest(['test_' || p_size % 5, 'test_' || (p_size % 5 + 1)]) AS name, unnest(['removed', 'added']) AS change) AS v""")
def q156_test_delta(t: Tables):
    return parse.test_delta(parse.test_functions(_test_files(t)), parse.test_functions(_test_files(t, 1)))


@Q.add("""WITH m AS (SELECT p_partkey, p_size, 'def helper():' || chr(10) || '    raise RuntimeError(''__mutation__'')' || chr(10) || chr(10) || chr(10) || 'class TestX:' || chr(10) || '    def test_m(self):' || chr(10) AS a FROM part) SELECT 't' || p_partkey || '.py' AS path, a || CASE WHEN p_size % 2 = 0 THEN '        raise RuntimeError(''__mutation__'')' ELSE '        assert ' || p_size % 3 END || chr(10) || chr(10) || chr(10) || '@mark' || chr(10) || 'def test_' || p_size % 5 || '():' || chr(10) || '    assert helper() == ' || p_size % 7 || chr(10) AS mutated FROM m""")
def q157_mutated_bodies(t: Tables):
    lines = F.when(F.col("p_size") % 2 == 0, F.array(F.lit(1), F.lit(6))).otherwise(F.array(F.lit(1), F.lit(10)))
    return rewrite.mutate(_test_files(t).select("path", "content", lines.alias("lines")))


@Q.add("""WITH k AS (SELECT p_partkey, p_size, 'def helper():' || chr(10) || '    return 1' || chr(10) || chr(10) || chr(10) || 'class TestX:' || chr(10) || '    def test_m(self):' || chr(10) || '        assert ' || p_size % 3 || chr(10) || chr(10) || chr(10) AS a FROM part) SELECT 't' || p_partkey || '.py' AS path, a || CASE WHEN p_size % 2 = 0 THEN '' ELSE '@mark' || chr(10) || 'def test_' || p_size % 5 || '():' || chr(10) || '    assert helper() == ' || p_size % 7 || chr(10) END AS content FROM k""")
def q158_pruned_tests(t: Tables):
    """The failing module-level test goes with its decorator; methods stay whatever their names."""
    failing = F.when(F.col("p_size") % 2 == 0, F.array("test", F.lit("test_m"))).otherwise(F.array(F.lit("test_m")))
    return rewrite.prune(_test_files(t).select("path", "content", failing.alias("failing")))


@Q.add("""SELECT DISTINCT unnest(['helper', 'TestX', 'test_m', 'test_' || p_size % 5]) AS name FROM part""")
def q159_base_names(t: Tables):
    return rewrite.base_names(_test_files(t))


@Q.add("""WITH f AS (SELECT p_type, 'm' || p_partkey || '.py' AS path, repeat('x', 1 + p_size) AS content FROM part), r AS (SELECT *, sum(length(content)) OVER (PARTITION BY p_type ORDER BY path ROWS UNBOUNDED PRECEDING) - length(content) AS before FROM f) SELECT p_type, md5(string_agg(content, chr(10) ORDER BY path)) AS text_md5, sum(length(content))::BIGINT AS chars FROM r WHERE before <= 500 GROUP BY 1""")
def q160_base_text(t: Tables):
    files = t.part.select("p_type", F.concat(F.lit("m"), _s("p_partkey"), F.lit(".py")).alias("path"), F.repeat(F.lit("x"), F.col("p_size") + 1).alias("content"))
    out = rewrite.base_text(files, ("p_type",), 500)
    return out.select("p_type", F.md5("text").alias("text_md5"), F.length(F.replace("text", F.lit("\n"), F.lit(""))).cast("long").alias("chars"))


@Q.add("""WITH b AS (SELECT user_id, event_type, (CASE event_type WHEN 'error' THEN 1 WHEN 'view' THEN 2 ELSE 3 END) AS o, array_to_string(list_sort(list('e' || event_id)), chr(10)) AS lines FROM events WHERE event_type IN ('error', 'view', 'click') GROUP BY ALL) SELECT user_id, 'Be brief.' AS system, md5(string_agg('# ' || event_type || chr(10) || left(lines, 40), chr(10) || chr(10) ORDER BY o)) AS user_md5 FROM b GROUP BY 1""")
def q161_messages(t: Tables):
    e = F.col("event_type")
    blocks = t.events.where(e.isin("error", "view", "click")).groupBy(F.col("user_id").alias("subject"), e.alias("title")).agg(F.sort_array(F.collect_list(F.concat(F.lit("e"), _s("event_id")))).alias("lines"))
    blocks = blocks.withColumn("ordinal", F.when(F.col("title") == "error", 1).when(F.col("title") == "view", 2).otherwise(3))
    m = evidence.messages(blocks, "Be brief.", 40)
    return m.select(F.col("subject").alias("user_id"), F.col("messages")[0]["content"].alias("system"), F.md5(F.col("messages")[1]["content"]).alias("user_md5"))


@Q.add("""WITH u AS (SELECT user_id, event_type, count(*) AS units FROM events GROUP BY ALL), s AS (SELECT *, least(units, 2) AS shown, CASE event_type WHEN 'error' THEN 1 ELSE 2 END AS priority FROM u WHERE event_type IN ('error', 'view')), e AS (SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) - 1 AS n FROM events), b AS (SELECT user_id, event_type, priority, '## ' || event_type || CASE WHEN shown < units THEN '  (' || shown || ' of ' || units || ' shown)' ELSE '' END || chr(10) || string_agg('u' || event_id, chr(10) ORDER BY n) AS block FROM s JOIN e USING (user_id, event_type) WHERE n < shown GROUP BY user_id, event_type, priority, shown, units) SELECT user_id, md5(string_agg(block, chr(10) || chr(10) ORDER BY priority)) AS text_md5 FROM b GROUP BY 1""")
def q162_rendered_cards(t: Tables):
    from pyspark.sql import Window

    some = t.events.where(F.col("event_type").isin("error", "view"))
    units = some.select(F.col("user_id").alias("subject"), F.col("event_type").alias("section"), (F.row_number().over(Window.partitionBy("user_id", "event_type").orderBy("event_id")) - 1).alias("ordinal"), F.concat(F.lit("u"), _s("event_id")).alias("unit"))
    sections = some.groupBy(F.col("user_id").alias("subject"), F.col("event_type").alias("section")).agg(F.count(F.lit(1)).alias("units")).withColumns({"shown": F.least(F.col("units"), F.lit(2)), "priority": F.when(F.col("section") == "error", 1).otherwise(2)})
    return evidence.render_cards(units, sections).select(F.col("subject").alias("user_id"), F.md5("text").alias("text_md5"))
