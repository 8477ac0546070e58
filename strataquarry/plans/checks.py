"""Graphs held against their source: anchors, relative imports, components and depth, over rows made from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.lineage import cut
from ..operators import anchors, graph, parse
from .intake import _s
from .structure import TREE, _parsed
from .tables import Catalogue, Tables

Q = Catalogue()

# Symbols of the tree of one module a supplier (id, first and last line), and the anchors that an out-of-date graph claims for them.
OWN = f"""{TREE}, own AS (SELECT s, path, path || '::' || module || x AS id, a AS line, b AS end_line FROM t, LATERAL (SELECT unnest(['', '.C' || s, '.C' || s || '.run', '.f' || s]) AS x, unnest([1, 6, 9, 13]) AS a, unnest([1, 10, 10, 14]) AS b) AS l),
claimed AS (SELECT s, CASE WHEN s % 13 = 5 THEN 'gone/' || path ELSE path END AS path, id, CASE WHEN s % 7 = 0 THEN line + 10 WHEN s % 11 = 0 THEN 0 ELSE line END AS line, CASE WHEN s % 7 = 0 THEN end_line + 10 WHEN s % 5 = 0 THEN end_line - 1 ELSE end_line END AS end_line FROM own)"""


def _claimed(t: Tables):
    """The parsed tree and its symbols as a graph of another state would place them."""
    files, p = _parsed(t)
    s = F.regexp_extract("path", r"m(\d+)\.py$", 1).cast("int")
    own = p["symbols"].where(F.col("path").rlike(r"m\d+\.py$")).withColumn("s", s)
    line = F.when(F.col("s") % 7 == 0, F.col("line") + 10).when(F.col("s") % 11 == 0, 0).otherwise(F.col("line"))
    end_line = F.when(F.col("s") % 7 == 0, F.col("end_line") + 10).when(F.col("s") % 5 == 0, F.col("end_line") - 1).otherwise(F.col("end_line"))
    path = F.when(F.col("s") % 13 == 5, F.concat(F.lit("gone/"), F.col("path"))).otherwise(F.col("path"))
    return files, own.select("id", path.alias("path"), line.alias("line"), end_line.alias("end_line"))


@Q.add(f"""WITH {OWN} SELECT id, line, end_line, reason IS NULL AS valid, reason FROM (SELECT *, CASE WHEN line < 1 THEN 'before_first_line' WHEN s % 13 = 5 AND line > 1 THEN 'no_such_file' WHEN line > 14 THEN 'after_last_line' WHEN end_line < line THEN 'ends_before_it_begins' END AS reason FROM claimed)""")
def q163_anchor_lines(t: Tables):
    """A module of 14 lines; a claimed file that is not there holds line 1 only."""
    files, claimed = _claimed(t)
    return anchors.check_lines(claimed, files).select("id", "line", "end_line", "valid", "reason")


SPANS = r"""d AS (SELECT doc_id, regexp_split_to_array(text, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]') AS l FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, name, 1 + doc_id % 9 AS line, doc_id % 9 + doc_id % 23 AS end_line, l FROM d, (VALUES ('tion'), ('SELECT'), ('er th')) AS v(name)), c AS (SELECT doc_id, name, line, end_line, len(list_filter(list_slice(l, line, end_line), lambda x: contains(x, name))) > 0 AS valid FROM s)"""


def _spans(t: Tables):
    files = t.documents.where("text is not null").select(F.concat(F.lit("d"), _s("doc_id")).alias("path"), F.col("text").alias("content"))
    rows = t.documents.where("text is not null").select("doc_id", F.concat(F.lit("d"), _s("doc_id")).alias("path"), F.explode(F.array(*map(F.lit, ("tion", "SELECT", "er th")))).alias("name"), (F.col("doc_id") % 9 + 1).cast("int").alias("line"), (F.col("doc_id") % 9 + F.col("doc_id") % 23).cast("int").alias("end_line"))
    return anchors.check_names(rows, files)


@Q.add(f"WITH {SPANS} SELECT doc_id, name, valid, CASE WHEN valid THEN NULL WHEN end_line < line THEN 'no_span' ELSE 'name_not_in_span' END AS reason FROM c")
def q164_anchor_names(t: Tables):
    """Every document as a file: does a line of the span that a symbol claims hold its name?"""
    return _spans(t).select("doc_id", "name", "valid", "reason")


@Q.add(f"WITH {SPANS} SELECT count(*) AS anchors_checked, count(*) FILTER (WHERE valid) AS anchors_valid, count(*) FILTER (WHERE valid) / count(*) AS anchor_rate FROM c")
def q165_anchor_rate(t: Tables):
    return anchors.anchor_rate(_spans(t))


@Q.add(f"""WITH {TREE}, n AS (SELECT count(*) AS n, count(*) FILTER (WHERE s % 2 = 0) AS even, count(*) FILTER (WHERE s % 10 = 3) AS lost FROM t), e AS (SELECT *, 7 * n + 1 + even AS edges, 4 * n + 3 AS symbols FROM n)
SELECT edges AS edges_total, edges - 7 * lost AS edges_matched, 0 AS edges_only_again, (edges - 7 * lost) / edges AS edge_rate, symbols AS symbols_total, symbols - 4 * lost AS symbols_matched, 0 AS symbols_only_again, (symbols - 4 * lost) / symbols AS symbol_rate, symbols AS anchors_checked, symbols AS anchors_valid, 1.0::DOUBLE AS anchor_rate, CASE WHEN lost = 0 THEN 'verified' ELSE 'mismatched' END AS status FROM e""")
def q166_graph_verified(t: Tables):
    """A graph against what is left of it when every tenth module is gone from the source."""
    files, p = _parsed(t)
    edges = cut(graph.build(files, p["symbols"], p["imports"], p["calls"])[0])
    here = ~F.col("path").rlike(r"m\d*3\.py$")
    symbols = p["symbols"].select("*", F.lit(0).alias("column"), F.lit(0).alias("end_column")) if "column" not in p["symbols"].columns else p["symbols"]
    return anchors.verify(edges, edges.where(here), symbols, symbols.where(here), anchors.check_lines(symbols, files))


IMPORTS = """i AS (SELECT s_suppkey AS s, 'web/a' || s_suppkey % 7 AS folder, 'web/a' || s_suppkey % 7 || '/main' || s_suppkey || '.ts' AS path, 'm' || s_suppkey % 40 AS bare, CASE s_suppkey % 4 WHEN 0 THEN './m' WHEN 1 THEN '../m' WHEN 2 THEN '../../api/m' ELSE 'lib/m' END || s_suppkey % 40 AS name FROM supplier),
w AS (SELECT *, regexp_replace(name, '^(\\.{1,2}/)+', '') AS wanted, CASE WHEN name LIKE '.%' THEN folder || '/' || regexp_replace(name, '^(\\.{1,2}/)+', '') END AS beside, CASE s % 4 WHEN 0 THEN folder || '/' || bare WHEN 1 THEN 'web/' || bare WHEN 2 THEN 'api/' || bare END AS folded FROM i),
o AS (SELECT 'web/a' || (s_suppkey * 3) % 7 || '/m' || s_suppkey % 40 || '.ts' AS owned FROM supplier WHERE s_suppkey % 2 = 0 UNION SELECT 'web/m' || s_suppkey % 40 || '.js' FROM supplier WHERE s_suppkey % 3 = 0 UNION SELECT 'api/m' || s_suppkey % 40 || '.ts' FROM supplier WHERE s_suppkey % 5 < 2 UNION SELECT 'api/lib/m' || s_suppkey % 40 || '.ts' FROM supplier WHERE s_suppkey % 7 < 2 UNION SELECT 'web/a3/lib/m' || s_suppkey % 40 || '.ts' FROM supplier WHERE s_suppkey % 11 < 4)""".replace("\\\\", "\\")


@Q.add(f"""WITH {IMPORTS}, h AS (SELECT path, wanted, owned, stem, string_split(folder, '/') AS a, list_slice(string_split(owned, '/'), 1, -2) AS b, CASE WHEN stem = beside THEN 0 WHEN stem = folded THEN 2 WHEN ends_with(stem, '/' || beside) THEN 3 WHEN stem = wanted THEN 6 WHEN ends_with(stem, '/' || wanted) THEN 9 WHEN string_split(stem, '/')[-1] = string_split(wanted, '/')[-1] THEN 10 END AS way FROM w, (SELECT owned, regexp_replace(owned, '\\.[^./]+$', '') AS stem FROM o)),
r AS (SELECT *, len(list_filter(range(1, least(len(a), len(b)) + 1), lambda n: a[1:n] = b[1:n])) AS near FROM h WHERE way IS NOT NULL) SELECT path, wanted, first(owned ORDER BY way, near DESC, owned) AS target FROM r GROUP BY ALL""".replace("'\\\\.", "'\\."))
def q167_relative_imports(t: Tables):
    """`./`, `../` and bare imports against files that stand beside the importer, where the dots lead, and elsewhere."""
    s, n = F.col("s_suppkey"), F.concat(F.lit("m"), _s(F.col("s_suppkey") % 40))
    name = F.concat(F.when(s % 4 == 0, "./").when(s % 4 == 1, "../").when(s % 4 == 2, "../../api/").otherwise("lib/"), n)
    rows = t.supplier.select(F.concat(F.lit("web/a"), _s(s % 7), F.lit("/main"), _s(s), F.lit(".ts")).alias("path"), F.lit("import").alias("kind"), name.alias("name"))
    some = [(s % 2 == 0, F.concat(F.lit("web/a"), _s(s * 3 % 7), F.lit("/"), n, F.lit(".ts"))), (s % 3 == 0, F.concat(F.lit("web/"), n, F.lit(".js"))), (s % 5 < 2, F.concat(F.lit("api/"), n, F.lit(".ts"))), (s % 7 < 2, F.concat(F.lit("api/lib/"), n, F.lit(".ts"))), (s % 11 < 4, F.concat(F.lit("web/a3/lib/"), n, F.lit(".ts")))]
    owned = t.supplier.select(F.explode(F.array_compact(F.array(*(F.when(c, x) for c, x in some)))).alias("path")).distinct()
    return graph.suffix_import(parse.wanted_files(rows), owned)


@Q.add("""WITH RECURSIVE e AS (SELECT p_partkey AS s, p_partkey // 2 AS t FROM part UNION SELECT p_partkey, (p_partkey + 1) % 30 FROM part WHERE p_partkey < 30 UNION SELECT p_partkey, p_partkey + 3 FROM part WHERE p_partkey BETWEEN 60 AND 90 UNION SELECT p_partkey, p_partkey - 6 FROM part WHERE p_partkey BETWEEN 70 AND 93),
r AS (SELECT s, t FROM e WHERE s < 200 UNION SELECT r.s, e.t FROM r JOIN e ON e.s = r.t), m AS (SELECT a.s AS node, min(a.t) AS component FROM r AS a JOIN r AS b ON a.s = b.t AND a.t = b.s GROUP BY 1) SELECT node, component, count(*) OVER (PARTITION BY component) AS size FROM m""")
def q168_components(t: Tables):
    """Rings that share nodes, strands into and out of them, and a loop, by their smallest node."""
    k = F.col("p_partkey")
    way = lambda where, to: t.part.where(where).select(k.alias("source"), to.alias("target"))
    edges = way("true", F.expr("p_partkey div 2")).unionByName(way("p_partkey < 30", (k + 1) % 30)).unionByName(way("p_partkey between 60 and 90", k + 3)).unionByName(way("p_partkey between 70 and 93", k - 6))
    return graph.components(edges)


@Q.add("""WITH RECURSIVE e AS (SELECT p_partkey AS s, CASE WHEN p_partkey % 50 = 1 THEN p_partkey // 5 ELSE p_partkey - 1 END AS t FROM part WHERE p_partkey > 1 UNION SELECT p_partkey, p_partkey // 7 FROM part WHERE p_partkey % 25 = 1 AND p_partkey > 7), r AS (SELECT DISTINCT p_partkey AS s, 0 AS d FROM part UNION SELECT e.s, r.d + 1 FROM r JOIN e ON e.t = r.s) SELECT s AS node, max(d)::INTEGER AS wave FROM r GROUP BY 1""")
def q169_branching_waves(t: Tables):
    """Strands of fifty nodes that begin, and fork in the middle, at nodes of other strands: the longest way down counts."""
    k = F.col("p_partkey")
    one = t.part.where("p_partkey > 1").select(k.alias("source"), F.when(k % 50 == 1, F.expr("p_partkey div 5")).otherwise(k - 1).alias("target"))
    two = t.part.where("p_partkey % 25 = 1 and p_partkey > 7").select(k.alias("source"), F.expr("p_partkey div 7").alias("target"))
    return graph.waves(t.part.select(k.alias("node")), one.unionByName(two))
