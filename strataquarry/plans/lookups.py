"""Lookups, searches and logs: table versions, split exports, indexed search, windows, links, ownership."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.lineage import scratch
from ..operators import coverage, evidence, graph, history, rewrite, search, texts
from ..sources import records
from ..sources.table_log import Conflict, TableLog
from .intake import NUL, _s
from .structure import TREE, _parsed
from .tables import Catalogue, Tables

Q = Catalogue()


@Q.add("""WITH c AS (SELECT c_custkey AS k, c_nationkey AS n FROM customer) SELECT 1 AS version, count(*) AS n, coalesce(sum(k), 0)::BIGINT AS total FROM c WHERE n < 10 UNION ALL SELECT 2, count(*), coalesce(sum(k), 0)::BIGINT FROM c WHERE n < 20
UNION ALL SELECT 3, count(*), coalesce(sum(k), 0)::BIGINT FROM c WHERE n >= 5""")
def q170_table_versions(t: Tables):
    """Two batches, the second one twice; a table made from the second version; a writer that still holds the first is refused."""
    rows = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("n"))
    table = TableLog(t.spark, f"{scratch(t.spark)}/customers")
    table.append(rows.where("n < 10"), "loader", 0)
    for _ in range(2):
        table.append(rows.where("n between 10 and 19"), "loader", 1)
    table.publish(rows.where("n >= 5"), expect=2)
    try:
        table.publish(rows.where("n = 0"), expect=1)
        raise AssertionError("a stale writer replaced the table")
    except Conflict:
        pass
    out = None
    for v in table.versions():
        one = table.read(v).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("total")).select(F.lit(v).alias("version"), "n", "total")
        out = one if out is None else out.unionByName(one)
    return out


@Q.add("""WITH l AS (SELECT l_orderkey, count(*) AS files, sum(l_linenumber)::BIGINT AS additions FROM lineitem GROUP BY 1) SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS ordinal, 's' || o_orderkey AS sha, 'subject ' || o_orderkey AS subject, coalesce(files, 0) AS files, coalesce(additions, 0) AS additions FROM orders LEFT JOIN l ON l_orderkey = o_orderkey""")
def q171_commit_export(t: Tables):
    """Every order as a commit of an export in several files, written in the order of keys and read back."""
    line = F.concat_ws("\t", _s("l_linenumber"), F.lit("0"), F.concat(F.lit("f"), _s("l_partkey")))
    stat = t.lineitem.groupBy("l_orderkey").agg(F.concat(F.array_join(F.collect_list(line), NUL), F.lit(NUL)).alias("numstat"))
    fields = [F.concat(F.lit("s"), _s("o_orderkey")), *map(F.lit, ("", "A", "a@x", "t", "C", "", "t", "")), F.concat(F.lit("subject "), _s("o_orderkey")), F.lit("two\nlines\n"), F.coalesce("numstat", F.lit(""))]
    export = t.orders.join(stat, F.col("l_orderkey") == F.col("o_orderkey"), "left").repartitionByRange(4, "o_orderkey").sortWithinPartitions("o_orderkey")
    path = scratch(t.spark)
    export.select(F.concat_ws(NUL, *fields).alias("value")).write.option("lineSep", records.RECORD_MARK).text(path)
    return records.read_commits(t.spark, path).select("ordinal", "sha", "subject", F.size("changed_files").cast("long").alias("files"), "additions")


def _documents(t: Tables):
    return t.documents.select(F.concat_ws("/", F.coalesce("lang", F.lit("none")), F.coalesce("source", F.lit("none")), _s("doc_id")).alias("path"), F.col("text").alias("content"))


def _index(t: Tables):
    path = scratch(t.spark)
    search.write_index(_documents(t), path)
    return search.read_index(t.spark, path)


PATH = "concat_ws('/', coalesce(lang, 'none'), coalesce(source, 'none'), doc_id) AS path"


@Q.add(f"SELECT path, line, x AS text FROM (SELECT {PATH}, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents) WHERE regexp_matches(x, 'example\\.(com|org)')")
def q172_indexed_search(t: Tables):
    """Every matching line of every document; the trigrams of `example.` pick the documents that the pattern reads."""
    return search.search(_documents(t), _index(t), r"example\.(com|org)").select("path", F.col("line").cast("long").alias("line"), "text")


@Q.add("SELECT count(*) AS files, count(*) FILTER (WHERE contains(text, 'exa') AND contains(text, 'xam') AND contains(text, 'amp') AND contains(text, 'mpl') AND contains(text, 'ple') AND contains(text, 'le.')) AS files_read, count(*) FILTER (WHERE regexp_matches(text, 'example\\.(com|org)')) AS files_hit FROM documents")
def q173_search_cost(t: Tables):
    return search.search_cost(_documents(t), _index(t), r"example\.(com|org)")


@Q.add(f"""WITH d AS (SELECT {PATH}, text, string_split(text, chr(10)) AS l, doc_id % 5 + 1 AS start FROM documents WHERE text IS NOT NULL) SELECT path, start, substring(array_to_string(list_slice(l, start, start + 9), chr(10)), 1, 400) AS text, least(start + 9, len(l)) AS "end", len(l) AS "of", least(start + 9, len(l)) < len(l) OR length(array_to_string(list_slice(l, start, start + 9), chr(10))) > 400 AS truncated FROM d""")
def q174_windows(t: Tables):
    """Ten lines of every document from one of its first five, at most 400 characters."""
    files = t.documents.where("text is not null")
    requests = files.select(F.concat_ws("/", F.coalesce("lang", F.lit("none")), F.coalesce("source", F.lit("none")), _s("doc_id")).alias("path"), (F.col("doc_id") % 5 + 1).alias("start"))
    return texts.read_windows(_documents(t), requests, 10, 400)


@Q.add("SELECT DISTINCT coalesce(source, 'none') || '/' AS name FROM documents WHERE lang = 'en' ORDER BY name LIMIT 200")
def q175_listed_folder(t: Tables):
    return texts.list_dir(_documents(t), "en")


@Q.add(f"WITH {TREE} SELECT 'calls' AS kind, path || '::' || module || '.C' || s || '.run' AS source, path, 10 AS line FROM t WHERE h = 1 ORDER BY path, line")
def q176_callers(t: Tables):
    files, p = _parsed(t)
    return evidence.callers_of(graph.build(files, p["symbols"], p["imports"], p["calls"])[0], "pkg/m1.py::pkg.m1.f1").select("kind", "source", "path", "line")


@Q.add(f"WITH {TREE}, w AS (SELECT DISTINCT c_custkey % 120 AS s FROM customer) SELECT 'pkg/m' || w.s || '.py::pkg.m' || w.s || '.C' || w.s || '.run' AS id, module FROM w LEFT JOIN t USING (s)")
def q177_modules_of_symbols(t: Tables):
    files, p = _parsed(t)
    n = _s(F.col("c_custkey") % 120)
    wanted = t.customer.select(F.concat(F.lit("pkg/m"), n, F.lit(".py::pkg.m"), n, F.lit(".C"), n, F.lit(".run")).alias("id"))
    return evidence.module_of_symbol(p["symbols"], files, wanted)


@Q.add("""WITH c AS (SELECT 's' || o_orderkey AS sha, o_orderkey % 5 AS way, o_custkey AS n FROM orders), p AS (SELECT c_custkey AS number, 's' || c_custkey * 2 AS merge_sha, c_nationkey % 2 = 0 AS merged FROM customer WHERE c_custkey % 9 > 0), e AS (SELECT sha AS commit_sha, number AS pr_number FROM p JOIN c ON sha = merge_sha WHERE merged)
SELECT *, 'github_merge_sha' AS method FROM e UNION ALL SELECT sha, n, 'commit_message' FROM c SEMI JOIN p ON n = number WHERE way < 2 AND NOT EXISTS (SELECT 1 FROM e WHERE commit_sha = sha AND pr_number = n)""")
def q178_linked_pull_requests(t: Tables):
    way, n = F.col("o_orderkey") % 5, _s("o_custkey")
    subject = F.when(way == 0, F.concat(F.lit("Merge pull request #"), n, F.lit(" from x/y"))).otherwise("tidy up #1x")
    body = F.when(way == 1, F.concat(F.lit("first line (#"), n, F.lit(") \nlast line"))).when(way == 2, F.concat(F.lit("see (#"), n, F.lit(") too")))
    commits = t.orders.select(F.concat(F.lit("s"), _s("o_orderkey")).alias("sha"), subject.alias("subject"), body.alias("body"))
    pulls = t.customer.where("c_custkey % 9 > 0").select(F.col("c_custkey").alias("number"), F.when(F.col("c_nationkey") % 2 == 0, "t").alias("merged_at"), F.concat(F.lit("s"), _s(F.col("c_custkey") * 2)).alias("merge_commit_sha"))
    return history.link_pull_requests(commits, pulls)


@Q.add("""SELECT event_id, CASE WHEN event_id % 7 > 0 THEN sha256('{"a":[1,{"x":null,"y":"' || event_type || '"}],"b":' || event_id || '}') END AS sha FROM events""")
def q179_canonical_digests(t: Tables):
    """Keys in another order and blanks make no difference; what does not parse has no digest."""
    text = F.when(F.col("event_id") % 7 > 0, F.concat(F.lit('{ "b" : '), _s("event_id"), F.lit(', "a":[1, {"y": "'), "event_type", F.lit('", "x" :null} ]}\n'))).otherwise('{"b": ')
    return t.events.select("event_id", rewrite.canonical_sha(text).alias("sha"))


SYMBOLS = (("module", 1, 50, "outer"), ("class", 5, 40, "K"), ("method", 10, 20, "K.m"), ("function", 18, 20, "K.m.inner"), ("function", 42, 45, "f"))
OWNED = "o AS (SELECT 'p' || l_partkey % 50 || CASE WHEN l_quantity BETWEEN 18 AND 20 THEN '::K.m.inner' WHEN l_quantity BETWEEN 10 AND 17 THEN '::K.m' WHEN l_quantity BETWEEN 5 AND 40 THEN '::K' WHEN l_quantity BETWEEN 42 AND 45 THEN '::f' END AS id, l_quantity::BIGINT AS line, l_suppkey AS test_id FROM lineitem)"


def _ownership(t: Tables):
    """Five spans in each of fifty files, and one covered line a line item."""
    path = F.concat(F.lit("p"), _s(F.col("p_partkey") % 50))
    spans = F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(a).alias("line"), F.lit(b).alias("end_line"), F.lit(n).alias("qualified_name"), F.lit(i).alias("ordinal")) for i, (k, a, b, n) in enumerate(SYMBOLS)))
    symbols = t.part.select(path.alias("path")).distinct().select("path", F.explode(spans).alias("s")).select("path", F.concat_ws("::", "path", "s.qualified_name").alias("id"), "s.*", F.lit("says").alias("docstring"), F.lit(False).alias("is_test"))
    lines = t.lineitem.select(F.concat(F.lit("p"), _s(F.col("l_partkey") % 50)).alias("path"), F.col("l_quantity").cast("int").alias("line"), _s("l_suppkey").alias("test_id"))
    return lines, symbols


@Q.add(f"WITH {OWNED} SELECT id AS symbol_id, line, count(*) AS hits, count(DISTINCT test_id) AS tests FROM o WHERE id IS NOT NULL GROUP BY 1, 2")
def q180_owned_lines(t: Tables):
    return coverage.attribute(*_ownership(t)).groupBy("symbol_id", F.col("line").cast("long").alias("line")).agg(F.count(F.lit(1)).alias("hits"), F.count_distinct("test_id").alias("tests"))


@Q.add(f"""WITH {OWNED}, f AS (SELECT DISTINCT 'p' || p_partkey % 50 AS path FROM part), s AS (SELECT path || '::' || name AS id, body FROM f, (VALUES ('K', 36), ('K.m', 11), ('K.m.inner', 3), ('f', 4)) AS v(name, body)), c AS (SELECT id, count(DISTINCT line) AS covered_lines, count(DISTINCT test_id) AS tests FROM o GROUP BY 1)
SELECT id, body AS body_lines, coalesce(covered_lines, 0) AS covered_lines, coalesce(tests, 0) AS tests, coalesce(tests, 0) > 0 AND id NOT LIKE '%::K' AS possible FROM s LEFT JOIN c USING (id)""")
def q181_covered_symbols(t: Tables):
    out = coverage.covered_symbols(*_ownership(t))
    return out.select("id", "body_lines", "covered_lines", F.col("tests").cast("long").alias("tests"), "possible")


@Q.add("""SELECT p_size % 3 AS task, 'pkg/a' || p_partkey || '.py' AS path, 'def _h' || p_size % 3 || '_alt():' || chr(10) || '    return _h' || (p_size + 1) % 3 || ' + _h' || p_size % 3 || '_alt()' || chr(10) AS content, true AS changed FROM part""")
def q182_renamed_by_task(t: Tables):
    """A task's private names get a suffix in its own files only."""
    own, other, k = _s(F.col("p_size") % 3), _s((F.col("p_size") + 1) % 3), _s("p_partkey")
    content = F.concat(F.lit("def _h"), own, F.lit("():\n    return _h"), other, F.lit(" + _h"), own, F.lit("()\n"))
    files = t.part.select((F.col("p_size") % 3).alias("task"), F.concat(F.lit("pkg/a"), k, F.lit(".py")).alias("path"), content.alias("content"))
    names = rewrite.private_symbols(files).join(files.select("path", "task"), "path").select("task", "name").distinct()
    return rewrite.rename_private(files, names, keys=("task",))
