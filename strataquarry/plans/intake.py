"""Sources and sinks over texts that are made from the driver tables: records, reports, manifests, publication."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.lineage import scratch
from ..sources import manifests, records, reports, sinks
from .tables import Catalogue, Tables

Q = Catalogue()
NUL = "\u0000"


def _pick(index, *values):
    """The value at a zero-based index."""
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def _s(c):
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


PATHS = """f AS (SELECT (['src', 'node_modules', '.hidden', 'pkg', 'vendor', 'build'])[p_size % 6 + 1] || '/' || split_part(p_name, ' ', 1) || '/f' || p_partkey || '.' || (['py', 'rs', 'go', 'TSX', 'h', 'txt', 'mjs'])[p_partkey % 7 + 1] AS path, p_size, p_partkey FROM part)"""


def _paths(t: Tables):
    top, end = _pick(F.col("p_size") % 6, "src", "node_modules", ".hidden", "pkg", "vendor", "build"), _pick(F.col("p_partkey") % 7, "py", "rs", "go", "TSX", "h", "txt", "mjs")
    return t.part.select(F.concat(top, F.lit("/"), F.substring_index("p_name", " ", 1), F.lit("/f"), _s("p_partkey"), F.lit("."), end).alias("path"), "p_size", "p_partkey")


@Q.add(f"WITH {PATHS} SELECT path FROM f WHERE path LIKE '%.py' AND p_size % 6 NOT IN (1, 5)")
def q80_owned_python(t: Tables):
    return records.owned(_paths(t).where(F.col("path").endswith(".py"))).select("path")


@Q.add(f"WITH {PATHS} SELECT path, (['python', 'rust', 'go', 'tsx', 'cpp', NULL, 'javascript'])[p_partkey % 7 + 1] AS language FROM f WHERE p_size % 6 IN (0, 3) AND p_partkey % 7 <> 5")
def q81_scanned_languages(t: Tables):
    return records.scanned(_paths(t)).select("path", "language")


@Q.add(f"WITH {PATHS} SELECT path FROM f WHERE p_size % 6 NOT IN (1, 5) AND p_partkey % 7 IN (1, 4)")
def q82_sources_by_suffix(t: Tables):
    return records.owned(_paths(t).where(F.col("path").rlike(r"\.(rs|h)$"))).select("path")


@Q.add("""SELECT event_type, count(*) FILTER (WHERE event_id % 5 <> 0 AND event_id % 7 <> 0 AND event_id % 11 <> 0) AS good, count(*) FILTER (WHERE event_id % 5 = 0 OR event_id % 7 = 0 AND event_id % 5 <> 0) AS bad,
coalesce(sum((json_extract_string(props, '$.k'))::BIGINT) FILTER (WHERE event_id % 5 <> 0 AND event_id % 7 <> 0 AND event_id % 11 <> 0), 0)::BIGINT AS total FROM events GROUP BY 1""")
def q83_json_lines(t: Tables):
    """Every fifth line is cut short, every seventh is an array, every eleventh blank."""
    i = F.col("event_id")
    value = F.when(i % 5 == 0, F.substring("props", 1, 5)).when(i % 7 == 0, F.concat(F.lit("["), "props", F.lit("]"))).when(i % 11 == 0, " ").otherwise(F.col("props"))
    out = None
    for e in ("view", "click", "purchase", "signup", "error"):
        good, bad = records.parse_lines(t.events.where(F.col("event_type") == e).select(value.alias("value")), "k long")
        one = good.agg(F.count(F.lit(1)).alias("good"), F.coalesce(F.sum("k"), F.lit(0)).alias("total")).crossJoin(bad.agg(F.count(F.lit(1)).alias("bad"))).select(F.lit(e).alias("event_type"), "good", "bad", "total")
        out = one if out is None else out.unionByName(one)
    return out


@Q.add("SELECT event_id, CASE WHEN event_id % 3 > 0 THEN (json_extract_string(props, '$.k'))::BIGINT END AS k, event_id % 3 > 0 AS available FROM events")
def q84_documents_or_unavailable(t: Tables):
    i = F.col("event_id")
    value = F.when(i % 6 == 0, F.lit(None)).when(i % 3 == 0, F.lit('{"k": ')).otherwise(F.col("props"))
    return records.parse_documents(t.events.select("event_id", value.alias("value")), "k long")


@Q.add("""WITH l AS (SELECT l_orderkey, count(*) AS files, count(*) FILTER (WHERE l_returnflag = 'R') AS binaries, coalesce(sum(l_quantity) FILTER (WHERE l_returnflag <> 'R'), 0)::BIGINT AS additions, coalesce(sum(l_linenumber) FILTER (WHERE l_returnflag <> 'R'), 0)::BIGINT AS deletions FROM lineitem GROUP BY 1)
SELECT 's' || o_orderkey AS sha, o_orderkey AS ordinal, CASE WHEN o_custkey % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS parents, o_custkey % 3 = 0 AS is_merge, o_orderpriority AS subject, 'body of ' || o_orderkey AS body, coalesce(files, 0) AS files, coalesce(binaries, 0) AS binaries, coalesce(additions, 0) AS additions, coalesce(deletions, 0) AS deletions FROM orders LEFT JOIN l ON l_orderkey = o_orderkey""")
def q85_parsed_commits(t: Tables):
    number = F.when(F.col("l_returnflag") == "R", "-").otherwise(F.col("l_quantity").cast("long").cast("string"))
    gone = F.when(F.col("l_returnflag") == "R", "-").otherwise(_s("l_linenumber"))
    line = F.concat_ws("\t", number, gone, F.concat(F.lit("dir a/f"), _s("l_partkey")))
    stat = t.lineitem.groupBy("l_orderkey").agg(F.array_join(F.collect_list(line), "\n").alias("numstat"))
    parents = F.when(F.col("o_custkey") % 3 == 0, "p1 p2").otherwise("p1")
    raw = t.orders.join(stat, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(F.col("o_orderkey").alias("ordinal"), F.concat_ws(NUL, F.concat(F.lit("s"), _s("o_orderkey")), parents, F.lit("A"), F.lit("a@x"), F.lit("t"), F.lit("C"), F.lit("c@x"), F.lit("t"), F.lit("HEAD"), "o_orderpriority", F.concat(F.lit("body of "), _s("o_orderkey"), F.lit("\n\n")), F.concat(F.lit("\n"), F.coalesce("numstat", F.lit("")))).alias("value"))
    c = records.parse_commits(raw)
    return c.select("sha", "ordinal", F.size("parent_shas").cast("long").alias("parents"), "is_merge", "subject", "body", F.size("changed_files").cast("long").alias("files"), F.size(F.filter("changed_files", lambda x: x["binary"])).cast("long").alias("binaries"), "additions", "deletions")


@Q.add("SELECT 'a b/' || l_partkey AS path, sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity + l_linenumber END)::BIGINT AS churn, bool_or(l_returnflag = 'R') AS any_binary FROM lineitem GROUP BY 1")
def q86_numstat(t: Tables):
    gone = F.col("l_returnflag") == "R"
    raw = t.lineitem.select(F.concat_ws("\t", F.when(gone, "-").otherwise(F.col("l_quantity").cast("long").cast("string")), F.when(gone, "-").otherwise(_s("l_linenumber")), F.concat(F.lit("a b/"), _s("l_partkey"))).alias("value"))
    return records.parse_numstat(raw).groupBy("path").agg(F.sum("churn").alias("churn"), F.bool_or("binary").alias("any_binary"))


@Q.add("""SELECT 'ref' AS what, (['branch', 'tag', 'remote', 'other'])[c_custkey % 4 + 1] AS kind, (['', '', '', 'refs/notes/'])[c_custkey % 4 + 1] || 'x/n' || c_custkey AS name, 'abc' || c_custkey AS sha FROM customer
UNION ALL SELECT 'status', (['M|-|f', '-|M|f', '-|-|t', 'A|M|f'])[s_suppkey % 4 + 1], 'a b/' || s_suppkey, '' FROM supplier""")
def q87_refs_and_status(t: Tables):
    folder = _pick(F.col("c_custkey") % 4, "refs/heads/", "refs/tags/", "refs/remotes/", "refs/notes/")
    refs = records.parse_refs(t.customer.select(F.concat(F.lit("abc"), _s("c_custkey"), F.lit(" "), folder, F.lit("x/n"), _s("c_custkey")).alias("value")))
    lines = t.supplier.select(F.concat(_pick(F.col("s_suppkey") % 4, "M  ", " M ", "?? ", "AM "), F.lit("a b/"), _s("s_suppkey")).alias("value")).unionByName(t.spark.sql("SELECT '  ' AS value"))
    state = records.parse_status(lines)
    mark = F.concat_ws("|", F.coalesce("staged", F.lit("-")), F.coalesce("unstaged", F.lit("-")), F.when(F.col("untracked"), "t").otherwise("f"))
    return refs.select(F.lit("ref").alias("what"), "kind", "name", "sha").unionByName(state.select(F.lit("status").alias("what"), mark.alias("kind"), F.col("path").alias("name"), F.lit("").alias("sha")))


@Q.add("""WITH p AS (SELECT c_custkey // 50 AS page, count(*) AS n FROM customer WHERE c_custkey <> 777 GROUP BY 1), s AS (SELECT coalesce(min(page) FILTER (WHERE n < 50 OR page = 20), max(page)) AS stop FROM p), u AS (SELECT p.* FROM p, s WHERE page <= stop)
SELECT 'pull_requests' AS capability, CASE WHEN max(page) >= 20 THEN CASE WHEN sum(n) FILTER (WHERE page <> 20) > 0 THEN 'partial' ELSE 'unavailable' END ELSE 'available' END AS status, coalesce(sum(n) FILTER (WHERE page <> 20), 0)::BIGINT AS count, max(CASE WHEN page = 20 THEN 'rate limit' END) AS reason, (SELECT coalesce(sum(c_custkey), 0)::BIGINT FROM customer, s WHERE c_custkey <> 777 AND c_custkey // 50 <= stop AND c_custkey // 50 <> 20) AS numbers FROM u""")
def q88_pull_request_pages(t: Tables):
    """Pages of 50; one record is missing, so its page is short; the twentieth page fails."""
    pages = t.customer.where("c_custkey <> 777").groupBy(F.expr("c_custkey div 50").alias("page")).agg(F.collect_list(F.struct(F.col("c_custkey").alias("number"))).alias("items"))
    pages = pages.select("page", F.when(F.col("page") != 20, F.col("items")).alias("items"), F.when(F.col("page") == 20, "rate limit").alias("error"))
    rows, state = records.pull_request_pages(pages, 50)
    return state.crossJoin(rows.agg(F.coalesce(F.sum("number"), F.lit(0)).alias("numbers")))


@Q.add("""SELECT 'c' || event_id AS cache_key, CASE WHEN event_id % 2 = 0 THEN 'model-' || event_type ELSE '' END AS model, 'says ' || event_id AS content, CASE WHEN event_id % 3 = 0 THEN 'stop' END AS finish_reason, CASE WHEN event_id % 2 = 0 THEN user_id ELSE 0 END AS prompt_tokens, CASE WHEN event_id % 2 = 0 THEN event_id ELSE 0 END AS completion_tokens FROM events WHERE event_id % 10 <> 0""")
def q89_transcripts(t: Tables):
    i, even = F.col("event_id"), F.col("event_id") % 2 == 0
    response = F.struct(F.concat(F.lit("says "), _s("event_id")).alias("content"), F.when(i % 3 == 0, "stop").alias("finish_reason"))
    usage = F.when(even, F.struct(F.col("user_id").alias("prompt_tokens"), i.alias("completion_tokens")))
    entry = F.to_json(F.struct(F.when(even, F.concat(F.lit("model-"), "event_type")).alias("model"), response.alias("response"), usage.alias("usage")))
    return records.transcripts(t.events.select(F.concat(F.lit("c"), _s("event_id")).alias("cache_key"), F.when(i % 10 == 0, "{broken").otherwise(entry).alias("value")))


@Q.add("""WITH e AS (SELECT user_id, 'p::T' || event_id % 3 AS test_id, arg_max(event_type, event_id) FILTER (WHERE event_type IN ('purchase', 'signup', 'error')) AS action, bool_or(event_type = 'view' AND value > 100) AS panic, bool_or(event_type = 'view' AND value BETWEEN 60 AND 100) AS want FROM events GROUP BY ALL)
SELECT user_id, test_id, CASE action WHEN 'purchase' THEN 'passed' WHEN 'error' THEN 'failed' ELSE 'skipped' END AS status, CASE WHEN action = 'purchase' THEN '' WHEN panic THEN 'behavioral_exception' WHEN want THEN 'assertion' ELSE 'behavioral_exception' END AS failure_class FROM e""")
def q90_go_events(t: Tables):
    e, v = F.col("event_type"), F.col("value")
    action = F.when(e == "view", "output").when(e == "click", "run").when(e == "purchase", "pass").when(e == "signup", "skip").otherwise("fail")
    said = F.when(v > 100, "panic: x\n").when(v >= 60, "want 1\n").otherwise("step\n")
    events = t.events.select(F.col("user_id").alias("run"), F.col("event_id").alias("ordinal"), action.alias("Action"), F.lit("p").alias("Package"), F.concat(F.lit("T"), _s(F.col("event_id") % 3)).alias("Test"), said.alias("Output"))
    return reports.go_cases(events).select(F.col("run").alias("user_id"), "test_id", "status", "failure_class")


@Q.add("""SELECT s_nationkey, 'm::t' || s_suppkey AS test_id, (['passed', 'failed', 'skipped'])[s_suppkey % 3 + 1] AS status, (['', 'x', 'infrastructure'])[s_suppkey % 3 + 1].replace('x', CASE WHEN s_suppkey % 2 = 0 THEN 'assertion' ELSE 'behavioral_exception' END) AS failure_class FROM supplier""")
def q91_rust_text(t: Tables):
    name = F.concat(F.lit("m::t"), _s("s_suppkey"))
    state = _pick(F.col("s_suppkey") % 3, "ok", "FAILED", "ignored")
    said = F.when(F.col("s_suppkey") % 2 == 0, "assertion `left == right` failed").otherwise("thread panicked at src/lib.rs")
    block = F.when(F.col("s_suppkey") % 3 == 1, F.concat(F.lit("---- "), name, F.lit(" stdout ----\n"), said, F.lit("\n")))
    text = F.concat(F.array_join(F.sort_array(F.collect_list(F.concat(F.lit("test "), name, F.lit(" ... "), state))), "\n"), F.lit("\n\nfailures:\n\n"), F.array_join(F.sort_array(F.collect_list(block)), "\n"), F.lit("\nfailures:\n    listed\n"))
    return reports.rust_cases(t.supplier.groupBy(F.col("s_nationkey").alias("run")).agg(text.alias("text"))).select(F.col("run").alias("s_nationkey"), "test_id", "status", "failure_class")


@Q.add("SELECT DISTINCT 'p' || l_suppkey || '.py' AS path, l_linenumber::INTEGER AS line, 'tests.test_' || l_partkey % 10 || '::test_x' AS test_id FROM lineitem")
def q92_coverage_contexts(t: Tables):
    context = F.concat(F.lit("tests.test_"), _s(F.col("l_partkey") % 10), F.lit(".test_x|run"))
    lines = F.create_map(F.concat(F.lit("p"), _s("l_suppkey"), F.lit(".py")), F.create_map(_s("l_linenumber"), F.array(context, F.lit(""))))
    return reports.coverage_contexts(t.lineitem.select(lines.alias("lines")))


@Q.add("SELECT DISTINCT 'p' || l_suppkey || '.go' AS path, unnest(range(l_linenumber, l_linenumber + (l_quantity::BIGINT % 4) + 1))::INTEGER AS line FROM lineitem WHERE l_returnflag = 'A'")
def q93_go_profile(t: Tables):
    a = F.col("l_linenumber")
    value = F.concat(F.lit("ex.com/m/p"), _s("l_suppkey"), F.lit(".go:"), _s(a), F.lit(".2,"), _s(a + F.col("l_quantity").cast("long") % 4), F.lit(".9 3 "), F.when(F.col("l_returnflag") == "A", "7").otherwise("0"))
    return reports.go_profile(t.lineitem.select(value.alias("value")).unionByName(t.spark.sql("SELECT 'mode: set' AS value")), "ex.com/m")


@Q.add("""WITH p AS (SELECT *, first(CASE event_type WHEN 'purchase' THEN 'pkg/' || event_id WHEN 'error' THEN 'bad/' || event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS package FROM events)
SELECT user_id, coalesce(package, '') AS package, 'Test' || event_id AS name FROM p WHERE event_type IN ('view', 'click')""")
def q94_go_test_list(t: Tables):
    e = F.col("event_type")
    value = F.when(e == "purchase", F.concat(F.lit("ok  \tpkg/"), _s("event_id"), F.lit("\t0.1s"))).when(e == "error", F.concat(F.lit("FAIL bad/"), _s("event_id"))).when(e == "signup", "helper").otherwise(F.concat(F.lit("Test"), _s("event_id")))
    return reports.go_test_list(t.events.select("user_id", F.col("event_id").alias("ordinal"), value.alias("value")), ("user_id",)).select("user_id", "package", "name")


@Q.add("""WITH g AS (SELECT p_size, count(*) AS n, count(DISTINCT p_brand) AS brands, count(DISTINCT p_partkey) AS keys FROM part GROUP BY 1) SELECT 'd' || p_size || '/' || name AS path, CASE name WHEN 'go.sum' THEN brands WHEN 'pnpm-lock.yaml' THEN n WHEN 'Cargo.lock' THEN n WHEN 'yarn.lock' THEN n ELSE keys END AS packages FROM g, (VALUES ('Cargo.lock'), ('go.sum'), ('package-lock.json'), ('pnpm-lock.yaml'), ('yarn.lock')) AS v(name)""")
def q95_lock_counts(t: Tables):
    rows = lambda line: F.array_join(F.sort_array(F.collect_list(line)), "\n")
    key, brand = _s("p_partkey"), F.replace("p_brand", F.lit("#"), F.lit(""))
    g = t.part.groupBy("p_size").agg(
        rows(F.concat(F.lit('[[package]]\nname = "p'), key, F.lit('"'))).alias("Cargo.lock"),
        F.concat(rows(F.concat(brand, F.lit(" v1 h1:a="))), F.lit("\n"), rows(F.concat(brand, F.lit(" v1/go.mod h1:b=")))).alias("go.sum"),
        F.concat(F.lit('{"packages": {"": {}, '), F.array_join(F.collect_list(F.concat(F.lit('"k'), key, F.lit('": {}'))), ", "), F.lit("}}")).alias("package-lock.json"),
        F.concat(F.lit("packages:\n"), rows(F.concat(F.lit("  /p"), key, F.lit(":\n    dev: true")))).alias("pnpm-lock.yaml"),
        F.concat(F.lit("# yarn\n"), rows(F.concat(F.lit("p"), key, F.lit('@1:\n  version "1"')))).alias("yarn.lock"),
    )
    names = [c for c in g.columns if c != "p_size"]
    files = g.select("p_size", F.explode(F.array(*(F.struct(F.lit(n).alias("n"), F.col(f"`{n}`").alias("content")) for n in names))).alias("f"))
    out = manifests.lock_counts(files.select(F.concat(F.lit("d"), _s("p_size"), F.lit("/"), "f.n").alias("path"), "f.content"))
    return out.select("path", F.col("packages").cast("long").alias("packages"))


@Q.add("SELECT replace(p_name, ' ', '-') AS name, CASE WHEN p_size % 3 = 0 THEN 'test' WHEN p_size % 3 = 1 THEN 'docs' END AS extra, count(*) AS n FROM part GROUP BY ALL")
def q96_install_report(t: Tables):
    marker = _pick(F.col("p_size") % 3, "[socks]>=1.0 ; extra == 'test'", ' (>=2); extra == "docs"', " ; python_version < '3.9'")
    return manifests.install_report(t.part.select(F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit("-")), marker).alias("value"))).groupBy("name", "extra").agg(F.count(F.lit(1)).alias("n"))


@Q.add("""SELECT 'ruff' AS tool, CASE WHEN event_type = 'error' THEN 'syntax' ELSE 'R-' || event_type END AS code, count(*) AS n FROM events GROUP BY ALL UNION ALL SELECT 'eslint', CASE WHEN event_type = 'error' THEN 'parse' ELSE 'R-' || event_type END, count(*) FROM events GROUP BY ALL
UNION ALL SELECT 'vet', 'vet', count(*) FROM events WHERE event_type <> 'click' UNION ALL SELECT 'clang-tidy', 'bugprone-' || event_type, count(*) FROM events GROUP BY ALL UNION ALL SELECT 'clippy', 'clippy::' || event_type, count(*) FROM events WHERE event_type <> 'view' GROUP BY ALL""")
def q97_lint_findings(t: Tables):
    e, line = F.col("event_type"), F.col("event_id").cast("int")
    code, path = F.when(e != "error", F.concat(F.lit("R-"), e)), F.concat(F.lit("f"), _s("user_id"), F.lit(".x"))
    per = t.events.groupBy("user_id").agg(
        F.to_json(F.collect_list(F.struct(code.alias("code"), path.alias("filename"), F.struct(line.alias("row")).alias("location")))).alias("ruff"),
        F.to_json(F.array(F.struct(F.first(path).alias("filePath"), F.collect_list(F.struct(code.alias("ruleId"), line.alias("line"))).alias("messages")))).alias("eslint"),
        F.array_join(F.collect_list(F.when(e == "click", F.lit("# package x")).otherwise(F.concat(F.lit("vet: a.go:"), _s(line), F.lit(":3: wrong")))), "\n").alias("vet"),
        F.array_join(F.collect_list(F.concat(path, F.lit(":"), _s(line), F.lit(":1: warning: odd [bugprone-"), e, F.lit("]"))), "\n").alias("clang-tidy"),
        F.array_join(F.collect_list(F.to_json(F.struct(F.when(e == "view", "build-finished").otherwise("compiler-message").alias("reason"), F.struct(F.lit("warning").alias("level"), F.struct(F.concat(F.lit("clippy::"), e).alias("code")).alias("code"), F.array(F.struct(path.alias("file_name"), line.alias("line_start"))).alias("spans")).alias("message")))), "\n").alias("clippy"),
    )
    tools = F.explode(F.array(*(F.struct(F.lit(n).alias("tool"), F.col(f"`{n}`").alias("content")) for n in ("ruff", "eslint", "vet", "clang-tidy", "clippy")))).alias("r")
    return manifests.rule_counts(manifests.lint_findings(per.select(tools).select("r.*")))


@Q.add("""SELECT 'test' AS kind, 'pytest -k t' || p_partkey AS value, '.github/workflows/w' || p_size || '.yml' AS path FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT 'setup', 'pip install p' || p_partkey, '.github/workflows/w' || p_size || '.yml' FROM part WHERE p_partkey % 3 = 1
UNION ALL SELECT 'matrix_version', '3.' || p_size, min('.github/workflows/w' || p_size || '.yml') FROM part GROUP BY p_size""")
def q98_ci_facts(t: Tables):
    step = _pick(F.col("p_partkey") % 3, "    - run: pytest -k t", "      run: 'pip install p", "      run: echo ")
    line = F.concat(step, _s("p_partkey"), F.when(F.col("p_partkey") % 3 == 1, "'").otherwise(""))
    files = t.part.groupBy("p_size").agg(F.concat(F.lit("jobs:\n  with:\n    python-version: '3."), _s("p_size"), F.lit("'\n"), F.array_join(F.sort_array(F.collect_list(line)), "\n")).alias("content"))
    return manifests.ci_facts(files.select(F.concat(F.lit(".github/workflows/w"), _s("p_size"), F.lit(".yml")).alias("path"), "content")).select("kind", "value", "path")


@Q.add("""WITH n AS (SELECT n_nationkey AS k FROM nation), f AS (SELECT k, k % 2 = 0 AS cargo, k % 3 = 0 AS npm, k % 9 = 0 AS ts, k % 5 = 0 AS go, k % 7 = 0 AS py, k % 4 = 0 AS ws FROM n)
SELECT k AS repo, array_to_string(list_filter([CASE WHEN cargo THEN 'rust' END, CASE WHEN npm THEN CASE WHEN ts THEN 'typescript' ELSE 'javascript' END END, CASE WHEN go THEN 'go' END, CASE WHEN py THEN 'python' END, CASE WHEN NOT (cargo OR npm OR go OR py) THEN 'go' END], lambda x : x IS NOT NULL), ',') AS languages,
CASE WHEN cargo THEN 'cargo' WHEN npm THEN CASE WHEN k % 6 = 3 THEN 'yarn' ELSE 'npm' END WHEN go THEN 'go' WHEN py THEN 'uv' ELSE 'go' END AS toolchain, CASE WHEN cargo THEN ws ELSE false END AS is_monorepo, CASE WHEN cargo THEN CASE WHEN ws THEN 'cargo test --all' ELSE 'cargo test' END WHEN npm THEN 'npm test' WHEN go OR NOT py THEN 'go test ./...' END AS test_command FROM f WHERE cargo OR npm OR go OR NOT py""")
def q99_project_profile(t: Tables):
    k = F.col("n_nationkey")
    some = lambda on, path, content="": F.when(on, F.struct(F.lit(path).alias("path"), (F.lit(content) if isinstance(content, str) else content).alias("content")))
    files = F.array_compact(F.array(some(k % 2 == 0, "Cargo.toml", F.when(k % 4 == 0, "[workspace]").otherwise("[package]")), some(k % 3 == 0, "package.json", "{}"), some(k % 9 == 0, "web/tsconfig.json"), some(k % 6 == 3, "yarn.lock"), some(k % 5 == 0, "go.mod"), some(k % 7 == 0, "pyproject.toml"), some(k >= 0, "src/main.go")))
    rows = t.nation.select(k.alias("repo"), F.explode(files).alias("f")).select("repo", "f.*")
    out = manifests.project_profile(rows, ("repo",)).where("primary <> 'python'")
    return out.select("repo", F.array_join("languages", ",").alias("languages"), "toolchain", "is_monorepo", "test_command")


@Q.add("""SELECT 'published' AS step, count(*) AS n, sum(c_custkey)::BIGINT AS total FROM customer WHERE c_nationkey < 10 UNION ALL SELECT 'appended', 2 * count(*), 2 * sum(c_custkey)::BIGINT FROM customer WHERE c_nationkey < 10
UNION ALL SELECT 'refused', count(*), sum(c_custkey)::BIGINT FROM customer WHERE c_nationkey < 10 UNION ALL SELECT 'exported', count(*), sum(c_custkey)::BIGINT FROM customer WHERE c_nationkey = 3""")
def q100_publish_append_export(t: Tables):
    """Published twice (the second swap replaces the first), refused by its own check, appended twice, exported as sorted lines."""
    rows, base = t.customer.select("c_custkey", "c_nationkey"), scratch(t.spark)
    sinks.publish(rows, f"{base}/published")
    sinks.publish(rows.where("c_nationkey < 10"), f"{base}/published")

    def refuse(df):
        raise ValueError("not what was wanted")

    try:
        sinks.publish(rows.limit(1), f"{base}/published", validate=refuse)
    except ValueError:
        kept = t.spark.read.parquet(f"{base}/published")
    for _ in range(2):
        sinks.append(rows.where("c_nationkey < 10"), f"{base}/appended")
    sinks.export_lines(rows.where("c_nationkey = 3"), f"{base}/exported", ["c_custkey"])
    schema = "c_custkey long, c_nationkey int"
    steps = {"published": t.spark.read.parquet(f"{base}/published"), "appended": t.spark.read.schema(schema).json(f"{base}/appended"), "refused": kept, "exported": t.spark.read.schema(schema).json(f"{base}/exported")}
    out = None
    for name, df in steps.items():
        one = df.agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("total")).select(F.lit(name).alias("step"), "n", "total")
        out = one if out is None else out.unionByName(one)
    return out


@Q.add("SELECT DISTINCT 't' || o_orderkey % 500 AS test_id, 'm' || s_nationkey AS module FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey WHERE s_nationkey % 5 <> 0")
def q101_rebuilt_views(t: Tables):
    path = F.concat(F.lit("p"), _s("s_suppkey"), F.lit(".py"))
    symbols = t.supplier.select(F.concat(path, F.lit("::f")).alias("id"), path.alias("path"))
    files = t.supplier.select(path.alias("path"), F.when(F.col("s_nationkey") % 5 != 0, F.concat(F.lit("m"), _s("s_nationkey"))).alias("module"))
    hits = t.lineitem.select(F.concat(F.lit("t"), _s(F.col("l_orderkey") % 500)).alias("test_id"), F.concat(F.lit("p"), _s("l_suppkey"), F.lit(".py::f")).alias("symbol_id"), "l_orderkey")
    hits = hits.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    sinks.rebuild_views(t.spark, {"coverage": hits, "symbols": symbols, "files": files})
    return t.spark.table("test_modules")


@Q.add("""SELECT 'task-' || p_partkey AS id, '"id":"task-' || p_partkey || '","instruction":"do ' || p_name || '","modules":[' || CASE WHEN p_size % 2 = 0 THEN '"m' || p_size || '"' ELSE '' END || ']' AS head, 'pytest -x t' || p_size || '.py' AS command_line, 't' || p_size || '.py::a' || chr(10) || 't' || p_size || '.py::b' || chr(10) AS targets_txt, 'task-' || p_partkey || '/goldenSolution.diff' AS diff FROM part WHERE p_partkey % 4 <> 1""")
def q102_task_records(t: Tables):
    """Records of the tasks that ship; those of a former emission that no longer do are withdrawn."""
    file = F.concat(F.lit("t"), _s("p_size"), F.lit(".py"))
    every = t.part.select(F.concat(F.lit("task-"), _s("p_partkey")).alias("task_id"), F.lit("history").alias("source"), F.col("p_name").alias("title"), F.concat(F.lit("do "), "p_name").alias("instruction"), F.concat(F.lit("m"), _s("p_size")).alias("primary_module"), F.when(F.col("p_size") % 2 == 0, F.array(F.concat(F.lit("m"), _s("p_size")))).alias("modules"), F.array(file).alias("verifier_files"), F.array(F.concat(file, F.lit("::a")), F.concat(file, F.lit("::b"))).alias("targets"), F.array(F.lit("pytest"), F.lit("-x"), file).alias("command"), "p_partkey")
    gone = sinks.withdraw(every, every.where("p_partkey % 4 <> 1"), "task_id").select("task_id")
    out = sinks.task_records(every.join(gone, "task_id", "left_anti"))
    return out.select("id", F.regexp_extract("record", r'^\{(.*?\]),"paths"', 1).alias("head"), F.get_json_object("record", "$.verifier.command_line").alias("command_line"), "targets_txt", F.get_json_object("record", "$.paths.golden_diff").alias("diff"))
