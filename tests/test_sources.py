import json

from pyspark.sql import functions as F

from strataquarry.operators import texts
from strataquarry.sources import manifests, records, reports, sinks
from strataquarry.streaming import results


def lines(spark, text):
    return spark.createDataFrame(list(enumerate(text.split("\n"))), "ordinal long, value string")


def test_jsonl_counts_what_it_skips(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\nnot json\n{"a": 2}\n')
    good, bad = records.read_jsonl(spark, str(tmp_path / "x.jsonl"), "a int")
    assert sorted(r.a for r in good.collect()) == [1, 2] and bad.count() == 1


def test_absent_documents(spark, tmp_path):
    assert records.read_document(spark, str(tmp_path / "no.json"), "a int").first().available is False
    (tmp_path / "y.json").write_text('{\n"a": 3\n}')
    assert tuple(records.read_document(spark, str(tmp_path / "y.json"), "a int").first()) == (3, True)


def test_commits_and_numstat(spark):
    value = "\0".join(["s1", "p1 p2", "A", "a@x", "t1", "C", "c@x", "t2", "HEAD -> main, tag: v1", "subj", "body\n", "3\t1\ta.py\n-\t-\tb.png\n"])
    r = records.parse_commits(spark.createDataFrame([(0, value)], "ordinal long, value string")).first()
    assert (r.parent_shas, r.is_merge, r.refs, r.body, r.additions, r.deletions) == (["p1", "p2"], True, ["HEAD -> main", "tag: v1"], "body", 3, 1)
    assert [(c.path, c.additions, c.binary) for c in r.changed_files] == [("a.py", 3, False), ("b.png", None, True)]
    d = records.parse_numstat(spark.createDataFrame([("3\t1\ta.py",), ("-\t-\tb.png",), ("",)], "value string"))
    assert sorted((x.path, x.churn) for x in d.collect()) == [("a.py", 4), ("b.png", 0)]
    refs = records.parse_refs(spark.createDataFrame([("ab1 refs/heads/main",), ("ab2 refs/tags/v/1",)], "value string")).collect()
    assert [tuple(x) for x in refs] == [("branch", "main", "ab1"), ("tag", "v/1", "ab2")]


def test_pages_stop_at_the_first_short_one(spark):
    pages = spark.createDataFrame([(1, [(1,), (2,)], None), (2, [(3,)], None), (3, [(9,)], None)], "page int, items array<struct<number:int>>, error string")
    rows, state = records.pull_request_pages(pages, 2)
    assert sorted(r.number for r in rows.collect()) == [1, 2, 3]
    assert tuple(state.first()) == ("pull_requests", "available", 3, None)
    broken = spark.createDataFrame([(1, [(1,), (2,)], None), (2, None, "rate limit")], "page int, items array<struct<number:int>>, error string")
    assert tuple(records.pull_request_pages(broken, 2)[1].first()) == ("pull_requests", "partial", 2, "rate limit")


def test_source_files(spark, tmp_path):
    for name in ("pkg/a.py", "node_modules/x.py", ".hidden/h.py", "b.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x = 1\n")
    assert sorted(r.path for r in records.source_files(spark, str(tmp_path)).collect()) == ["pkg/a.py"]
    listed = spark.createDataFrame([(".hidden/h.py",), ("a/node_modules/b.py",), ("pkg/a.py",), ("build/y.py",)], "path string")
    assert [r.path for r in records.owned(listed).collect()] == [".hidden/h.py", "pkg/a.py"]
    assert [r.path for r in records.owned(listed, hidden=False).collect()] == ["pkg/a.py"]
    df = spark.createDataFrame([("a.RS",), ("b.tsx",), ("c",)], "path string")
    assert [r[0] for r in df.select(records.language_of(F.col("path"))).collect()] == ["rust", "tsx", None]
    specs = spark.createDataFrame([("https://github.com/O/N.git",), ("git@h.x:o/n",), ("./here",)], "s string").select(records.resolve_spec(F.col("s")).alias("r")).collect()
    assert [tuple(x.r) for x in specs] == [("https", "github.com/o/n", "o", "n"), ("ssh", "h.x/o/n", "o", "n"), ("local", "./here", None, None)]


def test_go_and_rust_cases(spark):
    events = [("output", "p", "TestA", "--- FAIL: TestA\n"), ("output", "p", "TestA", "  a_test.go:3: got 1, want 2\n"), ("fail", "p", "TestA", None), ("pass", "p", "TestB", None), ("skip", "p", "TestC", None), ("pass", "p", None, None)]
    df = spark.createDataFrame([("r", i, *e) for i, e in enumerate(events)], "run string, ordinal int, Action string, Package string, Test string, Output string")
    got = {r.test_id: (r.status, r.failure_class) for r in reports.go_cases(df).collect()}
    assert got == {"p::TestA": ("failed", "assertion"), "p::TestB": ("passed", ""), "p::TestC": ("skipped", "behavioral_exception")}
    text = "test a::x ... ok\ntest a::y ... FAILED\ntest a::z ... ignored\n\nfailures:\n\n---- a::y stdout ----\nthread 'a::y' panicked at src/lib.rs:3:\nboom\n\nfailures:\n    a::y\n"
    got = {r.test_id: (r.status, r.failure_class) for r in reports.rust_cases(spark.createDataFrame([("r", text)], "run string, text string")).collect()}
    assert got == {"a::x": ("passed", ""), "a::y": ("failed", "behavioral_exception"), "a::z": ("skipped", "infrastructure")}


def test_coverage_sources(spark):
    doc = spark.createDataFrame([({"m.py": {"8": ["t.test_a.test_run|run", ""]}},)], "lines map<string,map<string,array<string>>>")
    assert [tuple(r) for r in reports.coverage_contexts(doc).collect()] == [("m.py", 8, "t.test_a::test_run")]
    profile = spark.createDataFrame([("mode: set",), ("ex.com/m/a.go:3.1,5.2 2 1",), ("ex.com/m/a.go:9.1,9.2 1 0",)], "value string")
    assert sorted(tuple(r) for r in reports.go_profile(profile, "ex.com/m").collect()) == [("a.go", 3), ("a.go", 4), ("a.go", 5)]
    listing = lines(spark, "TestA\nTestB\nok  \tex.com/p\t0.1s\nTestC\n?   ex.com/q [no test files]\nTestD")
    assert sorted((r.package, r.name) for r in reports.go_test_list(listing).collect()) == [("", "TestD"), ("ex.com/p", "TestA"), ("ex.com/p", "TestB"), ("ex.com/q", "TestC")]


def test_locks(spark):
    locked = lines(spark, "a==1 \\\n    --hash=x\n# b==2\n-e c==3\nd==4")
    assert {r.name: r.version for r in manifests.locked_packages(locked).collect()} == {"a": "1", "d": "4"}
    assert manifests.locked_count(locked).first().packages == 2
    files = [("Cargo.lock", "[[package]]\n[[package]]\n"), ("go.sum", "m v1 h1:x\nm v1/go.mod h1:y\nn v2 h1:z\n"), ("package-lock.json", json.dumps({"packages": {"": {}, "a": {}, "b": {}}})), ("pnpm-lock.yaml", "packages:\n  /a/1:\n  /b/2:\n"), ("yarn.lock", "# c\na@1:\n  version 1\nb@2:\n"), ("sub/package-lock.json", "broken")]
    assert {r.path: r.packages for r in manifests.lock_counts(spark.createDataFrame(files, "path string, content string")).collect()} == {"Cargo.lock": 2, "go.sum": 2, "package-lock.json": 2, "pnpm-lock.yaml": 2, "yarn.lock": 2, "sub/package-lock.json": None}
    req = spark.createDataFrame([("pytest>=7; extra == 'test'",), ("attrs",)], "value string")
    assert [tuple(r) for r in manifests.install_report(req).collect()] == [("pytest", "test"), ("attrs", None)]


def test_lint_findings(spark):
    rows = [
        ("ruff", json.dumps([{"code": "E501", "filename": "a.py", "location": {"row": 3}}, {"code": None, "filename": "b.py", "location": {"row": 1}}])),
        ("eslint", json.dumps([{"filePath": "a.js", "messages": [{"ruleId": "no-x", "line": 2}]}])),
        ("clippy", json.dumps({"reason": "compiler-message", "message": {"level": "warning", "code": {"code": "clippy::x"}, "spans": [{"file_name": "a.rs", "line_start": 7}]}}) + "\n" + json.dumps({"reason": "build-finished"})),
        ("vet", "# pkg\n./a.go:3:4: bad"),
        ("clang-tidy", "/x/a.cc:5:1: warning: w [misc-y]\nnoise"),
    ]
    got = sorted((r.tool, r.code, r.path, r.line) for r in manifests.lint_findings(spark.createDataFrame(rows, "tool string, content string")).collect())
    assert got == [("clang-tidy", "misc-y", "/x/a.cc", 5), ("clippy", "clippy::x", "a.rs", 7), ("eslint", "no-x", "a.js", 2), ("ruff", "E501", "a.py", 3), ("ruff", "syntax", "b.py", 1), ("vet", "vet", "./a.go", 3)]


def test_ci_and_profile(spark):
    files = [(".github/workflows/ci.yml", "  - run: pytest -q\n    run: 'make build'\n  - run: pytest -q\n    python-version: ['3.12']\n  - run: sudo apt-get install -y libx liby\n"), ("Makefile", "all:\ntest: x\n"), ("package.json", '{"scripts": {"test": "jest", "build": "tsc"}}'), ("pyproject.toml", ""), ("tsconfig.json", "")]
    df = spark.createDataFrame(files, "path string, content string")
    got = {(r.kind, r.value) for r in manifests.ci_facts(df).collect()}
    assert got == {("test", "pytest -q"), ("build", "make build"), ("matrix_version", "3.12"), ("system_package", "libx"), ("system_package", "liby"), ("test", "make -f Makefile test"), ("test", "npm run test -- jest"), ("build", "npm run build")}
    p = manifests.project_profile(df).first()
    assert (p.languages, p.primary, p.toolchain, p.test_command) == (["typescript", "python"], "typescript", "npm", "npm test")
    bare = manifests.project_profile(spark.createDataFrame([("src/x.go", "")], "path string, content string")).first()
    assert (bare.primary, bare.toolchain) == ("go", "go")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k int, v string, o int")
    assert sorted((r.k, r.v) for r in sinks.last_wins(df, ["k"], ["o"]).collect()) == [(1, "b"), (2, "c")]
    assert sorted((r.k, r.v) for r in sinks.first_wins(df, ["k"], ["o"]).collect()) == [(1, "a"), (2, "c")]
    path = str(tmp_path / "t")
    sinks.publish(df, path)
    sinks.publish(df.limit(1), path)
    assert spark.read.parquet(path).count() == 1 and len(list(tmp_path.iterdir())) == 1

    def refuse(_):
        raise ValueError("no")

    try:
        sinks.publish(df, path, validate=refuse)
    except ValueError:
        pass
    assert spark.read.parquet(path).count() == 1
    sinks.append(df, str(tmp_path / "log"))
    sinks.append(df, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 6
    sinks.export_lines(df, str(tmp_path / "out"), ["k", "o"])
    text = next((tmp_path / "out").glob("part-*")).read_text().splitlines()
    assert json.loads(text[0]) == {"k": 1, "o": 1, "v": "a"} and len(text) == 3


def test_texts(spark):
    said = spark.createDataFrame([("t", "Please call run(alpha, beta) then stop")], "task_id string, text string")
    diff = spark.createDataFrame([("t", "+++ b/x\n+    run(alpha, beta)\n+def _new(x):\n+value: int = 3\n-gone()\n+\n")], "task_id string, diff string")
    assert [tuple(r) for r in texts.copied_lines(said, diff).collect()] == [("t", 0, "run ( alpha , beta")]
    base = spark.createDataFrame([("t", "x = run(alpha, beta)")], "task_id string, text string")
    assert texts.copied_lines(said, diff, base).count() == 0
    names = spark.createDataFrame([("t", "value")], "task_id string, name string")
    assert [(r.name, r.private) for r in texts.novel_names(diff, names).collect()] == [("_new", True)]
    g = spark.createDataFrame([(["a.b(x)", "c | d"], ["a.b", "c", "e"]), ([], []), (["z"], ["a"])], "c array<string>, k array<string>").select(texts.grounding(F.col("c"), F.col("k")).alias("g")).collect()
    assert [(x.g.grounded, x.g.cited, round(x.g.coverage, 3)) for x in g] == [(True, 2, 0.667), (True, 0, 0.0), (False, 1, 0.0)]
    files = spark.createDataFrame([("a/b.py", "x\ny\nx"), ("c.py", "x")], "path string, content string")
    assert [(r.path, r.line) for r in texts.grep(files, "^x$").collect()] == [("a/b.py", 1), ("a/b.py", 3), ("c.py", 1)]
    assert [r.name for r in texts.list_dir(files).collect()] == ["a/", "c.py"]
    assert tuple(texts.read_window(files, "a/b.py", 2, 1).first()) == ("a/b.py", "y", True)


def test_budget_equals_its_loop(spark):
    import random

    rng = random.Random(3)
    rows = [(g, p, rng.randrange(0, 30), rng.randrange(1, 25), rng.random() < 0.3) for g in range(8) for p in range(6)]
    got = {(r.g, r.priority): r.shown for r in texts.budgeted(spark.createDataFrame(rows, "g int, priority int, units int, cap int, required boolean"), ["g"]).collect()}
    for g in range(8):
        left = 40
        for _, p, units, cap, required in sorted(r for r in rows if r[0] == g):
            show = min(units, cap) if required else max(0, min(units, cap, left))
            left -= 0 if required else show
            assert got[g, p] == show


def test_streams(spark, tmp_path):
    rows = [("t", "r", "a", "assertion", "2024-01-01 00:00:01"), ("t", "r", "a", "assertion", "2024-01-01 00:00:02"), ("t", "r", "b", "passed", "2024-01-01 00:01:00")]
    df = spark.createDataFrame(rows, "task_id string, run string, test_id string, failure_class string, at string").withColumn("reported_at", F.to_timestamp("at")).drop("at")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = results.deduplicated(results.read_stream(spark, str(tmp_path / "in"), df.schema))
    results.append_jsonl(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    counts = results.class_counts(results.read_stream(spark, str(tmp_path / "in"), df.schema))
    q = counts.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.failure_class: r.n for r in spark.table("counts").collect()} == {"assertion": 2, "passed": 1}
    for i in (1, 2):
        results.upsert(results.read_stream(spark, str(tmp_path / "in"), df.schema), str(tmp_path / "table"), str(tmp_path / f"cp{i}"), ["test_id"], ["reported_at"]).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "table")).count() == 2


def test_commit_exports_are_read_in_splits(spark, tmp_path):
    """Large files are cut at marks, wherever a split begins; ordinals follow files and places over splits."""
    def record(i):
        stat = "".join(f"\n{i}\t1\tdir/ä{j}.py\0" for j in range(i % 4))
        return "\0".join([f"{i:040x}", "", "A", "", "t", "C", "", "t", "", f"subject {i} \x1e", "x" * (i % 37) + "\n" * (i % 3), stat])

    n = 400
    for k, part in enumerate((range(0, 250), range(250, n))):
        body = "".join(records.RECORD_MARK + record(i) for i in part)
        (tmp_path / f"log-{k}.bin").write_bytes(body.encode())
    want = {r.sha: r for r in records.parse_commits(spark.createDataFrame([(i, record(i)) for i in range(n)], "ordinal long, value string")).collect()}
    assert len(want) == n
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in (997, 1009, 4096, 1 << 20):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", 1)
            got = records.read_commits(spark, str(tmp_path)).collect()
            assert len(got) == n and all(want[r.sha] == r for r in got), size
        plan = records.read_commits(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan  # texts are not shuffled
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_commit_export_without_records_and_with_broken_bytes(spark, tmp_path):
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "empty").write_bytes(b"")
    (tmp_path / "e" / "mark").write_bytes(records.RECORD_MARK.encode())
    assert records.read_commits(spark, str(tmp_path / "e")).count() == 0
    (tmp_path / "e" / "one").write_bytes(b"s1\0p\0A\xff\0e\0t\0C\0e\0t\0\0subj\0body\0" + records.RECORD_MARK.encode())
    assert [(r.ordinal, r.author_name) for r in records.read_commits(spark, str(tmp_path / "e")).collect()] == [(0, "A�")]
