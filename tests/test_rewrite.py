import ast

from pyspark.sql import functions as F

from strataquarry.operators import evidence, rewrite

SOURCE = '''class A:
    def run(self, x):
        """Doc."""
        y = x + 1
        return y
        # explains y

    # next
    def gen(self):
        yield 1

def one(): return 1

def twice(): pass
def twice():
    return 2
'''


def cut(spark, rows, **more):
    return {r.name: r for r in rewrite.excise(spark.createDataFrame(rows, "path string, language string, content string, name string, line int"), **more).collect()}


def test_excision_of_python(spark):
    got = cut(spark, [("a.py", "python", SOURCE, n, None) for n in ("A.run", "A.gen", "one", "twice", "nope")])
    stub = got["A.run"].stubbed
    ast.parse(stub)
    assert '"""Doc."""\n        return None\n\n    # next' in stub and "explains" not in stub and (got["A.run"].first_line, got["A.run"].last_line) == (4, 6)
    assert "+        y = x + 1" in got["A.run"].diff
    assert all(got[n].refused for n in ("A.gen", "one", "twice", "nope"))
    explicit = cut(spark, [("a.py", "python", SOURCE, "A.gen", None), ("b.py", "python", "def (", "x", None), ("a.py", "python", SOURCE, "twice", 15)], explicit=True)
    assert "raise NotImplementedError('A.gen is not implemented')" in explicit["A.gen"].stubbed and explicit["A.gen"].is_generator
    assert explicit["x"].refused and "twice is not implemented" in explicit["twice"].stubbed


def test_excision_of_brace_languages(spark):
    rust = 'fn add(a: i32) -> i32 {\n    // }\n    let s = "}";\n    a + 1\n}\nfn b() { add(1); }\n'
    go = "func (t *T) Run() int {\n\treturn map[string]int{}[\"{\"]\n}\n"
    got = cut(spark, [("a.rs", "rust", rust, "add", None), ("a.go", "go", go, "Run", None), ("b.rs", "rust", rust, "none", None)])
    assert got["add"].stubbed == "fn add(a: i32) -> i32 {\n    todo!()\n}\nfn b() { add(1); }\n" and (got["add"].first_line, got["add"].last_line) == (1, 5)
    assert got["Run"].stubbed == 'func (t *T) Run() int {\n    panic("not implemented")\n}\n' and got["none"].refused


def test_renames_spare_tests(spark):
    files = spark.createDataFrame([("a.py", "_x = 1\ndef _help(): return _x\nclass B: pass\n__all__ = []\n"), ("tests/test_a.py", "_help()")], "path string, content string")
    names = rewrite.private_symbols(files)
    assert sorted(r.name for r in names.collect()) == ["_help"], "functions and classes, no assigned names"
    got = {r.path: (r.content, r.changed) for r in rewrite.rename_private(files, names).collect()}
    assert got["a.py"][0].startswith("_x = 1\ndef _help_alt(): return _x") and got["tests/test_a.py"] == ("_help()", False)
    assert not any(r.changed for r in rewrite.rename_private(files, names.where("false")).collect())
    v = spark.range(1).select(rewrite.portability(F.lit(2), F.lit(False), F.lit(True)).alias("a"), rewrite.portability(F.lit(0), F.lit(False), F.lit(True)).alias("b")).first()
    assert (v.a, v.b) == ("verifier_depends_on_internals", "no_internals_to_rename")


def test_mutation_and_pruning(spark):
    df = spark.createDataFrame([("a.py", "def f():\n    return 1\n\ndef g():\n    return 2\n", [1])], "path string, content string, lines array<int>")
    assert rewrite.mutate(df).first().mutated == "def f():\n    raise RuntimeError('__mutation__')\n\ndef g():\n    return 2\n"
    nested = spark.createDataFrame([("a.py", "class C:\r\n\t@d\r\n\tdef f(self):\r\n\t\tdef g():\r\n\t\t\treturn 1\r\n\t\treturn g()\r\ndef h(): return 3\n", [3, 4, 7]), ("b.py", "def (", [1])], "path string, content string, lines array<int>")
    assert [r.mutated for r in rewrite.mutate(nested).orderBy("path").collect()] == ["class C:\r\n\t@d\r\n\tdef f(self):\r\n\t\traise RuntimeError('__mutation__')\ndef h(): return 3\n", None]
    sources = ["def test_a():\n    f()", "x=1", "def (", "def test_a():\n    with pytest.raises(E): f()", "class T:\n  def test_b(self): pass\ndef test_c(): assert 1\n"]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(sources)], "i int, s string").select("i", rewrite.test_problem(rewrite.definitions(F.col("s"))).alias("p"))
    assert [r.p for r in got.orderBy("i").collect()] == ["test_a_has_no_assertion", "no_test_functions", "syntax_error", None, "test_b_has_no_assertion"]
    files = spark.createDataFrame([("a.py", "def test_a():\n    assert 1\n\n@x\ndef test_b():\n    assert 0\n", ["test_b"]), ("b.py", "def test_c():\n    assert 0\n", ["test_c"])], "path string, content string, failing array<string>")
    assert [(r.path, r.content) for r in rewrite.prune(files).collect()] == [("a.py", "def test_a():\n    assert 1\n\n")]
    j = spark.createDataFrame([('{"b": 1, "a": "é"}',), ('{ "a":"é","b":1}',), ("no",)], "j string").select(rewrite.canonical_sha(F.col("j")).alias("s")).collect()
    assert j[0].s == j[1].s and j[2].s is None


def test_arguments_and_designation(spark):
    files = spark.createDataFrame([("pkg/test_a.py", ""), ("pkg.py", ""), ("m.go", "func TestX(t *T) {}")], "path string, content string")
    nodes = spark.createDataFrame([("pkg.test_a.TestC::test_x",), ("pkg/test_a.py::t",), ("no.where::t",), ("plain",)], "node string")
    got = {r.node: r.argument for r in evidence.file_argument(nodes, files).collect()}
    assert got == {"pkg.test_a.TestC::test_x": "pkg/test_a.py::TestC::test_x", "pkg/test_a.py::t": "pkg/test_a.py::t", "no.where::t": "no.where::t", "plain": "plain"}
    assert [(r.path, r.names) for r in evidence.designate(spark.createDataFrame([(a,) for a in got.values()], "argument string"), files).collect()] == [("pkg/test_a.py", ["TestC.test_x", "t"])]
    assert [tuple(r) for r in evidence.declared_in(spark.createDataFrame([("TestX",)], "name string"), files).collect()] == [("TestX", "m.go")]


def test_small_ladders(spark):
    rows = spark.createDataFrame([("1", "x"), (None, "y"), ("z", "w")], "n string, s string")
    good, bad = evidence.guard_records(rows, {"n": "int", "s": "string"})
    assert good.count() == 1 and sorted(r.problem for r in bad.collect()) == ["missing:n", "not_int:n"]
    of = lambda *r: spark.createDataFrame(r, "task string, test_id string, status string")
    base = of(("a", "t", "passed"), ("b", "t", "passed"), ("c", "t", "passed"), ("d", "t", "passed"), ("e", "t", "passed"))
    now = of(("a", "t", "passed"), ("b", "u", "passed"), ("c", "t", "failed"), ("d", "t", "passed"), ("d", "u", "failed"), ("n", "t", "passed"))
    assert {r.task: r.match for r in evidence.baseline_match(now, base, ["task"]).collect()} == {"a": "matches", "b": "tests_missing_in_container", "c": "differs", "d": "matches_with_additions", "e": "container_produced_no_results", "n": "no_baseline"}
    v = spark.createDataFrame([("3.9",), ("3.12",), ("3.13",)], "version string")
    assert evidence.newest_interpreter(v, F.array(F.lit(">=3.10"), F.lit("<3.13"))).first().version == "3.12"
    assert [r.content for r in evidence.overlay(spark.createDataFrame([("a", "1"), ("b", "2")], "path string, content string"), spark.createDataFrame([("b", "3")], "path string, content string"), ["path"]).orderBy("path").collect()] == ["1", "3"]
    units = spark.createDataFrame([("s", "sig", 0, "f()"), ("s", "tests", 0, "a"), ("s", "tests", 1, "b")], "subject string, section string, ordinal int, unit string")
    sections = spark.createDataFrame([("s", "sig", 1, 1, 1), ("s", "tests", 2, 2, 1)], "subject string, section string, priority int, units int, shown int")
    assert evidence.render_cards(units, sections).first().text == "## sig\nf()\n\n## tests  (1 of 2 shown)\na"
    p = spark.createDataFrame([("a/tests/x.py",), ("a/Tests/x.ts",), ("src/a.spec.ts",), ("src/a.py",)], "p string").select(evidence.looks_like_test(F.col("p")).alias("a"), evidence.looks_like_test_any(F.col("p")).alias("b")).collect()
    assert [(r.a, r.b) for r in p] == [(True, True), (False, True), (False, True), (False, False)]
