import pytest
from pyspark.sql import functions as F

from strataquarry import schemas as S
from strataquarry.operators import coverage, dependencies, evidence, graph, parse

TREE = {
    "harbor/__init__.py": "\"\"\"Ships and berths.\"\"\"\nfrom harbor.quay import assign as book, LongBerth\n",
    "harbor/quay.py": "import math\nfrom . import crane\n\n\nclass Berth:\n    size = 1\n\n\nclass LongBerth(Berth):\n    \"\"\"Two ships long.\"\"\"\n\n    def moor(self, ship):\n        return max([ship, 0])\n\n\ndef assign(ship):\n    return LongBerth().moor(ship)\n",
    "harbor/crane.py": "from harbor import book\nimport pulley\n\n\ndef lift(load):\n    book(load)\n    pulley.turn(load)\n    ghost.pull()\n",
    "checks/tests/test_crane.py": "from harbor.crane import lift\n\ntry:\n    import winch\nexcept ImportError:\n    winch = None\n\n\ndef test_lift():\n    lift(3)\n",
    "wreck.py": "def (",
}
TEST = "checks/tests/test_crane.py::test_crane.test_lift"


@pytest.fixture(scope="module")
def world(spark):
    files = spark.createDataFrame([(p, c, "test" in p) for p, c in TREE.items()], "path string, content string, is_test boolean")
    files = parse.module_names(files).cache()
    parsed = parse.tables(parse.parse_files(files).cache())
    return files, parsed


def test_modules(world):
    got = {r.path: r.module for r in world[0].collect()}
    assert got == {"harbor/__init__.py": "harbor", "harbor/quay.py": "harbor.quay", "harbor/crane.py": "harbor.crane", "checks/tests/test_crane.py": "test_crane", "wreck.py": "wreck"}


def test_parse(world):
    _, t = world
    symbols = {r.id: r for r in t["symbols"].collect()}
    defined = {"harbor/quay.py::harbor.quay.Berth", "harbor/quay.py::harbor.quay.LongBerth", "harbor/quay.py::harbor.quay.LongBerth.moor", "harbor/quay.py::harbor.quay.assign", "harbor/crane.py::harbor.crane.lift", TEST}
    modules = {"harbor/__init__.py::harbor", "harbor/quay.py::harbor.quay", "harbor/crane.py::harbor.crane", "checks/tests/test_crane.py::test_crane"}
    assert set(symbols) == defined | modules
    moor = symbols["harbor/quay.py::harbor.quay.LongBerth.moor"]
    assert (moor.kind, moor.line, moor.end_line, moor.parent) == ("method", 12, 13, "harbor/quay.py::harbor.quay.LongBerth")
    assert symbols["harbor/quay.py::harbor.quay.LongBerth"].bases == ["Berth"]
    top = symbols["harbor/__init__.py::harbor"]
    assert (top.kind, top.name, top.parent, top.docstring, top.line) == ("module", "harbor", None, "Ships and berths.", 1)
    assert all(symbols[i].parent in symbols for i in defined), "every parent has a row"
    guards = {(r.path, r.bound_name): r.guard for r in t["imports"].collect()}
    assert guards["checks/tests/test_crane.py", "winch"] == "try_import" and guards["harbor/quay.py", "math"] is None
    assert [r.path for r in t["errors"].collect()] == ["wreck.py"]


def test_edges(world):
    files, t = world
    edges, unresolved = graph.build(files, t["symbols"], t["imports"], t["calls"])
    got = {(r.kind, r.source, r.target) for r in edges.collect()}
    assert ("inherits", "harbor/quay.py::harbor.quay.LongBerth", "harbor/quay.py::harbor.quay.Berth") in got
    assert ("calls", "harbor/crane.py::harbor.crane.lift", "harbor/quay.py::harbor.quay.assign") in got, "through the re-export, under its other name"
    assert ("calls", TEST, "harbor/crane.py::harbor.crane.lift") in got
    assert ("imports", "harbor/quay.py::harbor.quay", "harbor/crane.py::harbor.crane") in got
    assert ("contains", "harbor/quay.py::harbor.quay.LongBerth", "harbor/quay.py::harbor.quay.LongBerth.moor") in got
    reasons = {(r.kind, r.expression): r.reason for r in unresolved.collect()}
    assert reasons["call", "max"] == "builtin" and reasons["call", "pulley.turn"] == "external_module" and reasons["call", "ghost.pull"] == "dynamic_or_local"
    assert reasons["import", "math"] == "stdlib_module" and reasons["import", "pulley"] == "external_module"


def test_match_rate_and_tampering(world, spark):
    files, t = world
    edges, _ = graph.build(files, t["symbols"], t["imports"], t["calls"])
    edges = edges.cache()
    assert graph.match_rate(edges, edges, graph.EDGE_KEY).first().rate == 1.0
    tampered = edges.unionByName(edges.limit(1).withColumn("target", F.lit("x")))
    r = graph.match_rate(tampered, edges, graph.EDGE_KEY).first()
    assert (r.only_left, r.only_right) == (1, 0) and r.rate < 1
    none = edges.where("false")
    assert graph.match_rate(none, none, graph.EDGE_KEY).first().rate == 1.0


def test_impact_is_ordered_by_text(spark):
    symbols = spark.createDataFrame([("t", "a.py"), *((f"s{i}", f"f{i}.py") for i in range(12))], "id string, path string")
    edges = spark.createDataFrame([("calls", f"s{i}", "t", f"f{i}.py", i, "t") for i in range(12)] + [("calls", "t", "t", "a.py", 1, "t")], S.EDGES)
    got = graph.impact(edges, symbols, spark.createDataFrame([("a.py",)], "path string")).orderBy("rank").collect()
    assert [r.caller for r in got] == ["s0", "s1", "s10", "s11", "s2", "s3", "s4", "s5"] and got[0].truncated and got[0].total == 12


def test_waves_and_cycles(spark):
    nodes = spark.createDataFrame([(x,) for x in "abcdxy"], "node string")
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("c", "a"), ("x", "y"), ("y", "x"), ("d", "gone"), ("a", "a")], "source string, target string")
    assert {r.node: r.wave for r in graph.waves(nodes, edges).collect()} == {"a": 0, "d": 0, "b": 1, "c": 2, "x": 3, "y": 3}
    assert {r.node for r in graph.on_cycle(edges).collect()} == {"x", "y", "a"}


def test_long_cycles_and_chains(spark):
    """A ring of 100 with a tail in and out, and two rings joined by a bridge: only ring nodes wait for themselves."""
    ring = [(f"r{i}", f"r{(i + 1) % 100}") for i in range(100)] + [("in", "r0"), ("r5", "out"), ("out", "end")]
    two = [("a", "b"), ("b", "a"), ("b", "bridge"), ("bridge", "c"), ("c", "d"), ("d", "c")]
    got = {r.node for r in graph.on_cycle(spark.createDataFrame(ring + two, "source string, target string")).collect()}
    assert got == {f"r{i}" for i in range(100)} | set("abcd")
    assert graph.on_cycle(spark.createDataFrame([("a", "b"), ("b", "c")], "source string, target string")).count() == 0


def test_scope(world, spark):
    files, t = world
    edges, _ = graph.build(files, t["symbols"], t["imports"], t["calls"])
    changed = spark.createDataFrame([("harbor/quay.py",)], "path string")
    assert [tuple(r) for r in evidence.scope_files(edges, t["symbols"], changed).collect()] == [("harbor/quay.py", 0)]
    assert [tuple(r) for r in evidence.scope_files(edges, t["symbols"], changed, callers=True).collect()] == [("harbor/quay.py", 0), ("harbor/__init__.py", 1), ("harbor/crane.py", 1)]
    assert evidence.scope_files(edges, t["symbols"], changed, 1, True).count() == 1


def test_facts(world):
    files, t = world
    got = {r.top: r for r in dependencies.import_facts(t["imports"], files).collect()}
    assert (got["winch"].kind, got["winch"].bucket) == ("third_party", "optional")
    assert (got["pulley"].kind, got["pulley"].bucket) == ("third_party", "runtime")
    assert got["harbor"].kind == "internal" and got["math"].kind == "stdlib"


def test_innermost_equals_brute_force(spark):
    import random

    rng = random.Random(5)
    spans = [(f"p{i % 3}", f"s{i}", a := rng.randrange(1, 300), a + rng.randrange(0, 120), i) for i in range(60)]
    lines = [(f"p{p}", n, "t") for p in range(3) for n in range(1, 420, 3)]
    got = {(r.path, r.line): r.span.id for r in coverage.innermost(spark.createDataFrame(lines, "path string, line int, test_id string"), spark.createDataFrame(spans, "path string, id string, line int, end_line int, ordinal int"), ["path"], order=["ordinal"]).collect()}
    for p, n, _ in lines:
        fit = [(e - s, -o, i) for q, i, s, e, o in spans if q == p and s <= n <= e]
        assert got.get((p, n)) == (min(fit)[2] if fit else None)


def test_covered_symbols(world, spark):
    _, t = world
    path = "harbor/quay.py"
    lines = spark.createDataFrame([(path, 12, "a"), (path, 13, "a"), (path, 13, "b"), (path, 9, "a"), (path, 1, "a")], S.COVERAGE_LINES)
    got = {r.qualified_name: r for r in coverage.covered_symbols(lines, t["symbols"]).collect()}
    moor = got["harbor.quay.LongBerth.moor"]
    assert (moor.covered_lines, moor.covering_tests, moor.ratio, moor.possible, moor.ready, moor.ceiling) == (2, ["a", "b"], 1.0, True, False, 3)
    assert got["harbor.quay.LongBerth"].covered_lines == 1 and got["harbor.quay.assign"].focus_score == 0.0
    stats = coverage.coverage_statistics(coverage.covered_symbols(lines, t["symbols"])).first()
    assert (stats.symbols, stats.covered, stats.tests_per_covered) == (6, 2, 1.5), "modules own no lines"


def test_enclosing_credits_every_span(spark):
    spans = spark.createDataFrame([("p", "outer", 1, 200), ("p", "inner", 50, 60), ("q", "other", 1, 9)], "path string, id string, line int, end_line int")
    lines = spark.createDataFrame([("p", 55, "t"), ("p", 150, "t"), ("p", 201, "t")], S.COVERAGE_LINES)
    assert sorted((r.line, r.symbol_id) for r in coverage.enclosing(lines, spans).collect()) == [(55, "inner"), (55, "outer"), (150, "outer")]


def test_test_delta(spark):
    one = spark.createDataFrame([("t.py", "def test_a():\n    pass\n\nclass TestX:\n    def test_b(self):\n        assert 1\n    def helper(self): pass\n")], "path string, content string")
    two = spark.createDataFrame([("t.py", "def test_a():\n    assert 2\n\ndef test_c():\n    pass\n")], "path string, content string")
    got = {r.name: r.change for r in parse.test_delta(parse.test_functions(one), parse.test_functions(two)).collect()}
    assert got == {"test_a": "modified", "TestX.test_b": "removed", "test_c": "added"}


def test_regex_symbols(spark):
    files = spark.createDataFrame([("a.rs", "rust", "pub fn go() {}\nstruct S;\n"), ("b.go", "go", "func (s *T) Run() {}\ntype T struct{}\n"), ("c.ts", "typescript", "export class A {}\nexport async function f() {}\n")], "path string, language string, content string")
    assert sorted((r.path, r.kind, r.name, r.line) for r in parse.regex_symbols(files).collect()) == [("a.rs", "fn", "go", 1), ("a.rs", "struct", "S", 2), ("b.go", "func", "Run", 1), ("b.go", "type", "T", 2), ("c.ts", "class", "A", 1), ("c.ts", "function", "f", 2)]


def test_uncovered_targets(spark):
    rows = [("p/a.py", f"p.a.f{i}", 10 + i, True) for i in range(3)] + [("p/b.py", "p.b.g", 50, False), ("docs/c.py", "c.h", 99, True), ("p/a.py", "p.a._private", 99, True)]
    covered = spark.createDataFrame([(q, p, "function", q, n, 0, False, d) for p, q, n, d in rows], "id string, path string, kind string, qualified_name string, body_lines int, tests int, is_test boolean, has_docstring boolean")
    symbols = spark.createDataFrame([(q, "_" not in q) for _, q, _, _ in rows], "id string, is_public boolean")
    files = spark.createDataFrame([("p/__init__.py",), ("p/a.py",), ("p/b.py",), ("docs/c.py",)], "path string")
    got = lambda n: [r.id for r in coverage.uncovered_targets(covered, symbols, files, n).collect()]
    assert got(3) == ["p.a.f2", "p.b.g"], "nothing stands after the last module"
    assert got(2) == ["p.a.f2", "p.a.f1"], "the last slot takes any module"


OTHER = {
    ("a.rs", "rust"): "use std::fmt;\nuse crate::net::{Tcp, Udp};\n\npub async fn go(x: i32) -> i32 {\n    let s = \"}\";\n    x\n}\n\n#[test]\nfn checks() {\n    go(1);\n}\n",
    ("b_test.go", "go"): 'package b\n\nimport "fmt"\n\nimport (\n\t"os"\n\tx "net/http"\n)\n\nfunc (t *T) Run() {\n\tfmt.Println("os")\n}\n\nfunc TestRun(t *testing.T) {\n}\n',
    ("c.ts", "typescript"): "import { a } from './lib/util';\nimport 'side';\nconst q = require(\"q\");\nexport function f(x) {\n  return x;\n}\nconst g = async (y) => {\n  return y;\n};\nit('adds', () => {\n  f(1);\n});\n",
    ("d.cpp", "cpp"): '#include <vector>\n#include "net/tcp.h"\nint add(int a, int b) {\n  if (a) { return b; }\n  return a;\n}\nint later(int a);\nTEST(Add, Works) {\n}\n',
}


def test_other_languages(spark):
    files = spark.createDataFrame([(p, lang, c) for (p, lang), c in OTHER.items()], "path string, language string, content string")
    rows = parse.parse_other(files).cache()
    got = {}
    for r in rows.collect():
        got.setdefault(r.path, []).append((r.kind, r.name, r.line, r.end_line, r.is_test))
    assert got["a.rs"] == [("import", "std::fmt", 1, 1, False), ("import", "crate::net::{Tcp, Udp}", 2, 2, False), ("function", "go", 4, 7, False), ("function", "checks", 10, 12, True)]
    assert got["b_test.go"] == [("import", "fmt", 3, 3, False), ("import", "os", 6, 6, False), ("import", "net/http", 7, 7, False), ("function", "Run", 10, 12, False), ("function", "TestRun", 14, 15, True)]
    assert got["c.ts"] == [("import", "./lib/util", 1, 1, False), ("import", "side", 2, 2, False), ("import", "q", 3, 3, False), ("function", "f", 4, 6, False), ("function", "g", 7, 9, False), ("test", "adds", 10, 12, True)]
    assert got["d.cpp"] == [("import", "vector", 1, 1, False), ("import", "net/tcp.h", 2, 2, False), ("function", "add", 3, 6, False), ("test", "Add, Works", 8, 9, True)]
    owned = spark.createDataFrame([("src/lib/util.ts",), ("src/net.rs",), ("src/net/tcp.h",), ("old/net/tcp.h",), ("vector/x.h",)], "path string")
    found = {(r.path, r.wanted): r.target for r in graph.suffix_import(parse.wanted_files(rows), owned).collect()}
    assert found == {("c.ts", "lib/util"): "src/lib/util.ts", ("a.rs", "net"): "src/net.rs", ("d.cpp", "net/tcp"): "old/net/tcp.h"}
