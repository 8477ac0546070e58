import random

from strataquarry.operators import anchors, graph, parse


def test_lines_and_names_equal_plain_checks(spark):
    """Every kind of line end, spans over many buckets, repeated symbols, and files that are not there."""
    rng = random.Random(4)
    ends = ["\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x85", " "]
    texts = {f"f{i}": "".join(f"w{rng.randrange(40)} x{rng.choice(ends)}" for _ in range(rng.randrange(0, 90))) + rng.choice(["", "tail"]) for i in range(12)} | {"none": None, "empty": ""}
    symbols = [(f"{p}::{k}", p, rng.choice([f"w{rng.randrange(40)}", "tail", "x"]), rng.randrange(-1, 95), rng.randrange(0, 200)) for p in [*texts, "gone"] for k in range(9)]
    symbols.append(symbols[0])
    files = spark.createDataFrame(list(texts.items()), "path string, content string")
    df = spark.createDataFrame(symbols, "id string, path string, name string, line int, end_line int")
    lines = {p: (t or "").splitlines() for p, t in texts.items()}
    want = sorted((*s, 1 <= s[3] <= max(len(lines.get(s[1], ())), 1) and s[4] >= s[3]) for s in symbols)
    assert sorted(tuple(r)[:6] for r in anchors.check_lines(df, files).collect()) == want
    held = sorted((*s, any(s[2] in x for x in lines[s[1]][max(s[3], 1) - 1 : max(s[4], 0)])) for s in symbols if s[1] in lines)
    got = anchors.check_names(df, files, bucket=7).collect()
    assert sorted(tuple(r)[:6] for r in got) == held and all(r.valid == (r.reason is None) for r in got)
    rate = anchors.anchor_rate(anchors.check_names(df, files)).first()
    assert (rate.anchors_checked, rate.anchors_valid) == (len(held), sum(r[-1] for r in held))
    assert tuple(anchors.anchor_rate(anchors.check_names(df.limit(0), files)).first()) == (0, 0, 1.0)


def test_verify(spark):
    edges = spark.createDataFrame([("calls", "a", "b", "p", 1, "b"), ("calls", "a", "c", "p", 2, "c")], "kind string, source string, target string, path string, line int, expression string")
    symbols = spark.createDataFrame([("a", "f", "p", 1, 2, 0, 0, "a()")], "id string, kind string, path string, line int, end_line int, column int, end_column int, signature string")
    files = spark.createDataFrame([("p", "x\ny")], "path string, content string")
    same = anchors.verify(edges, edges, symbols, symbols, anchors.check_lines(symbols, files)).first()
    assert (same.status, same.edges_total, same.edge_rate, same.anchors_valid) == ("verified", 2, 1.0, 1)
    less = anchors.verify(edges, edges.limit(1), symbols, symbols, anchors.check_lines(symbols, files)).first()
    assert (less.status, less.edges_matched, less.edge_rate) == ("mismatched", 1, 0.5)
    none = anchors.verify(edges.limit(0), edges, symbols.limit(0), symbols.limit(0), anchors.check_lines(symbols.limit(0), files)).first()
    assert (none.status, none.edge_rate, none.edges_only_again) == ("verified", 1.0, 2)


def test_relative_imports(spark):
    """A file beside the importer comes before one of the same name elsewhere, then where the dots lead, then the nearest suffix."""
    owned = ["api/util.ts", "web/app/util.ts", "web/x.ts", "a/x.ts", "web/lib/deep/y.ts", "api/lib/deep/y.ts", "web/app/sub/index.js", "z/only.rs", "root.ts"]
    names = {"./util": "web/app/util.ts", "../x": "web/x.ts", "lib/deep/y": "web/lib/deep/y.ts", "./sub/../sub/index": "web/app/sub/index.js", "crate::only": "z/only.rs", "../../root": "root.ts", "../../../root": "root.ts", "./gone": None, "./util.js": "web/app/util.ts", "util": "web/app/util.ts"}
    rows = spark.createDataFrame([("web/app/main.ts", "import", n) for n in names], "path string, kind string, name string")
    wanted = parse.wanted_files(rows)
    out = graph.suffix_import(wanted, spark.createDataFrame([(p,) for p in owned], "path string"))
    got = sorted((r.wanted, r.target) for r in out.collect())
    plain = {"./util": "util", "../x": "x", "lib/deep/y": "lib/deep/y", "./sub/../sub/index": "sub/../sub/index", "crate::only": "only", "../../root": "root", "../../../root": "root", "./util.js": "util", "util": "util"}
    # what means the same file from the same place is one import
    assert set(got) == {(plain[n], names[n]) for n in plain} and len(got) == 7
    top = graph.suffix_import(parse.wanted_files(spark.createDataFrame([("main.ts", "import", "./root")], rows.schema)), spark.createDataFrame([("root.ts",), ("a/root.ts",)], "path string"))
    assert [r.target for r in top.collect()] == ["root.ts"]
