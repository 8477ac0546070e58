import random
import re

import pytest
from pyspark.sql import functions as F

from strataquarry.functions import numeric as N
from strataquarry.functions import text as T


def col(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_contexts_and_ids(spark):
    assert col(spark, ["t.test_a.test_run|run", "t/a.py::test_b|setup", "", "plain"], T.context_to_node) == ["t.test_a::test_run", "t/a.py::test_b", None, "plain"]
    assert col(spark, ["a/b.py::test_x"], T.test_path) == ["a/b.py"]


def test_signature_and_scrub(spark):
    assert col(spark, ["ValueError: at 0x7fA in /a/b/c.py line 12\nmore"], T.signature) == ["ValueError: at 0xADDR in <path>/c.py line N"]
    assert col(spark, ["ran 1.25s 12 ms 0xff /tmp/x/y 2024-01-01T10:00:00Z a/b.go:10:4"], T.scrub) == ["ran <time> <time> <addr> <tmp> <timestamp> a/b.go:<line>"]


def test_sanitize(spark):
    body = "Fix it.\n```py\ncode\n```\n+added\n    indented\nSee `x` at https://e.x/y now"
    assert col(spark, [body], T.sanitize) == ["Fix it. See at now"]


def test_first_paragraph(spark):
    docs = [".. versionadded:: 1\n\n*Target gets results.*  And\nmore.\n\nNext", "short\n\nA paragraph that is long enough.", "", "w " * 150]
    got = col(spark, docs, T.first_paragraph)
    assert got[:3] == ["Target gets results. And more.", "A paragraph that is long enough.", ""]
    assert got[3].endswith("…") and len(got[3]) <= 201


def test_tokens_and_names(spark):
    assert col(spark, ["a_1 += für(2)"], T.tokens) == [re.findall(r"[A-Za-z_][A-Za-z0-9_]*|[^\sA-Za-z0-9_]", "a_1 += für(2)")]
    assert col(spark, ["Foo_Bar.baz", "a--b"], T.package_name) == ["foo-bar-baz", "a--b"]
    assert col(spark, ["requests[socks]>=2; x", "a ~= 1"], T.requirement_name) == ["requests", "a"]
    assert col(spark, ["t.py::test_adds_two", "x"], T.humanise) == ["adds two", "x"]


@pytest.mark.parametrize(("url", "want"), [("https://tok@GitHub.com/O/N.git", "github.com/o/n"), ("git@github.com:O/n.git", "github.com/o/n"), ("ssh://git@github.com/o/n/", "github.com/o/n")])
def test_remotes(spark, url, want):
    assert col(spark, [url], T.canonical_remote) == [want]


def test_relative_imports(spark):
    rows = [("pkg.mod", "x", 0, False, "x"), ("pkg.mod", "x", 1, False, "pkg.x"), ("pkg", "x", 1, True, "pkg.x"), ("pkg.sub.mod", "", 2, False, "pkg"), ("pkg.sub", "y", 2, True, "pkg.y"), ("", "", 1, False, "")]
    df = spark.createDataFrame(rows, "c string, m string, l int, p boolean, want string")
    for r in df.select("want", T.resolve_relative(*map(F.col, "cmlp")).alias("got")).collect():
        assert r.got == r.want


def test_paths_and_dates(spark):
    assert col(spark, ["a/test_x.py", "tests/x.py", "tests.py", "a/b_test.py", "Tests/a.py"], T.is_test_path) == [True, True, False, True, False]
    assert col(spark, ["2024-03-05T1", None, "bad", "2024-xx-01"], T.merged_ordinal) == [2024 * 372 + 3 * 31 + 5, 0, 0, 0]


def percentile(values, f):
    s = sorted(values)
    return s[max(0, min(len(s) - 1, round(f * (len(s) - 1))))]


def test_nearest_rank_equals_its_definition(spark):
    rng = random.Random(1)
    rows = [(g, rng.randrange(8)) for g in range(12) for _ in range(g + 1)]
    df = spark.createDataFrame(rows, "g int, v int")
    fs = {"a": 0.33, "b": 0.5, "c": 0.9, "d": 1 / 3}
    for make in (N.nearest_rank, N.counted_rank):
        for r in make(df, ["g"], "v", fs).collect():
            own = [v for g, v in rows if g == r.g]
            assert r.n == len(own) and all(r[k] == percentile(own, f) for k, f in fs.items())


def test_min_max_of_constants_is_one(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (1, 5.0, 3.0), (2, 0.0, 2.0)], "g int, a double, b double")
    got = sorted((r.g, r.a_norm, r.b_norm) for r in N.with_min_max(df, ["g"], ["a", "b"]).collect())
    assert got == [(1, 1.0, 0.0), (1, 1.0, 1.0), (2, 1.0, 1.0)]


def test_ceiling_tiers_and_focus(spark):
    df = spark.createDataFrame([(0,), (10,), (30,), (50,), (202,)], "n long")
    assert [r[0] for r in df.select(N.ceiling_of(F.col("n"))).collect()] == [12, 3, 4, 8, 30]
    third = N.equal_thirds(spark.range(7), [], [F.col("id")])
    assert [r.tier for r in third.orderBy("id").collect()] == [min(2, i * 3 // 7) for i in range(7)]
    one = spark.range(1).select(N.focus_score(F.lit(1.0), F.lit(2), F.lit(12), F.lit(12), F.lit(True)).alias("x")).first().x
    assert one == pytest.approx(1.0)


@pytest.mark.parametrize(("v", "spec", "want"), [("3.12", ">=3.10", True), ("3.9", ">=3.10", False), ("3.12", "<4", True), ("3.12.1", "==3.12.*", True), ("3.12", "!=3.12.0", False), ("3.11", "~=3.10", True), ("3.1", "<3.10", True), ("3.10", ">3.10.0", False)])
def test_version_specifiers(spark, v, spec, want):
    assert spark.range(1).select(N.satisfies(F.lit(v), F.lit(spec))).first()[0] is want


def test_ranks_of_a_whole_table(spark):
    df = spark.range(5_000).select("id", (F.col("id") * 7919 % 997).alias("v")).repartition(7)
    got = N.with_rank(df, [], [F.desc("v"), F.col("id")], total="n").collect()
    want = {i: k for k, (_, i) in enumerate(sorted((-(i * 7919 % 997), i) for i in range(5_000)), 1)}
    assert {r.id: r["rank"] for r in got} == want and {r.n for r in got} == {5_000}
    assert N.with_rank(df.where("false"), [], [F.col("id")]).count() == 0
