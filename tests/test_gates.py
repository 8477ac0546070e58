import random
from itertools import pairwise

import pytest
from pyspark.sql import functions as F

from strataquarry.operators import gates, history, rank

RESULT = "task string, test_id string, status string, failure_class string, collected boolean"


def results(spark, rows):
    return spark.createDataFrame([(t, i, s, c, True) for t, i, s, c in rows], RESULT)


def test_screen_and_diff(spark):
    before = results(spark, [("k", "a", "failed", "assertion"), ("k", "b", "passed", "passed"), ("k", "c", "failed", "infrastructure"), ("k", "gone", "passed", "passed"), ("k", "w", "passed", "passed")])
    after = results(spark, [("k", x, "passed", "passed") for x in "abcd"] + [("k", "w", "failed", "assertion")])
    assert {r.test_id: r.outcome for r in gates.screen(before, after, ["task", "test_id"]).collect()} == {"a": "ran_and_failed", "b": "passing_both", "c": "failed_on_load", "d": "absent_before"}
    assert {r.test_id: r.change for r in gates.run_diff(before, after, ["task", "test_id"]).collect()} == {"a": "repair", "c": "repair", "d": "appeared", "gone": "disappeared", "w": "regression"}


def test_fail_before_ladder(spark):
    rows = [("none", "x", "failed", "assertion"), ("ok", "x", "failed", "behavioral_exception"), ("pass", "x", "passed", "passed"), ("wrong", "x", "failed", "infrastructure"), ("miss", "y", "failed", "assertion")]
    targets = spark.createDataFrame([(t, "x") for t in ("ok", "pass", "wrong", "miss")], "task string, test_id string")
    got = {r.task: (r.passed, r.reason_code) for r in gates.fail_before(results(spark, rows), targets, ["task"]).collect()}
    assert got == {"none": (False, "no_targets_designated"), "ok": (True, None), "pass": (False, "targets_did_not_fail"), "wrong": (False, "failed_for_wrong_reason"), "miss": (False, "targets_not_collected")}
    strict = {r.task: r.reason_code for r in gates.fail_before(results(spark, rows), targets, ["task"], strict=True).collect()}
    assert strict["ok"] == "failed_for_wrong_reason"
    after = {r.task: r.reason_code for r in gates.pass_after(results(spark, rows), targets, ["task"]).collect()}
    assert after["pass"] is None and after["ok"] == "targets_did_not_pass" and after["miss"] == "targets_not_collected"


def test_collateral_precedence_and_ignore(spark):
    before = results(spark, [("g", "a", "passed", "passed"), ("g", "b", "passed", "passed"), ("w", "a", "passed", "passed"), ("i", "a", "passed", "passed"), ("f", "a", "passed", "passed")])
    after = results(spark, [("g", "b", "failed", "infrastructure"), ("w", "a", "failed", "assertion"), ("i", "a", "failed", "infrastructure"), ("f", "a", "passed", "passed")])
    got = {r.task: (r.reason_code, r.tests) for r in gates.collateral(before, after, ["task"]).collect()}
    assert got == {"g": ("tests_disappeared", ["a"]), "w": ("new_failures", ["a"]), "i": ("new_infrastructure_failures", ["a"]), "f": (None, [])}
    ignore = spark.createDataFrame([("g", "a")], "task string, test_id string")
    assert {r.task: r.reason_code for r in gates.collateral(before, after, ["task"], ignore).collect()}["g"] == "new_infrastructure_failures"


def test_determinism(spark):
    rows = [("ok", r, "a", "passed", "") for r in (1, 2)] + [("one", 1, "a", "passed", "")] + [("ids", 1, "a", "passed", ""), ("ids", 2, "b", "passed", "")] + [("st", 1, "a", "passed", ""), ("st", 2, "a", "failed", "")] + [("sig", 1, "a", "failed", "x"), ("sig", 2, "a", "failed", "y")]
    runs = spark.createDataFrame(rows, "task string, run int, test_id string, status string, signature string")
    assert {r.task: r.reason_code for r in gates.determinism(runs, ["task"]).collect()} == {"ok": None, "one": "insufficient_repeats", "ids": "unstable_collection", "st": "unstable_status", "sig": "unstable_signature"}
    none = spark.createDataFrame([], "task string, test_id string")
    assert {r.task: r.reason_code for r in gates.determinism(runs, ["task"], none).collect()}["sig"] is None


def test_roll_up_of_nothing_is_false(spark):
    verdicts = spark.createDataFrame([("a", "g1", True, None), ("a", "g2", False, "why"), ("b", "g1", True, None)], "task string, gate string, passed boolean, reason_code string")
    tasks = spark.createDataFrame([("a", None), ("b", None), ("c", None), ("d", "no")], "task string, rejected string")
    got = {r.task: (r.all_gates_passed, r.failed_gates, r.reason_codes) for r in gates.roll_up(verdicts, ["task"], tasks).collect()}
    assert got["a"] == (False, ["g2"], ["why"]) and got["b"] == (True, [], []) and got["c"] == (False, [], [])
    assert [r.task for r in gates.eligible(tasks, verdicts, ["task"]).collect()] == ["b"]


def test_integrity_bundle_and_coupling(spark):
    files = spark.createDataFrame([("a", "t.py", "subprocess.run(['git', 'show', 'HEAD'])"), ("b", "t.py", "assert f(1) == 2"), ("c", None, None), ("d", "x.patch", "")], "task string, path string, content string")
    got = {r.task: (r.reason_code, r.reads_git_history) for r in gates.integrity(files, ["task"]).collect()}
    assert got["a"] == ("verifier_can_read_answer", ["t.py"]) and got["b"] == (None, []) and got["c"][0] == "no_verifier_files"
    assert {r.task: r.passed for r in gates.bundle_audit(files, ["task"]).collect()} == {"a": True, "b": True, "c": True, "d": False}
    source = spark.createDataFrame([("t.py", "# mock.patch(x)\nmock.patch('a')\nassert repr(x) == 'y'\nif type(x) is int: _helper()\n")], "path string, content string")
    private = spark.createDataFrame([("_helper",), ("_other",)], "name string")
    assert sorted((r.line, r.kind, r.name) for r in gates.coupling(source, private).collect()) == [(2, "patched_internals", None), (3, "exact_representation", None), (4, "private_references", "_helper"), (4, "type_identity", None)]


def test_runs_and_stages(spark):
    runs = spark.createDataFrame([(0, ""), (1, ""), (124, ""), (137, ""), (2, "Killed"), (3, "")], "exit_code int, output string")
    assert [r.infrastructure for r in gates.run_health(runs).orderBy("exit_code").collect()] == [None, None, "out_of_memory", "exit_3", "timeout", "out_of_memory"]
    stages = spark.createDataFrame([("r", "emit", "ok", 1.0, 0), ("r", "bundle", "degraded", 2.0, 1), ("s", "emit", "ok", 1.0, 9)], "run string, stage string, status string, seconds double, tasks int")
    marked = gates.stage_semantics(stages, {"emit": F.col("tasks") == 0})
    got = {r.run: (r.ok, r.deliverable_complete, r.seconds) for r in gates.stage_rollup(marked, ["run"]).collect()}
    assert got == {"r": (False, False, 3.0), "s": (True, False, 1.0)}


def test_removed_on_purpose(spark):
    of = lambda *rows: spark.createDataFrame(rows, "path string, test string")
    declared = spark.createDataFrame([("t.py", "TestA.kept")], "path string, name string")
    files = spark.createDataFrame([("t.py",)], "path string")
    got = gates.removed_on_purpose(of(("t.py", "a[1]"), ("t.py", "TestA::kept"), ("u.py", "b"), ("t.py", "still")), of(("t.py", "still")), declared, files).collect()
    assert [(r.path, r.test) for r in got] == [("t.py", "a[1]")]


def pool(seed, n=40):
    rng = random.Random(seed)
    return [{"task_id": f"t{i:03}", "source": rng.choice(["history", "excision", "net_new"]), "group": f"m{rng.randrange(6)}", "score": round(rng.random(), 2)} for i in range(n)]


def uncapped(tasks, total, penalty):
    left, taken = list(tasks), []
    while left and len(taken) < total:
        best = max(left, key=lambda t: (t["score"] - penalty * sum(x["group"] == t["group"] for x in taken), t["task_id"]))
        left.remove(best)
        taken.append(best)
    return [t["task_id"] for t in taken]


def test_windows_equal_the_greedy_loop(spark):
    for seed in range(6):
        tasks = pool(seed)
        df = spark.createDataFrame([tuple(t.values()) for t in tasks], "task_id string, source string, `group` string, score double")
        got = [r.task_id for r in rank.diverse_top(df, [], "group", "score", "task_id", 10).orderBy("rank").collect()]
        assert got == uncapped(tasks, 10, 0.35)


def test_quota_selection(spark):
    tasks = pool(11)
    chosen = rank.choose(tasks)
    assert len(chosen) == 10 and sum(t["source"] == "history" for t in chosen) >= 4 and sum(t["source"] == "excision" for t in chosen) <= 4 and sum(t["source"] == "net_new" for t in chosen) <= 3
    df = spark.createDataFrame([("r", *t.values()) for t in tasks], "repo string, task_id string, source string, `group` string, score double")
    got = rank.select_quota(df, ["repo"]).orderBy("position").collect()
    assert [r.task_id for r in got] == [t["task_id"] for t in chosen], "the shortlist loses nothing"
    assert rank.shortfalls(spark.createDataFrame([(r.repo, r.source, r.group) for r in got], "repo string, source string, `group` string"), ["repo"]).count() == 0


def by_plain_loops(tasks, total=10, floors=4, caps=(("excision", 4), ("net_new", 3)), least=4, penalty=0.35):
    """What a selection must hold, one candidate at a time over the whole pool."""
    caps, taken = dict(caps), []
    have = lambda k, v: [t for t in taken if t[k] == v]
    while len(taken) < total:
        short = len(have("source", "history")) < floors
        pool = [t for t in tasks if t not in taken and len(have("source", t["source"])) < caps.get(t["source"], total)]
        first = [t for t in pool if t["source"] == "history"] if short else []
        if not (first or pool):
            break
        taken.append(max(first or pool, key=lambda t: (t["score"] - penalty * len(have("group", t["group"])), t["task_id"])))
    left = [t for t in tasks if t not in taken]
    while len(seen := {m for t in taken for m in t["modules"]}) < least:
        news = sorted((t for t in left if set(t["modules"]) - seen), key=lambda t: (-t["score"], t["task_id"]))
        outs = sorted((t for t in taken if news and t["source"] == news[0]["source"] and len(have("group", t["group"])) > 1), key=lambda t: t["task_id"])
        if not outs:
            break
        taken.remove(outs[0])
        taken.append(news[0])
        left.remove(news[0])
    return [t["task_id"] for t in taken]


def test_selection_with_module_sets_equals_plain_loops(spark):
    """Pools in which few groups lead, so that floors of modules must be repaired; the shortlist loses nothing."""
    rows, want = [], {}
    for seed in range(12):
        rng = random.Random(seed)
        tasks = []
        for i in range(rng.randrange(3, 60)):
            group = rng.choice(["core"] * 6 + ["api", "cli", "net", "db"][: 1 + seed % 4])
            more = rng.sample(["core", "api", "cli", "net", "db", "ui"], rng.randrange(3)) if rng.random() < 0.3 else []
            tasks.append({"task_id": f"{seed}-{i:03}", "source": rng.choice(["history", "excision", "net_new"]), "group": group, "score": round(rng.random() * (1 if group == "core" else 0.4), 2), "modules": sorted({group, *more})})
        want[seed] = by_plain_loops(tasks)
        assert [t["task_id"] for t in rank.choose(tasks)] == want[seed]
        rows += [(seed, t["task_id"], t["source"], t["group"], t["score"], t["modules"]) for t in tasks]
    df = spark.createDataFrame(rows, "repo int, task_id string, source string, `group` string, score double, modules array<string>")
    got = {}
    for r in rank.select_quota(df, ["repo"]).orderBy("repo", "position").collect():
        got.setdefault(r.repo, []).append(r.task_id)
    assert got == want
    assert any("diversity_repair" == r.reason for r in rank.select_quota(df, ["repo"]).collect())


def test_core_heavy_pool_is_spread():
    tasks = [{"task_id": f"core-{i}", "source": "history", "group": "core", "score": 0.9 - i / 100} for i in range(10)] + [{"task_id": "a", "source": "history", "group": "x", "score": 0.2}, {"task_id": "b", "source": "history", "group": "y", "score": 0.1}]
    chosen = rank.choose(tasks)
    assert {"core", "x", "y"} == {t["group"] for t in chosen} and len(chosen) == 10


def test_rank_history_and_coherence(spark):
    rows = [(f"pr-{i}", "history", f"title {i}", i % 3, i % 2, 1 + i % 4, 1, 10 * i, f"20{10 + i}-01-01", None, 3, 100 * i) for i in range(8)]
    df = spark.createDataFrame(rows, "candidate_id string, source string, title string, added_tests int, test_files_changed int, source_files_changed int, modules_touched int, body_length int, merged_at string, reason string, files_changed int, churn int")
    got = rank.rank_history(df).orderBy("rank").collect()
    assert [r.rank for r in got] == list(range(1, 9)) and all(a.score >= b.score for a, b in pairwise(got)) and all(r.cross_module_norm == 1.0 for r in got)
    wide = df.unionByName(df.limit(1).withColumns({"candidate_id": F.lit("w"), "files_changed": F.lit(900), "churn": F.lit(90_000)})).unionByName(df.limit(1).withColumns({"candidate_id": F.lit("g"), "title": F.lit("Merge branch")}))
    reasons = {r.candidate_id: r.reason for r in rank.coherent(wide).collect()}
    assert reasons["g"] == "generic_or_merge_title" and reasons["w"].startswith("change_too_broad:900_files") and reasons["pr-3"] is None


def test_difficulty(spark):
    rows = [(f"t{i}", float(i % 3), float(i), 1.0, float(10 * i), float(5 - i)) for i in range(5)]
    df = spark.createDataFrame(rows, "task_id string, coordinated_change double, cross_module double, misleading_similarity double, business_logic double, scale double")
    got = {r.task_id: r for r in rank.difficulty(df).collect()}
    assert sorted(r.tier for r in got.values()) == ["easy", "easy", "hard", "medium", "medium"]
    assert got["t4"].dominant == ["cross_module", "misleading_similarity"]
    text = rank.difficulty(df.withColumns({"churn": F.lit(50), "verifiers": F.lit(1)})).withColumn("ranked", rank.dominant({f: F.col(f"{f}_norm") for f in rank.FACTORS}, 5)).select("task_id", rank.justification().alias("j")).collect()
    assert all(r.j.startswith("This task ") and r.j.endswith(".") for r in text)


def commits(spark, rows):
    return spark.createDataFrame([(i, s, p, subject, body, len(p) > 1) for i, (s, p, subject, body) in enumerate(rows)], "ordinal long, sha string, parent_shas array<string>, subject string, body string, is_merge boolean")


def test_links(spark):
    c = commits(spark, [("aaaa", [], "x", ""), ("bbbb", ["aaaa"], "Fix it (#8)", "more (#9)\nMerge pull request #7 from x"), ("cccc", ["aaaa", "bbbb"], "Merge pull request #7", "")])
    pulls = spark.createDataFrame([(7, "2024-01-01", "aaaa"), (8, "2024-01-02", "zzzz"), (10, None, "bbbb")], "number long, merged_at string, merge_commit_sha string")
    links = history.link_pull_requests(c, pulls)
    assert sorted(tuple(r) for r in links.collect()) == [("aaaa", 7, "github_merge_sha"), ("bbbb", 7, "commit_message"), ("bbbb", 8, "commit_message"), ("cccc", 7, "commit_message")]
    heads = {r.number: (r.head_sha, r.base_sha) for r in history.resolve_heads(pulls, links, c).collect()}
    assert heads[7] == ("aaaa", None) and heads[8] == ("bbbb", "aaaa")


def test_history_candidates(spark):
    pulls = spark.createDataFrame([(1, "T", "b" * 30, "2024-01-01"), (2, "U", None, None), (3, "V", "", "2024-01-01")], "number long, title string, body string, merged_at string")
    heads = spark.createDataFrame([(1, "h", "b"), (3, "h3", "b3")], "number long, head_sha string, base_sha string")
    deltas = spark.createDataFrame([(1, "src/a.py", 9), (1, "src/b.py", 3), (1, "tests/test_a.py", 50), (1, "README.md", 70), (3, "docs.md", 1)], "number long, path string, churn long")
    modules = spark.createDataFrame([("src/a.py", "a"), ("src/b.py", "b")], "path string, module string")
    tests = spark.createDataFrame([(1, 2, 1)], "number long, added_tests int, modified_tests int")
    got = {r.candidate_id: r for r in history.history_candidates(pulls, heads, deltas, modules, tests).collect()}
    one = got["pr-1"]
    assert (one.modules, one.primary_module, one.source_files_changed, one.test_files_changed, one.churn, one.body_length, one.reason) == (["a", "b"], "a", 2, 1, 132, 30, None)
    assert got["pr-2"].reason == "not_merged" and got["pr-3"].reason == "no_python_change"


def test_prefix_modules(spark):
    known = spark.createDataFrame([("src/pkg/a.py", "pkg.a"), ("src/pkg/__init__.py", "pkg")], "path string, module string")
    paths = spark.createDataFrame([("src/pkg/a.py",), ("src/pkg/gone/x.py",), ("other/y.py",), ("notes.md",)], "path string")
    assert {r.path: r.module for r in history.prefix_modules(paths, known).collect()} == {"src/pkg/a.py": "pkg.a", "src/pkg/gone/x.py": "pkg.gone.x", "other/y.py": "other.y", "notes.md": "notes.md"}


@pytest.mark.parametrize(("enough", "groups", "want"), [(2, 1, [0, 1, 2]), (2, 2, [0, 1, 2, 3, 4]), (9, 1, list(range(6)))])
def test_until_enough(spark, enough, groups, want):
    rows = [(0, True, "a"), (1, False, "b"), (2, True, "a"), (3, False, "c"), (4, True, "b"), (5, True, "c")]
    df = spark.createDataFrame(rows, "pos int, ok boolean, module string")
    assert sorted(r.pos for r in rank.until_enough(df, [], [F.col("pos")], F.col("ok"), "module", enough, groups).collect()) == want
