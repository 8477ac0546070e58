"""Gates over case results: (task, run, test_id, status, failure_class, signature). Each gate yields one verdict a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST = 25
# What a verifier must not read.
INTEGRITY = {
    "reads_git_history": r"\bgit\b[ \t\n,'\"\]\[]{0,8}(log|show|diff|rev-parse|blame|checkout)\b|\bdulwich\b|\bpygit2\b",
    "reads_solution_path": r"[\"'][^\"']*\b(solution|goldenSolution)\b[^\"']*[\"']",
    "reads_diff_artifact": r"\.(patch|diff)\b",
    "inspects_own_source": r"\binspect\.getsource\b|\b__file__ *\)? *\.read",
}
# What a solver must not find, and assertions that only one implementation can meet.
FORBIDDEN = (".git", ".strataquarry", "solution", "evidence", "goldenSolution.diff", "goldenSolution.md")
COUPLING = {
    "patched_internals": r"\b(?:mock\.)?patch(?:\.object)?[ \t]*\(",
    "exact_representation": r"\bassert[ \t]+repr[ \t]*\(|\bassert[ \t]+str[ \t]*\(|==[ \t]*repr[ \t]*\(",
    "type_identity": r"\btype[ \t]*\([^)]*\)[ \t]*(?:is|==)[ \t]",
}


def first_failing(steps: list[tuple[str, Column]]) -> Column:
    out = None
    for name, failed in steps:
        out = F.when(failed, name) if out is None else out.when(failed, name)
    return out


def both_runs(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """One full outer join of two runs on keys; columns b_* and a_*."""
    cols = lambda df, p: df.select(*keys, *(F.col(c).alias(f"{p}_{c}") for c in df.columns if c not in keys), F.lit(True).alias(f"in_{p}"))
    return cols(before, "b").join(cols(after, "a"), keys, "full_outer").withColumns({"in_b": F.coalesce("in_b", F.lit(False)), "in_a": F.coalesce("in_a", F.lit(False))})


def screen(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """What became of each test that passes after: absent_before, passing_both, ran_and_failed, failed_on_load."""
    rows = both_runs(before, after, keys).where("in_a and a_status = 'passed'")
    out = F.when(~F.col("in_b"), "absent_before").when(F.col("b_status") == "passed", "passing_both").when(F.col("b_failure_class").isin("assertion", "behavioral_exception"), "ran_and_failed").otherwise("failed_on_load")
    return rows.select(*keys, out.alias("outcome"))


def run_diff(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """regression, repair, disappeared, appeared of each test that changed."""
    rows = both_runs(before, after, keys)
    ok_b, ok_a = F.col("b_status") == "passed", F.col("a_status") == "passed"
    kind = F.when(~F.col("in_a"), "disappeared").when(~F.col("in_b"), "appeared").when(ok_b & ~ok_a, "regression").when(~ok_b & ok_a, "repair")
    return rows.select(*keys, kind.alias("change")).where("change is not null")


def _listed(flag: Column, key: str = "test_id") -> Column:
    """At most MOST of the flagged ids, sorted; the group is one task's tests."""
    return F.slice(F.sort_array(F.collect_set(F.when(flag, F.col(key)))), 1, MOST)


def fail_before(results: DataFrame, targets: DataFrame, keys: list[str], strict: bool = False) -> DataFrame:
    """Targets must be collected, fail, and fail for behaviour. results carry `collected`."""
    rows = targets.join(results, [*keys, "test_id"], "left")
    ok = ["assertion"] if strict else ["assertion", "behavioral_exception"]
    per = rows.groupBy(*keys).agg(F.count_if(F.col("status").isNull()).alias("missing"), F.count_if(F.col("status").isNotNull() & (F.col("status") != "failed")).alias("passing"), F.count_if((F.col("status") == "failed") & ~F.col("failure_class").isin(*ok)).alias("wrong"))
    coll = results.groupBy(*keys).agg(F.bool_and("collected").alias("collected"))
    per = coll.join(per, keys, "left")
    reason = first_failing([("no_targets_designated", F.col("missing").isNull()), ("collection_failed", ~F.col("collected")), ("targets_not_collected", F.col("missing") > 0), ("targets_did_not_fail", F.col("passing") > 0), ("failed_for_wrong_reason", F.col("wrong") > 0)])
    return per.select(*keys, F.lit("fail_before").alias("gate"), reason.isNull().alias("passed"), reason.alias("reason_code"))


def pass_after(results: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    per = targets.join(results, [*keys, "test_id"], "left").groupBy(*keys).agg(F.count_if(F.col("status").isNull()).alias("missing"), F.count_if(F.col("status").isNotNull() & (F.col("status") != "passed")).alias("failing"))
    per = results.groupBy(*keys).agg(F.bool_and("collected").alias("collected")).join(per, keys, "left")
    reason = first_failing([("collection_failed", ~F.col("collected")), ("targets_not_collected", F.col("missing") > 0), ("targets_did_not_pass", F.col("failing") > 0)])
    return per.select(*keys, F.lit("pass_after").alias("gate"), reason.isNull().alias("passed"), reason.alias("reason_code"))


def collateral(before: DataFrame, after: DataFrame, keys: list[str], ignore: DataFrame | None = None) -> DataFrame:
    """disappeared, then new infrastructure failures, then regressions; ignored tests count for neither first nor last."""
    rows = both_runs(before, after, [*keys, "test_id"])
    if ignore is not None:
        rows = rows.join(ignore.select(*keys, "test_id", F.lit(True).alias("ignored")).distinct(), [*keys, "test_id"], "left")
    skip = F.coalesce(F.col("ignored"), F.lit(False)) if ignore is not None else F.lit(False)
    gone = F.col("in_b") & ~F.col("in_a") & ~skip
    infra = F.col("in_a") & (F.col("a_failure_class") == "infrastructure") & (F.coalesce("b_failure_class", F.lit("passed")) != "infrastructure")
    worse = F.col("in_b") & (F.col("b_status") == "passed") & (F.coalesce("a_status", F.lit("")) != "passed") & ~skip
    per = rows.groupBy(*keys).agg(_listed(gone).alias("g"), _listed(F.coalesce(infra, F.lit(False))).alias("i"), _listed(worse).alias("w"))
    reason = first_failing([("tests_disappeared", F.size("g") > 0), ("new_infrastructure_failures", F.size("i") > 0), ("new_failures", F.size("w") > 0)])
    tests = F.when(F.size("g") > 0, F.col("g")).when(F.size("i") > 0, F.col("i")).otherwise(F.col("w"))
    return per.select(*keys, F.lit("collateral").alias("gate"), reason.isNull().alias("passed"), reason.alias("reason_code"), tests.alias("tests"))


def determinism(runs: DataFrame, keys: list[str], targets: DataFrame | None = None) -> DataFrame:
    """Runs agree on ids, then statuses, then (of targets) signatures; fewer than two runs prove nothing."""
    n = runs.groupBy(*keys).agg(F.count_distinct("run").alias("runs"))
    per = runs.groupBy(*keys, "test_id").agg(F.count_distinct("run").alias("in_runs"), F.count_distinct("status").alias("statuses"), F.count_distinct("signature").alias("signatures"))
    if targets is not None:
        per = per.join(targets.select(*keys, "test_id", F.lit(True).alias("target")).distinct(), [*keys, "test_id"], "left")
    else:
        per = per.withColumn("target", F.lit(True))
    sums = per.join(n, keys).groupBy(*keys).agg(F.max("runs").alias("runs"), F.count_if(F.col("in_runs") < F.col("runs")).alias("ids"), F.count_if(F.col("statuses") > 1).alias("statuses"), F.count_if(F.coalesce("target", F.lit(False)) & (F.col("signatures") > 1)).alias("signatures"))
    reason = first_failing([("insufficient_repeats", F.col("runs") < 2), ("unstable_collection", F.col("ids") > 0), ("unstable_status", F.col("statuses") > 0), ("unstable_signature", F.col("signatures") > 0)])
    return sums.select(*keys, F.lit("determinism").alias("gate"), reason.isNull().alias("passed"), reason.alias("reason_code"))


def integrity(files: DataFrame, keys: list[str]) -> DataFrame:
    """Files of a verifier that could read the answer, by finding; no files fail."""
    per = files.groupBy(*keys).agg(F.count("path").alias("files"), *(F.sort_array(F.collect_set(F.when(F.col("content").rlike(p), F.col("path")))).alias(n) for n, p in INTEGRITY.items()))
    found = sum((F.size(n) for n in INTEGRITY), F.lit(0))
    reason = first_failing([("no_verifier_files", F.col("files") == 0), ("verifier_can_read_answer", found > 0)])
    return per.select(*keys, F.lit("verifier_integrity").alias("gate"), reason.isNull().alias("passed"), reason.alias("reason_code"), *INTEGRITY)


def bundle_audit(files: DataFrame, keys: list[str]) -> DataFrame:
    """A solver's tree must hold no answer: forbidden names at its root, patches and caches anywhere."""
    parts = F.split("path", "/")
    bad = F.get(parts, F.lit(0)).isin(*FORBIDDEN) | F.col("path").rlike(r"\.(patch|diff)$") | F.array_contains(parts, "__pycache__")
    per = files.groupBy(*keys).agg(_listed(bad, "path").alias("paths"))
    return per.select(*keys, F.lit("solver_bundle").alias("gate"), (F.size("paths") == 0).alias("passed"), F.when(F.size("paths") > 0, "answer_reachable_from_input").alias("reason_code"), "paths")


def roll_up(verdicts: DataFrame, keys: list[str], tasks: DataFrame | None = None) -> DataFrame:
    """all_passed (false without verdicts), failed gates and reasons, in gate order. Tasks without verdicts count if given."""
    per = verdicts.groupBy(*keys).agg(F.bool_and("passed").alias("p"), F.sort_array(F.collect_list(F.when(~F.col("passed"), F.col("gate")))).alias("failed_gates"), F.sort_array(F.collect_set(F.when(~F.col("passed"), F.col("reason_code")))).alias("reason_codes"))
    if tasks is not None:
        per = tasks.select(*keys).distinct().join(per, keys, "left")
    none = F.array().cast("array<string>")
    return per.select(*keys, F.coalesce("p", F.lit(False)).alias("all_gates_passed"), F.coalesce("failed_gates", none).alias("failed_gates"), F.coalesce("reason_codes", none).alias("reason_codes"))


def eligible(tasks: DataFrame, verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """tasks(rejected) that are not rejected and have verdicts, all passed."""
    return tasks.where("rejected is null").join(roll_up(verdicts, keys).where("all_gates_passed"), keys, "left_semi")


def class_counts(results: DataFrame, keys: list[str]) -> DataFrame:
    return results.groupBy(*keys, "failure_class").agg(F.count(F.lit(1)).alias("n"))


def coupling(files: DataFrame, private: DataFrame | None = None) -> DataFrame:
    """(path, line, kind, name) of assertions that only one implementation can meet; comments and blank lines are skipped."""
    lines = files.select("path", F.posexplode(F.split("content", "\n")).alias("n", "text")).where((F.trim("text") != "") & ~F.ltrim("text").startswith("#"))
    at = (F.col("n") + 1).alias("line")
    kinds = F.array_compact(F.array(*(F.when(F.col("text").rlike(p), F.lit(k)) for k, p in COUPLING.items())))
    out = lines.select("path", at, F.explode(kinds).alias("kind"), F.lit(None).cast("string").alias("name"))
    if private is None:
        return out
    words = lines.select("path", at, F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"[A-Za-z_][A-Za-z0-9_]*"), F.lit(0)))).alias("name"))
    hits = words.join(private.select("name").distinct(), "name", "left_semi").groupBy("path", "line").agg(F.min("name").alias("name"))
    return out.unionByName(hits.select("path", "line", F.lit("private_references").alias("kind"), "name"))


def removed_on_purpose(before: DataFrame, after: DataFrame, declared: DataFrame, verifier_files: DataFrame) -> DataFrame:
    """(path, test) gone after the change, in verifier files, and no longer declared there. Tests are (path, name[param])."""
    gone = before.select("path", "test").distinct().join(after.select("path", "test").distinct(), ["path", "test"], "left_anti")
    gone = gone.join(verifier_files.select("path").distinct(), "path", "left_semi").withColumn("name", F.replace(F.regexp_replace("test", r"\[.*$", ""), F.lit("::"), F.lit(".")))
    return gone.join(declared.select("path", "name").distinct(), ["path", "name"], "left_anti").select("path", "test")


def stage_semantics(stages: DataFrame, rules: dict[str, Column], optional: tuple[str, ...] = ("adjudicate",)) -> DataFrame:
    """stages with status failed (degraded for optional ones) where the stage's own rule (true = broken) fires; others keep theirs."""
    status = None
    for name, broken in rules.items():
        hit = (F.col("stage") == name) & (F.col("status") == "ok") & F.coalesce(broken, F.lit(False))
        bad = "degraded" if name in optional else "failed"
        status = F.when(hit, bad) if status is None else status.when(hit, bad)
    return stages.withColumn("status", F.col("status") if status is None else status.otherwise(F.col("status")))


def stage_rules() -> dict[str, Column]:
    """Rules of the eleven stages for stage_semantics(): true where what a stage produced (columns as named) is no success. Null
    columns count as absent."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    measured = F.coalesce(F.col("regressions_verified"), F.lit(True))
    return {
        "hygiene": F.when(measured, text("result") != "complete").otherwise(text("result") != "complete_unverified"),
        "deps": ~F.coalesce(F.col("environment_available"), F.lit(True)) | ~text("result").startswith("locked"),
        "container": text("result") != "verified",
        "graph": text("result") != "verified",
        "coverage": text("result") != "available",
        "testgen": ~text("result").isin("generated", "not_needed"),
        "validate": n("eligible") < 10,
        "adjudicate": (text("note") != "") | (n("fell_back") > 0),
        "select": ~flag("satisfied"),
        "emit": (n("task_count") != 10) | ~flag("satisfied") | (n("leaking") > 0) | (n("invalid") > 0),
        "bundle": (n("missing") > 0) | (n("task_count") != 10),
    }


def stage_rollup(stages: DataFrame, keys: list[str], needed: tuple[str, ...] = ("emit", "bundle")) -> DataFrame:
    """ok (no failed stage), deliverable_complete (needed stages produced), total seconds."""
    produced = F.collect_set(F.when(F.col("status").isin("ok", "degraded"), F.col("stage")))
    return stages.groupBy(*keys).agg(F.bool_and(F.col("status") != "failed").alias("ok"), (F.size(F.array_except(F.array(*map(F.lit, needed)), produced)) == 0).alias("deliverable_complete"), F.sum("seconds").alias("seconds"))


def validation_summary(tasks: DataFrame, keys: list[str]) -> DataFrame:
    """(reason, n) of rejected tasks, by what stands before ':'; eligible ones under 'eligible'."""
    why = F.when(F.col("rejected").isNull(), F.when(F.col("all_gates_passed"), "eligible").otherwise("gates")).otherwise(F.split_part("rejected", F.lit(":"), F.lit(1)))
    return tasks.groupBy(*keys, why.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def run_health(runs: DataFrame) -> DataFrame:
    """runs(exit_code, output) with infrastructure: null if the exit code is a result, else timeout, out_of_memory, exit_n."""
    why = F.when(F.col("exit_code").isin(0, 1, 5), None).when(F.col("exit_code") == 124, "timeout").when((F.col("exit_code") == 137) | F.coalesce("output", F.lit("")).contains("Killed"), "out_of_memory").otherwise(F.concat(F.lit("exit_"), "exit_code"))
    return runs.withColumn("infrastructure", why)
