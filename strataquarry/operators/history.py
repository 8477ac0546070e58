"""History: links between commits and pull requests, change mining, funnels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# How messages name a pull request.
MERGED = r"Merge pull request #([0-9]+)"
SQUASHED = r"(?m)\(#([0-9]+)\)[ \t]*$"


def with_precedence(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """first, and of second the rows whose keys first lacks."""
    return first.unionByName(second.join(first.select(*keys), keys, "left_anti"))


def link_pull_requests(commits: DataFrame, pulls: DataFrame) -> DataFrame:
    """(commit_sha, pr_number, method): merge commits of merged requests, then numbers in messages that exist."""
    shas = commits.select(F.col("sha").alias("commit_sha")).distinct()
    exact = pulls.where("merged_at is not null and merge_commit_sha is not null").select(F.col("merge_commit_sha").alias("commit_sha"), F.col("number").alias("pr_number")).join(shas, "commit_sha", "left_semi").distinct().withColumn("method", F.lit("github_merge_sha"))
    message = F.concat_ws("\n", "subject", F.coalesce("body", F.lit("")))
    numbers = F.array_union(F.regexp_extract_all(message, F.lit(MERGED), F.lit(1)), F.regexp_extract_all(message, F.lit(SQUASHED), F.lit(1)))
    said = commits.select(F.col("sha").alias("commit_sha"), F.explode(numbers).alias("n")).select("commit_sha", F.col("n").try_cast("long").alias("pr_number")).distinct()
    said = said.join(pulls.select(F.col("number").alias("pr_number")).distinct(), "pr_number", "left_semi").select("commit_sha", "pr_number").withColumn("method", F.lit("commit_message"))
    return with_precedence(exact, said, ["commit_sha", "pr_number"])


def resolve_heads(pulls: DataFrame, links: DataFrame, commits: DataFrame) -> DataFrame:
    """(number, head_sha, base_sha): merge sha, then a linked merge commit, then any linked one; base is its first parent."""
    c = commits.select(F.col("sha").alias("head_sha"), "is_merge", F.get("parent_shas", F.lit(0)).alias("base_sha"), "ordinal")
    own = pulls.select("number", F.col("merge_commit_sha").alias("head_sha"), F.lit(0).alias("way"))
    linked = links.select(F.col("pr_number").alias("number"), F.col("commit_sha").alias("head_sha"), F.lit(1).alias("way"))
    rows = own.unionByName(linked).join(c, "head_sha").withColumn("way", F.when((F.col("way") == 1) & ~F.col("is_merge"), 2).otherwise(F.col("way")))
    return rows.groupBy("number").agg(F.min_by(F.struct("head_sha", "base_sha"), F.struct("way", -F.col("ordinal"), "head_sha")).alias("r")).select("number", "r.*")


def drop_reason(steps: list[tuple[str, Column]]) -> Column:
    """First failing reason; null where none fails."""
    out = None
    for name, failed in steps:
        out = F.when(failed, name) if out is None else out.when(failed, name)
    return out


def funnel(rows: DataFrame, key: str, reason: str = "reason") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(totals, counts by reason, dropped rows (reason, key)). Ids stay rows: a common reason may hold most of them."""
    totals = rows.agg(F.count(F.lit(1)).alias("considered"), F.count_if(F.col(reason).isNull()).alias("kept"))
    drops = rows.where(F.col(reason).isNotNull())
    return totals, drops.groupBy(reason).agg(F.count(F.lit(1)).alias("dropped")), drops.select(reason, key)


def history_candidates(pulls: DataFrame, heads: DataFrame, deltas: DataFrame, modules: DataFrame, tests: DataFrame) -> DataFrame:
    """Signals of every merged request. deltas(number, path, churn); tests(number, added_tests, modified_tests)."""
    d = deltas.join(modules, "path", "left").withColumn("module", F.coalesce("module", "path")).withColumn("is_test", T.is_test_path(F.col("path"))).withColumn("python", F.col("path").endswith(".py"))
    code = F.col("python") & ~F.col("is_test")
    per = d.groupBy("number").agg(
        F.count(F.lit(1)).alias("files_changed"), F.sum("churn").alias("churn"), F.count_if("python").alias("python_files"), F.count_if(code).alias("source_files_changed"), F.count_if(F.col("python") & F.col("is_test")).alias("test_files_changed"),
        F.sort_array(F.collect_set(F.when(code, F.col("module")))).alias("modules"),
        F.coalesce(F.max(F.when(code, F.struct("churn", "path", "module"))), F.max(F.when(F.col("python"), F.struct("churn", "path", "module")))).alias("primary"),
    )
    rows = pulls.join(heads, "number", "left").join(per, "number", "left").join(tests, "number", "left")
    reason = drop_reason([("not_merged", F.col("merged_at").isNull()), ("head_unknown", F.col("head_sha").isNull()), ("no_parent", F.col("base_sha").isNull()), ("no_python_change", F.coalesce("python_files", F.lit(0)) == 0)])
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return rows.select(
        F.concat(F.lit("pr-"), "number").alias("candidate_id"), F.lit("history").alias("source"), "number", F.trim("title").alias("title"), "merged_at", "head_sha", "base_sha",
        F.when(F.size("modules") > 0, F.col("modules")).otherwise(F.array("primary.module")).alias("modules"), F.col("primary.module").alias("primary_module"), F.col("primary.path").alias("primary_path"),
        "files_changed", "churn", "source_files_changed", "test_files_changed", zero("added_tests").alias("added_tests"), zero("modified_tests").alias("modified_tests"),
        F.size("modules").alias("modules_touched"), F.length(F.coalesce("body", F.lit(""))).alias("body_length"), reason.alias("reason"),
    )


def numstat_sums(commits: DataFrame) -> DataFrame:
    """Sums over exploded changes, skipping the nulls of binary files; a merge has more than one parent."""
    rows = commits.select("sha", "parent_shas", F.explode_outer("changed_files").alias("c"))
    return rows.groupBy("sha").agg(F.sum("c.additions").alias("additions"), F.sum("c.deletions").alias("deletions"), F.count("c.path").alias("files"), (F.max(F.size("parent_shas")) > 1).alias("is_merge"))


def contributors(commits: DataFrame) -> DataFrame:
    return commits.agg(F.count_distinct("author_name", "author_email").alias("contributors"), F.count_if("is_merge").alias("merges"), F.count(F.lit(1)).alias("commits"))


def prefix_modules(paths: DataFrame, known: DataFrame) -> DataFrame:
    """(path, module): the known module, else the path without the longest source prefix that known paths show."""
    tail = F.replace("module", F.lit("."), F.lit("/"))
    shown = F.when(F.col("path").endswith(F.concat(tail, F.lit(".py"))), F.substring(F.col("path"), F.lit(1), F.length("path") - F.length(tail) - 3)).when(F.col("path").endswith(F.concat(tail, F.lit("/__init__.py"))), F.substring(F.col("path"), F.lit(1), F.length("path") - F.length(tail) - 12))
    prefixes = known.where("module is not null").select(shown.alias("prefix")).where("prefix is not null").distinct()
    parts = F.split("path", "/")
    heads = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.concat(F.array_join(F.slice(parts, F.lit(1), i), "/"), F.when(i > 0, F.lit("/")).otherwise(F.lit(""))))
    longest = paths.select("path", F.explode(heads).alias("prefix")).join(prefixes, "prefix").groupBy("path").agg(F.max_by("prefix", F.length("prefix")).alias("prefix"))
    bare = F.regexp_replace(F.regexp_replace(F.substring(F.col("path"), F.length(F.coalesce("prefix", F.lit(""))) + 1, F.length("path")), r"\.py$", ""), "/__init__$", "")
    guess = F.when(~F.col("path").endswith(".py"), F.col("path")).otherwise(F.coalesce(F.nullif(F.replace(bare, F.lit("/"), F.lit(".")), F.lit("")), F.col("path")))
    return paths.join(longest, "path", "left").join(known.select("path", F.col("module").alias("_m")), "path", "left").select("path", F.coalesce("_m", guess).alias("module"))
