"""What is left of the evidence pipeline: record guards, scopes, test designation, overlays, status ladders, cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import graph as G


def guard_records(rows: DataFrame, required: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected with problem): each required column must hold a value that casts to its type."""
    problems = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(f"missing:{c}")).when(F.col(c).cast("string").try_cast(kind).isNull(), F.lit(f"not_{kind}:{c}")) for c, kind in required.items())))
    marked = rows.withColumn("problem", F.get(problems, F.lit(0)))
    return marked.where("problem is null").drop("problem"), marked.where("problem is not null")


def callers_of(edges: DataFrame, symbol: str) -> DataFrame:
    return edges.where((F.col("target") == symbol) & (F.col("kind") != "contains")).orderBy("path", "line", "source")


def module_of_symbol(symbols: DataFrame, files: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, module) of wanted(id): that of the symbol's file; null where no symbol has that id or its file no module."""
    own = symbols.select("id", "path").join(files.select("path", "module"), "path", "left").select("id", "module")
    return wanted.select("id").distinct().join(own, "id", "left").groupBy("id").agg(F.min("module").alias("module"))


def contract_of(symbols: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, qualified_name, signature, docstring, module) of wanted(id); empty where no symbol has that id."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    module = F.coalesce(F.regexp_extract("parent", "::(.*)$", 1), F.lit(""))
    own = symbols.select("id", "qualified_name", "signature", "docstring", module.alias("module"))
    return wanted.select("id").distinct().join(own, "id", "left").select("id", *(text(c).alias(c) for c in ("qualified_name", "signature", "docstring", "module")))


def scope_files(edges: DataFrame, symbols: DataFrame, changed: DataFrame, most: int = 25, callers: bool = False) -> DataFrame:
    """(path, way): changed files in order (way 0), at most `most`. What a change impacts is listed by its targets, which are changed
    files themselves, so no others follow; with `callers`, the files that call into them do (way 1)."""
    c = changed.select("path").distinct()
    found = G.impact(edges, symbols, c, 1 << 30)
    found = found.select(F.regexp_replace("anchor", ":[0-9]+$", "").alias("path")) if callers else found.select(F.col("target_path").alias("path"))
    hit = found.distinct().join(c, "path", "left_anti")
    both = c.withColumn("way", F.lit(0)).unionByName(hit.withColumn("way", F.lit(1)))
    return both.orderBy("way", "path").limit(most)


def file_argument(nodes: DataFrame, files: DataFrame) -> DataFrame:
    """(node, argument): a dotted class name becomes the longest prefix that is a file, then the rest; paths stay."""
    head, name = F.regexp_extract("node", "^(.*)::[^:]*$", 1), F.substring_index("node", "::", -1)
    ready = ~F.col("node").contains("::") | head.contains("/") | F.split_part("node", F.lit("::"), F.lit(1)).endswith(".py")
    parts = F.filter(F.split(head, r"\."), lambda x: x != "")
    rows = nodes.select("node", ready.alias("ready"), parts.alias("parts"), name.alias("name"))
    tries = rows.where("not ready and size(parts) > 0").select("node", "parts", "name", F.explode(F.sequence(F.lit(1), F.size("parts"))).alias("n")).withColumn("path", F.concat(F.array_join(F.slice("parts", F.lit(1), F.col("n")), "/"), F.lit(".py")))
    best = tries.join(files.select("path").distinct(), "path").groupBy("node").agg(F.max_by(F.array_join(F.concat(F.array("path"), F.slice("parts", F.col("n") + 1, F.size("parts")), F.array("name")), "::"), "n").alias("argument"))
    return nodes.select("node").distinct().join(best, "node", "left").select("node", F.coalesce("argument", "node").alias("argument"))


def designate(arguments: DataFrame, files: DataFrame) -> DataFrame:
    """(path, names) of argument rows whose file exists; names are the local ids, sorted."""
    rows = arguments.select(F.split_part("argument", F.lit("::"), F.lit(1)).alias("path"), F.replace(F.regexp_extract("argument", "^[^:]*::(.*)$", 1), F.lit("::"), F.lit(".")).alias("name")).where("name <> ''")
    return rows.join(files.select("path").distinct(), "path", "left_semi").groupBy("path").agg(F.sort_array(F.collect_set("name")).alias("names"))


def declared_in(names: DataFrame, files: DataFrame) -> DataFrame:
    """(name, path): first file, in path order, that declares a Go or Rust function of that name."""
    found = files.select("path", F.explode(F.array_distinct(F.regexp_extract_all("content", F.lit(r"\b(?:fn|func)\s+([A-Za-z_][A-Za-z0-9_]*)\s*[(<]"), F.lit(1)))).alias("name"))
    return names.select("name").distinct().join(found, "name").groupBy("name").agg(F.min("path").alias("path"))


def overlay(base: DataFrame, over: DataFrame, keys: list[str]) -> DataFrame:
    """base with the rows of `over` in place of those of equal keys, and new ones added."""
    return base.join(over.select(*keys).distinct(), keys, "left_anti").unionByName(over)


def looks_like_test(path: Column) -> Column:
    """By name or a folder called tests, for files that were never parsed."""
    name = F.element_at(F.split(path, "/"), -1)
    return name.startswith("test_") | name.endswith("_test.py") | F.concat(F.lit("/"), path).contains("/tests/")


# Marks of a test in any language.
TEST_MARKS = ("test_", "_test.", ".test.", ".spec.", "/tests/", "/test/", "/spec/")


def looks_like_test_any(path: Column) -> Column:
    """In any language, without regard to case."""
    low = F.lower(F.replace(path, F.lit("\\"), F.lit("/")))
    return F.exists(F.array(*map(F.lit, TEST_MARKS)), lambda m: F.contains(low, m)) | F.element_at(F.split(low, "/"), -1).startswith("test")


def container_status(build: Column, identical: Column, baseline: Column, passed: Column) -> Column:
    return F.when(build != "built", "build_failed").when(~identical, "nondeterministic").when(~passed, "tests_failed").when(baseline.isin("matches", "matches_with_additions"), "verified").when(baseline == "no_baseline", "deterministic_unverified").otherwise("baseline_mismatch")


def baseline_match(outcomes: DataFrame, baseline: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, match) of test outcomes against a baseline: missing tests, then regressions, then additions."""
    o = outcomes.select(*keys, "test_id", F.col("status").alias("now"))
    b = baseline.select(*keys, "test_id", F.col("status").alias("was"))
    per = o.join(b, [*keys, "test_id"], "full_outer").groupBy(*keys).agg(F.count("was").alias("b"), F.count("now").alias("o"), F.count_if(F.col("now").isNull()).alias("gone"), F.count_if((F.col("was") == "passed") & F.col("now").isNotNull() & (F.col("now") != "passed")).alias("worse"), F.count_if(F.col("was").isNull()).alias("new"))
    match = F.when(F.col("b") == 0, "no_baseline").when(F.col("o") == 0, "container_produced_no_results").when(F.col("gone") > 0, "tests_missing_in_container").when(F.col("worse") > 0, "differs").when(F.col("new") > 0, "matches_with_additions").otherwise("matches")
    return per.select(*keys, match.alias("match"))


def hygiene_status(regressions: Column, check_exit: Column, format_exit: Column, before: Column, after: Column) -> Column:
    return F.when(regressions > 0, "regressed").when((check_exit != 0) | (format_exit != 0), "not_clean").when((before == "unavailable") | (after == "unavailable"), "complete_unverified").when(before == "no_tests", "complete_no_tests").otherwise("complete")


def newest_interpreter(versions: DataFrame, specs: Column) -> DataFrame:
    """The highest of versions(version) that meets every specifier."""
    from ..functions.numeric import satisfies, version_tuple

    fit = versions.where(F.forall(specs, lambda s: satisfies(F.col("version"), s)))
    return fit.agg(F.max_by("version", version_tuple(F.col("version"))).alias("version"))


def availability(counts: DataFrame) -> DataFrame:
    """(capability, status, count, reason): an error without rows is unavailable, with rows partial; null count was never asked."""
    status = F.when(F.col("count").isNull(), "not_collected").when(F.col("reason").isNull(), "available").when(F.col("count") > 0, "partial").otherwise("unavailable")
    return counts.select("capability", status.alias("status"), F.coalesce("count", F.lit(0)).alias("count"), "reason")


def tier_spread(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of the three tiers, absent ones as zero, and how often a verdict agrees with the measure if both are there."""
    out = [F.count_if(F.col("tier") == t).alias(t) for t in ("easy", "medium", "hard")]
    if "measured_tier" in rows.columns:
        out.append(F.count_if(F.col("tier") == F.col("measured_tier")).alias("agreement"))
    return rows.groupBy(*keys).agg(*out)


def language_counts(symbols: DataFrame) -> DataFrame:
    return symbols.groupBy("language", "kind").agg(F.count(F.lit(1)).alias("n"))


def render_cards(units: DataFrame, sections: DataFrame) -> DataFrame:
    """(subject, text) of units(subject, section, ordinal, unit) and budgeted sections(subject, section, priority, units, shown)."""
    body = units.join(sections, ["subject", "section"]).where(F.col("ordinal") < F.col("shown"))
    part = body.groupBy("subject", "section", "priority", "units", "shown").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "unit"))), lambda x: x["unit"]), "\n").alias("body"))
    head = F.concat(F.lit("## "), "section", F.when(F.col("shown") < F.col("units"), F.concat(F.lit("  ("), "shown", F.lit(" of "), "units", F.lit(" shown)"))).otherwise(F.lit("")))
    block = part.select("subject", "priority", F.concat(head, F.lit("\n"), "body").alias("block"))
    return block.groupBy("subject").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("priority", "block"))), lambda x: x["block"]), "\n\n").alias("text"))


def messages(blocks: DataFrame, system: str, most: int = 2_000) -> DataFrame:
    """(subject, messages) of blocks(subject, ordinal, title, lines): the system's words, then every block that has lines under its
    title, each cut at `most` characters."""
    body = F.substring(F.array_join("lines", "\n"), 1, most)
    rows = blocks.where(F.size("lines") > 0).select("subject", "ordinal", F.concat(F.lit("# "), "title", F.lit("\n"), body).alias("block"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "block"))), lambda x: x["block"]), "\n\n")
    said = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return rows.groupBy("subject").agg(text.alias("t")).select("subject", F.array(said("system", F.lit(system)), said("user", F.col("t"))).alias("messages"))


def docker_command(words: Column) -> Column:
    return F.concat(F.lit("CMD "), F.to_json(words))


def image_name(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9_.-]+", "-"), "^[-.]+|[-.]+$", "")
