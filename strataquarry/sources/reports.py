"""Test and coverage reports as rows: JUnit XML, Go events, Rust text, coverage contexts and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

ASSERTION, BEHAVIOUR, INFRA, PASSED, SKIPPED = "assertion", "behavioral_exception", "infrastructure", "passed", "skipped"
# Exceptions that mean nothing was loaded, and paths outside a repository.
LOAD_FAILURES = ("ImportError", "ModuleNotFoundError", "SyntaxError", "IndentationError", "CollectionError")
OUTSIDE = ("site-packages", "/lib/python", "dist-packages", "/usr/lib")
GO_BUILD = r"build failed|cannot find package|undefined:|syntax error|no required module"
JUNIT = "STRUCT<_classname: STRING, _name: STRING, failure: STRUCT<_VALUE: STRING, _message: STRING>, error: STRUCT<_VALUE: STRING, _message: STRING>, skipped: STRUCT<_VALUE: STRING, _message: STRING>>"


def failure_class(tag: Column, message: Column, trace: Column) -> Column:
    """Class of a failed case by origin: loading, assertion, repository frame; a trace from elsewhere is infrastructure."""
    message, trace = F.coalesce(message, F.lit("")), F.coalesce(trace, F.lit(""))
    name = F.substring_index(F.regexp_extract(message, r"^[ \t\n]*([A-Za-z_][A-Za-z0-9_.]*)[ \t]*:", 1), ".", -1)
    bare = F.trim(message)
    assertion = bare.startswith("AssertionError") | bare.startswith("assert ") | trace.rlike(r"(?m)^E [ \t]*(assert |AssertionError)")
    frames = F.regexp_extract_all(trace, F.lit(r"(?m)^([^ \t\n:][^:\n]*):[0-9]+: in "), F.lit(1))
    inside = F.exists(frames, lambda p: ~p.rlike("|".join(OUTSIDE)))
    return F.when(tag == "error", INFRA).when(name.isin(*LOAD_FAILURES), INFRA).when(assertion, ASSERTION).when(inside, BEHAVIOUR).when(trace != "", INFRA).otherwise(BEHAVIOUR)


def go_failure_class(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.rlike(GO_BUILD), INFRA).when(low.contains("panic:"), BEHAVIOUR).when(low.rlike("want|expected|got|assert|mismatch"), ASSERTION).otherwise(BEHAVIOUR)


def rust_failure_class(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.rlike("assertion|assert_eq|assert!"), ASSERTION).when(low.contains("panicked at"), BEHAVIOUR).when(F.trim(text) != "", BEHAVIOUR).otherwise(INFRA)


def junit_cases(reports: DataFrame) -> DataFrame:
    """(run, test_id, status, failure_class, signature, collected) of reports(run, xml)."""
    blocks = reports.select("run", F.explode(F.regexp_extract_all("xml", F.lit(r"(?s)<testcase\b[^>]*?/>|<testcase\b.*?</testcase>"), F.lit(0))).alias("x"))
    c = blocks.select("run", F.from_xml("x", JUNIT).alias("c")).select("run", "c.*")
    class_name, name = F.coalesce("_classname", F.lit("")), F.coalesce("_name", F.lit("<unnamed>"))
    failed = F.col("error").isNotNull() | F.col("failure").isNotNull()
    tag = F.when(F.col("failure").isNotNull(), "failure").otherwise("error")
    message = F.coalesce("failure._message", "failure._VALUE", "error._message", "error._VALUE", F.lit(""))
    trace = F.coalesce("failure._VALUE", "error._VALUE", F.lit(""))
    skipped = F.col("skipped").isNotNull() & ~failed
    return c.select(
        "run",
        F.when(class_name != "", F.concat(class_name, F.lit("::"), name)).otherwise(name).alias("test_id"),
        F.when(failed, "failed").when(skipped, SKIPPED).otherwise(PASSED).alias("status"),
        F.when(failed, failure_class(tag, message, trace)).when(skipped, SKIPPED).otherwise(PASSED).alias("failure_class"),
        F.when(failed, T.signature(message)).otherwise("").alias("signature"),
        (~((tag == "error") & failed & (class_name == ""))).alias("collected"),
    )


def collected(cases: DataFrame) -> DataFrame:
    """(run, collected): false if any case says that collection failed."""
    return cases.groupBy("run").agg(F.bool_and("collected").alias("collected"))


def go_cases(events: DataFrame) -> DataFrame:
    """Cases of go test events(run, ordinal, Action, Package, Test, Output): the last terminal action and all output."""
    done = F.col("Action").isin("pass", "fail", "skip")
    per = events.where(F.coalesce("Test", F.lit("")) != "").groupBy("run", F.concat_ws("::", F.coalesce("Package", F.lit("")), "Test").alias("test_id"))
    rows = per.agg(F.max_by(F.when(done, F.col("Action")), F.when(done, F.col("ordinal"))).alias("action"), F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("Action") == "output", F.struct("ordinal", F.coalesce("Output", F.lit("")).alias("o"))))), lambda x: x["o"]), "").alias("text")).where("action is not null")
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(F.replace(x, F.lit("\t"), F.lit(" ")))), lambda x: (x != "") & ~x.rlike("^(=== RUN|--- FAIL|--- PASS|=== PAUSE)"))
    passed = F.col("action") == "pass"
    return rows.select("run", "test_id", F.when(passed, PASSED).when(F.col("action") == "fail", "failed").otherwise(SKIPPED).alias("status"), F.when(passed, "").otherwise(go_failure_class(F.col("text"))).alias("failure_class"), F.when(passed, "").otherwise(T.signature(F.coalesce(F.get(lines, F.lit(0)), F.substring(F.trim("text"), 1, 200)))).alias("signature"))


def rust_cases(output: DataFrame) -> DataFrame:
    """Cases of libtest text output(run, text). A failure block belongs to the name that opened it until 'failures:'."""
    lines = output.select("run", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    name = F.regexp_extract(F.trim("line"), r"^---- ([^ ]+) stdout ----$", 1)
    mark = F.when(name != "", name).when(F.col("line").startswith("----") | F.col("line").startswith("failures:"), "")
    held = lines.withColumn("mark", mark).withColumn("block", F.last("mark", True).over(Window.partitionBy("run").orderBy("n")))
    text = held.where("mark is null and block <> ''").groupBy("run", F.col("block").alias("test_id")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), "\n").alias("text"))
    case = r"^test[ \t]+([^ \t]+)[ \t]+\.\.\.[ \t]+(ok|FAILED|ignored)"
    cases = lines.select("run", "n", F.regexp_extract(F.trim("line"), case, 1).alias("test_id"), F.regexp_extract(F.trim("line"), case, 2).alias("outcome")).where("test_id <> ''").groupBy("run", "test_id").agg(F.max_by("outcome", "n").alias("outcome"))
    body, passed = F.coalesce("text", F.lit("")), F.col("outcome") == "ok"
    return cases.join(text, ["run", "test_id"], "left").select("run", "test_id", F.when(passed, PASSED).when(F.col("outcome") == "FAILED", "failed").otherwise(SKIPPED).alias("status"), F.when(passed, "").otherwise(rust_failure_class(body)).alias("failure_class"), F.when(passed, "").otherwise(T.signature(body)).alias("signature"))


def coverage_contexts(documents: DataFrame) -> DataFrame:
    """(path, line, test_id) of documents(lines: path -> line -> contexts); unnamed contexts are dropped."""
    paths = documents.select(F.explode("lines").alias("path", "rows")).select("path", F.explode("rows").alias("line", "contexts"))
    return paths.select("path", F.col("line").cast("int").alias("line"), F.explode("contexts").alias("c")).select("path", "line", T.context_to_node(F.col("c")).alias("test_id")).where("test_id is not null").distinct()


def go_profile(lines: DataFrame, module: str = "") -> DataFrame:
    """(path, line) that profile lines(value) show as run: path:a.b,c.d statements hits."""
    p = r"^(.+):([0-9]+)\.[0-9]+,([0-9]+)\.[0-9]+ [0-9]+ ([0-9]+)$"
    g = lambda i: F.regexp_extract(F.trim("value"), p, i)
    path = F.when(g(1).startswith(module), F.regexp_replace(F.substring(g(1), len(module) + 1, 1 << 20), "^/+", "")).otherwise(g(1)) if module else g(1)
    rows = lines.where((g(1) != "") & (g(4).try_cast("long") > 0))
    return rows.select(path.alias("path"), F.explode(F.sequence(g(2).cast("int"), g(3).cast("int"))).alias("line")).distinct()


def go_test_list(lines: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(*keys, package, name, ordinal) of listing lines(*keys, ordinal, value): names wait for the summary line that tells their
    package. keys tell one listing from another; a listing is one group."""
    v = F.trim("value")
    total = v.startswith("ok ") | v.startswith("?") | v.startswith("FAIL")
    package = F.when(total, F.coalesce(F.get(F.split(v, "[ \t]+"), F.lit(1)), F.lit("")))
    ahead = Window.partitionBy(*keys).orderBy("ordinal").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = lines.select(*keys, "ordinal", v.alias("name"), total.alias("total"), F.first(package, True).over(ahead).alias("package"))
    return rows.where(~F.col("total") & F.col("name").rlike("^(Test|Benchmark|Fuzz|Example)")).select(*keys, F.coalesce("package", F.lit("")).alias("package"), "name", "ordinal")
