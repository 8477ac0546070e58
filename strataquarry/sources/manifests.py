"""Manifests, lock files, linter reports and CI files as rows. Inputs are rows of files(path, content) or lines(value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def locked_packages(lines: DataFrame) -> DataFrame:
    """(name, version) of name==version lines; indented lines, comments and options are none. The last pin of a name wins."""
    v = F.col("value")
    ok = (v != "") & ~v.rlike("^[ #-]") & v.contains("==")
    head = F.trim(F.substring_index(v, "\\", 1))
    rows = lines.where(ok).select("ordinal", F.trim(F.substring_index(head, "==", 1)).alias("name"), F.trim(F.regexp_extract(head, "==(.*)$", 1)).alias("version")).where("name <> ''")
    return rows.groupBy("name").agg(F.max_by("version", "ordinal").alias("version"))


def locked_count(lines: DataFrame) -> DataFrame:
    v = F.col("value")
    return lines.agg(F.count_if((v != "") & ~v.rlike("^[ #-]") & v.contains("==")).alias("packages"))


def lock_counts(files: DataFrame) -> DataFrame:
    """(path, packages) of Cargo.lock, go.sum, package-lock.json, pnpm-lock.yaml, yarn.lock; null where unreadable."""
    name = F.element_at(F.split("path", "/"), -1)
    lines = F.split("content", "\n")
    modules = F.array_distinct(F.transform(F.filter(F.transform(lines, lambda x: F.split(F.trim(x), "[ \t]+")), lambda p: F.size(p) >= 2), lambda p: F.concat_ws(" ", p[0], F.regexp_replace(p[1], "/go\\.mod$", ""))))
    keys = lambda at: F.json_object_keys(F.get_json_object("content", at))
    npm = F.coalesce(F.size(F.filter(keys("$.packages"), lambda k: k != "")), F.size(keys("$.dependencies")))
    count = (
        F.when(name == "Cargo.lock", F.size(F.split("content", r"\[\[package\]\]")) - 1)
        .when(name == "go.sum", F.size(modules))
        .when(name == "package-lock.json", F.when(npm >= 0, npm))
        .when(name == "pnpm-lock.yaml", F.size(F.filter(lines, lambda x: x.startswith("  /"))))
        .when(name == "yarn.lock", F.size(F.filter(lines, lambda x: ~x.rlike("^[ #]") & F.rtrim(x).endswith(":"))))
    )
    return files.where(name.isin("Cargo.lock", "go.sum", "package-lock.json", "pnpm-lock.yaml", "yarn.lock")).select("path", count.alias("packages"))


def install_report(requirements: DataFrame) -> DataFrame:
    """(name, extra) of requirements(value): 'name>=1; extra == "test"'; no marker, no extra."""
    extra = F.regexp_extract("value", r"extra\s*==\s*['\"]([^'\"]+)['\"]", 1)
    return requirements.select(T.requirement_name(F.trim("value")).alias("name"), F.when(extra != "", extra).alias("extra")).where("name <> ''")


def lint_findings(reports: DataFrame) -> DataFrame:
    """(tool, code, path, line) of reports(tool, content): ruff and eslint JSON, clippy JSON lines, vet and tidy text."""
    ruff = F.from_json("content", "array<struct<code:string,filename:string,location:struct<row:int>>>")
    es = F.from_json("content", "array<struct<filePath:string,messages:array<struct<ruleId:string,line:int>>>>")
    clippy = "reason string, message struct<level:string,code:struct<code:string>,spans:array<struct<file_name:string,line_start:int>>>"
    a = reports.where("tool = 'ruff'").select("tool", F.explode(ruff).alias("r")).select("tool", F.coalesce("r.code", F.lit("syntax")).alias("code"), F.col("r.filename").alias("path"), F.col("r.location.row").alias("line"))
    b = reports.where("tool = 'eslint'").select("tool", F.explode(es).alias("f")).select("tool", "f.filePath", F.explode("f.messages").alias("m")).select("tool", F.coalesce("m.ruleId", F.lit("parse")).alias("code"), F.col("filePath").alias("path"), F.col("m.line").alias("line"))
    rows = reports.select("tool", F.explode(F.split("content", "\n")).alias("x"))
    c = rows.where("tool = 'clippy'").select("tool", F.from_json("x", clippy).alias("c")).where("c.reason = 'compiler-message' and c.message.code is not null").select("tool", F.col("c.message.code.code").alias("code"), F.get("c.message.spans", F.lit(0))["file_name"].alias("path"), F.get("c.message.spans", F.lit(0))["line_start"].alias("line"))
    vet = r"^(?:vet: )?([^ :]+\.go):([0-9]+):(?:[0-9]+:)? (.*)$"
    d = rows.where("tool = 'vet'").where(F.col("x").rlike(vet)).select("tool", F.lit("vet").alias("code"), F.regexp_extract("x", vet, 1).alias("path"), F.regexp_extract("x", vet, 2).cast("int").alias("line"))
    tidy = r"^([^ :]+):([0-9]+):[0-9]+: (?:warning|error): .* \[([^\]]+)\]$"
    e = rows.where("tool = 'clang-tidy'").where(F.col("x").rlike(tidy)).select("tool", F.regexp_extract("x", tidy, 3).alias("code"), F.regexp_extract("x", tidy, 1).alias("path"), F.regexp_extract("x", tidy, 2).cast("int").alias("line"))
    return a.unionByName(b).unionByName(c).unionByName(d).unionByName(e)


def rule_counts(findings: DataFrame) -> DataFrame:
    return findings.groupBy("tool", "code").agg(F.count(F.lit(1)).alias("n"))


def _category(command: Column) -> Column:
    # Words of a command, first match wins.
    low = F.lower(command)
    return F.when(low.rlike("pytest|cargo test|go test|npm test|vitest|jest|ctest|make test"), "test").when(low.rlike("build|make|setup\\.py build_ext"), "build").when(low.rlike("pip install|npm install|cargo fetch|go mod download"), "setup")


def ci_facts(files: DataFrame) -> DataFrame:
    """(kind, value, path, ordinal) read line by line from workflows, makefiles and package.json; first of equals stays."""
    lines = files.where(F.col("path").rlike(r"^\.github/workflows/[^/]*\.y[^/]*ml$")).select("path", F.posexplode(F.split("content", "\n")).alias("ordinal", "x"))
    run = F.regexp_extract(F.trim("x"), r"^(?:- )?run:(.*)$", 1)
    command = F.regexp_replace(F.trim(run), r"^[\"']+|[\"']+$", "")
    cmds = lines.where(command != "").select(_category(command).alias("kind"), command.alias("value"), "path", "ordinal").where("kind is not null")
    apt = lines.select("path", "ordinal", F.explode(F.split(F.trim(F.regexp_extract("x", r"apt-get\s+install\s+(?:-[yq\s]+)?([a-zA-Z0-9_\-.\s]+)", 1)), r"\s+")).alias("value")).where("value <> '' and value not like '-%'").select(F.lit("system_package").alias("kind"), "value", "path", "ordinal")
    versions = lines.where(F.col("x").rlike("python-version:|node-version:|rust:|go-version:")).select(F.lit("matrix_version").alias("kind"), F.regexp_extract("x", r"([0-9]+(?:\.[0-9]+)*)", 1).alias("value"), "path", "ordinal").where("value <> ''")
    make = files.where(F.col("path").isin("Makefile", "makefile", "Justfile", "Taskfile.yml") & F.col("content").rlike(r"(?m)^(test|check|test-all|unit-test|tests):\s*.*$")).select(F.lit("test").alias("kind"), F.concat(F.lit("make -f "), "path", F.lit(" test")).alias("value"), "path", F.lit(0).alias("ordinal"))
    script = F.get_json_object("content", "$.scripts.test")
    npm = files.where((F.col("path") == "package.json") & script.isNotNull()).select(F.lit("test").alias("kind"), F.concat(F.lit("npm run test -- "), script).alias("value"), "path", F.lit(0).alias("ordinal"))
    build = files.where((F.col("path") == "package.json") & F.get_json_object("content", "$.scripts.build").isNotNull()).select(F.lit("build").alias("kind"), F.lit("npm run build").alias("value"), "path", F.lit(0).alias("ordinal"))
    every = cmds.unionByName(apt).unionByName(versions).unionByName(make).unionByName(npm).unionByName(build)
    return every.groupBy("kind", "value").agg(F.min(F.struct("path", "ordinal")).alias("at")).select("kind", "value", "at.path", "at.ordinal")


def project_profile(files: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row a repository of files(path, content): languages in order of precedence, primary, toolchain, test command."""
    has = lambda *names: F.coalesce(F.max(F.col("path").isin(*names)), F.lit(False))
    ends = lambda e: F.coalesce(F.max(F.col("path").rlike(rf"^(src/)?[^/]+\.{e}$")), F.lit(False))
    flags = files.groupBy(*keys).agg(
        has("Cargo.toml").alias("cargo"), has("package.json").alias("npm"), F.coalesce(F.max(F.col("path").rlike(r"(^|/)tsconfig\.json$")), F.lit(False)).alias("ts"), has("go.mod").alias("go"), has("CMakeLists.txt").alias("cmake"),
        has("pyproject.toml", "setup.py", "requirements.txt").alias("py"), has("pnpm-lock.yaml", "pnpm-workspace.yaml").alias("pnpm"), has("yarn.lock").alias("yarn"), has("poetry.lock").alias("poetry"), has("Pipfile").alias("pipenv"),
        F.coalesce(F.max((F.col("path") == "Cargo.toml") & F.col("content").contains("[workspace]")), F.lit(False)).alias("cargo_ws"), has("pnpm-workspace.yaml").alias("pnpm_ws"), has("go.work").alias("go_ws"),
        *(ends(e).alias(f"src_{e}") for e in ("py", "rs", "ts", "go", "cpp")),
    )
    js = F.when(F.col("ts"), "typescript").otherwise("javascript")
    manifest = F.array_compact(F.array(F.when(F.col("cargo"), "rust"), F.when(F.col("npm"), js), F.when(F.col("go"), "go"), F.when(F.col("cmake"), "cpp"), F.when(F.col("py"), "python")))
    source = F.array_compact(F.array(*(F.when(F.col(f"src_{e}"), n) for e, n in (("py", "python"), ("rs", "rust"), ("ts", "typescript"), ("go", "go"), ("cpp", "cpp")))))
    rows = flags.withColumn("languages", F.when(F.size(manifest) > 0, manifest).otherwise(source)).withColumn("primary", F.coalesce(F.get("languages", F.lit(0)), F.lit("python")))
    p = F.col("primary")
    node = F.when(F.col("pnpm"), "pnpm").when(F.col("yarn"), "yarn").otherwise("npm")
    python = F.when(F.col("poetry"), "poetry").when(F.col("pipenv"), "pipenv").otherwise("uv")
    tool = F.when(p == "rust", "cargo").when(p.isin("typescript", "javascript"), node).when(p == "go", "go").when(p == "cpp", "cmake").otherwise(python)
    mono = F.when(p == "rust", F.col("cargo_ws")).when(p.isin("typescript", "javascript"), F.col("pnpm") & F.col("pnpm_ws")).when(p == "go", F.col("go_ws")).otherwise(False)
    test = F.when(p == "rust", F.when(F.col("cargo_ws"), "cargo test --all").otherwise("cargo test")).when(p.isin("typescript", "javascript"), "npm test").when(p == "go", "go test ./...").when(p == "cpp", "ctest --output-on-failure").when(F.col("poetry"), "poetry run pytest -q").otherwise("python -m pytest -q")
    return rows.select(*keys, "languages", "primary", tool.alias("toolchain"), mono.alias("is_monorepo"), test.alias("test_command"))
