"""Sources of history records: JSON lines, JSON documents, git exports, pull-request pages, source trees, remotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.lineage import land

CORRUPT = "_corrupt_record"
# Between records of an export. Git's texts hold no NUL and a record has twelve fields, so no text makes this many in a row; and the
# mark does not overlap itself, so a split that begins inside one cannot be read another way.
RECORD_MARK = "\x1e" + "\x00" * 16
# Directories that hold no owned source, for Python trees and for trees of other languages.
SKIPPED_DIRS = (".git", ".strataquarry", ".venv", "venv", "env", ".tox", ".nox", ".mypy_cache", ".pytest_cache", ".ruff_cache", "__pycache__", "node_modules", "build", "dist", "site-packages", ".eggs")
SKIPPED_ANY = (".git", ".strataquarry", ".venv", "venv", "node_modules", "vendor", "target", "build", "dist", "__pycache__", ".tox", ".mypy_cache", ".pytest_cache", "third_party", "external")
# Languages by extension. A header counts as C++, whose grammar holds what C declares.
LANGUAGES = {"py": "python", "pyi": "python", "js": "javascript", "jsx": "javascript", "mjs": "javascript", "cjs": "javascript", "ts": "typescript", "tsx": "tsx", "rs": "rust", "go": "go", "c": "c", "h": "cpp", "cpp": "cpp", "hpp": "cpp", "cc": "cpp", "cxx": "cpp"}


def read_jsonl(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """parse_lines() of a text file."""
    return parse_lines(spark.read.text(path), schema)


def parse_lines(lines: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """(records, corrupt lines) of JSON lines(value). Blank and malformed lines and non-objects are no records; they can be counted."""
    lines = lines.where(F.trim("value") != "")
    rows = lines.select("value", F.from_json("value", f"{schema}, {CORRUPT} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"))
    good = F.col(f"r.{CORRUPT}").isNull() & F.ltrim("value").startswith("{")
    return rows.where(good).select("r.*").drop(CORRUPT), rows.where(~good).select(F.col("value").alias(CORRUPT))


def parse_documents(documents: DataFrame, schema: str) -> DataFrame:
    """documents(value, ...) with the fields of their JSON object and `available`, false where there is none."""
    keep = [c for c in documents.columns if c != "value"]
    rows = documents.select(*keep, F.from_json("value", schema).alias("_r"), F.try_parse_json("value").isNotNull().alias("available"))
    return rows.select(*keep, "_r.*", "available")


def transcripts(entries: DataFrame) -> DataFrame:
    """Model calls of cache entries(cache_key, value): one row each that parses; absent fields are empty or 0."""
    schema = "model string, response struct<content:string,finish_reason:string>, usage struct<prompt_tokens:long,completion_tokens:long>"
    rows = entries.where(F.try_parse_json("value").isNotNull()).select("cache_key", F.from_json("value", schema).alias("e"))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    n = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    return rows.select("cache_key", text("e.model").alias("model"), text("e.response.content").alias("content"), F.col("e.response.finish_reason").alias("finish_reason"), n("e.usage.prompt_tokens").alias("prompt_tokens"), n("e.usage.completion_tokens").alias("completion_tokens"))


def parse_status(raw: DataFrame) -> DataFrame:
    """(path, staged, unstaged, untracked) of porcelain status lines raw(value); blank lines are none. No rows: a clean tree."""
    v = F.col("value")
    mark = lambda i: F.when(F.substring(v, i, 1).isin(" ", "?"), None).otherwise(F.substring(v, i, 1))
    return raw.where(F.trim(v) != "").select(F.substring(v, 4, 1 << 30).alias("path"), mark(1).alias("staged"), mark(2).alias("unstaged"), v.startswith("??").alias("untracked"))


def read_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row of a JSON document, or one row of nulls with available = false where the file is absent."""
    try:
        return spark.read.schema(schema).option("multiLine", True).json(path).withColumn("available", F.lit(True))
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    return spark.sql("SELECT 1").select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in spark.createDataFrame([], schema).schema), F.lit(False).alias("available"))


def parse_commits(raw: DataFrame) -> DataFrame:
    """Commits of raw(ordinal, value): twelve NUL-separated fields of a show export, then its numstat lines.

    Fields: sha, parents, author name, e-mail, time, committer name, e-mail, time, refs, subject, body, numstat.
    """
    f = F.split("value", "\u0000", 12)
    names = ["sha", "parents", "author_name", "author_email", "authored_at", "committer_name", "committer_email", "committed_at", "refs", "subject", "body", "numstat"]
    rows = raw.select("ordinal", *(F.get(f, F.lit(i)).alias(n) for i, n in enumerate(names)))
    words = lambda c, sep: F.filter(F.transform(F.split(F.trim(F.coalesce(F.col(c), F.lit(""))), sep), lambda x: F.trim(x)), lambda x: x != "")
    lines = F.filter(F.split(F.coalesce(F.col("numstat"), F.lit("")), "[\n\u0000]"), lambda x: x.contains("\t"))
    changed = F.transform(lines, _change)
    rows = rows.withColumn("parent_shas", words("parents", " +")).withColumn("refs", words("refs", ",")).withColumn("changed_files", changed)
    total = lambda k: F.aggregate("changed_files", F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x[k], F.lit(0)))
    return rows.select("ordinal", "sha", "parent_shas", *names[2:8], "refs", "subject", F.regexp_replace("body", r"^\s+|\s+$", "").alias("body"), (F.size("parent_shas") > 1).alias("is_merge"), "changed_files", total("additions").alias("additions"), total("deletions").alias("deletions"))


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """Commits of export files as parse_commits() gives them: records of twelve NUL-separated fields, RECORD_MARK before or after each.

    Spark's text source cuts large files into splits at marks, so one file is read by many tasks. `ordinal` counts from 0 by file path
    and place: a first pass over the marks counts the records of each split, a second one parses. Ids of both passes agree because both
    are scans of one file listing. Bytes that are no UTF-8 become U+FFFD; a blank record is none.
    """
    lines = spark.read.option("lineSep", RECORD_MARK).text(path).select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_id"), F.make_valid_utf8(F.ltrim(F.col("value"), F.lit("\x00"))).alias("value"))
    found = lines.where(F.trim(F.col("value"), F.lit("\x00\n\r ")) != "")
    splits = found.groupBy("_file", "_at").agg(F.min("_id").alias("_first"), (F.max("_id") - F.min("_id") + 1).alias("_n"))
    # One row a split: 100 TB are under a million, so this window is small. Landed, its size is known when the join is planned: Spark
    # broadcasts it below its own limit, so texts stay where they are read, and shuffles beyond.
    splits = land(splits.select("_file", "_at", "_first", (F.sum("_n").over(Window.orderBy("_file", "_at")) - F.col("_n")).alias("_before")))
    raw = found.join(splits, ["_file", "_at"]).select((F.col("_before") + F.col("_id") - F.col("_first")).alias("ordinal"), "value")
    return parse_commits(raw)


def _change(line: Column) -> Column:
    p = F.split(line, "\t", 3)
    n = lambda i: F.get(p, F.lit(i)).try_cast("long")
    return F.struct(F.get(p, F.lit(2)).alias("path"), n(0).alias("additions"), n(1).alias("deletions"), (F.get(p, F.lit(0)) == "-").alias("binary"))


def parse_numstat(raw: DataFrame) -> DataFrame:
    """(path, additions, deletions, binary, churn) of numstat lines raw(value); unlike commits, binary files count 0."""
    c = raw.where(F.col("value").contains("\t")).select(_change(F.col("value")).alias("c")).select("c.*")
    n = lambda k: F.coalesce(k, F.lit(0))
    return c.select("path", n("additions").alias("additions"), n("deletions").alias("deletions"), "binary", (n("additions") + n("deletions")).alias("churn"))


def parse_refs(raw: DataFrame) -> DataFrame:
    """(kind, name, sha) of for-each-ref lines raw(value): sha, a space, the full ref."""
    ref = F.regexp_extract("value", r"^[0-9a-f]+ (.*)$", 1)
    kind = F.when(ref.startswith("refs/heads/"), "branch").when(ref.startswith("refs/tags/"), "tag").when(ref.startswith("refs/remotes/"), "remote").otherwise("other")
    return raw.select(kind.alias("kind"), F.regexp_replace(ref, r"^refs/(?:heads|tags|remotes)/", "").alias("name"), F.regexp_extract("value", r"^([0-9a-f]+)", 1).alias("sha"))


def pull_request_pages(pages: DataFrame, per_page: int = 100) -> tuple[DataFrame, DataFrame]:
    """(records, availability) of landed API pages(page, items, error). Pages after the first short or failed one do not count."""
    flat = pages.select("page", "items", "error", (F.coalesce(F.size("items"), F.lit(0)) < per_page).alias("short"))
    stop = flat.agg(F.coalesce(F.min(F.when(F.col("short") | F.col("error").isNotNull(), F.col("page"))), F.max("page")).alias("stop"))
    used = flat.join(F.broadcast(stop), F.col("page") <= F.col("stop"))
    rows = used.where("error is null").select(F.explode("items").alias("r")).select("r.*")
    count = F.sum(F.when(F.col("error").isNull(), F.size("items")).otherwise(0))
    state = used.agg(count.alias("count"), F.max("error").alias("reason")).select(F.lit("pull_requests").alias("capability"), F.when(F.col("reason").isNull(), "available").when(F.col("count") > 0, "partial").otherwise("unavailable").alias("status"), F.coalesce("count", F.lit(0)).alias("count"), "reason")
    return rows, state


def source_files(spark: SparkSession, root: str, extensions: tuple[str, ...] = ("py",), hidden: bool = True) -> DataFrame:
    """(path, content, sha256) of owned files below root, by extension, outside skipped directories.

    Spark's own listing leaves out what begins with a dot; rows of hidden folders from another listing go through owned().
    """
    glob = "*.{" + ",".join(extensions) + "}" if len(extensions) > 1 else f"*.{extensions[0]}"
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(root)
    base = F.regexp_replace(F.lit(root), r"^[a-z]+:/*|/+$", "")
    path = F.regexp_replace(F.split_part(F.regexp_replace("path", r"^[a-z]+:/*", "/"), F.concat(F.lit("/"), F.regexp_replace(base, "^/+", ""), F.lit("/")), F.lit(2)), "^/+", "")
    return owned(files.select(path.alias("path"), F.decode("content", "UTF-8").alias("content"), F.sha2("content", 256).alias("sha256")), hidden)


def owned(files: DataFrame, hidden: bool = True, skipped: tuple[str, ...] = SKIPPED_DIRS) -> DataFrame:
    """Rows of files(path, ...) outside skipped directories; hidden=False drops every hidden directory too."""
    dirs = F.slice(F.split("path", "/"), F.lit(1), F.greatest(F.size(F.split("path", "/")) - 1, F.lit(0)))
    keep = ~F.arrays_overlap(dirs, F.array(*map(F.lit, skipped)))
    if not hidden:
        keep &= ~F.exists(dirs, lambda d: d.startswith("."))
    return files.where(keep)


def scanned(files: DataFrame) -> DataFrame:
    """files(path, ...) in any known language with that language, outside skipped and hidden directories."""
    return owned(files, hidden=False, skipped=SKIPPED_ANY).withColumn("language", language_of(F.col("path"))).where("language is not null")


def language_of(path: Column) -> Column:
    table = F.create_map(*(F.lit(x) for kv in LANGUAGES.items() for x in kv))
    return F.element_at(table, F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)))


def resolve_spec(spec: Column) -> Column:
    """struct(kind, remote, owner, name) of a source: https or ssh remote, else a local path."""
    bare = T.canonical_remote(spec)
    remote = spec.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.-]*://|git@)")
    part = lambda i: F.when(remote, F.get(F.split(bare, "/"), F.lit(i)))
    return F.struct(F.when(spec.rlike("^(?:ssh://|git@)"), "ssh").when(remote, "https").otherwise("local").alias("kind"), F.when(remote, bare).otherwise(spec).alias("remote"), part(1).alias("owner"), part(2).alias("name"))
