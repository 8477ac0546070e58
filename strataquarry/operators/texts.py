"""Text checks: leakage, instruction quality, grounding, cards, usage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.joins import dealt
from ..functions.lineage import cut

NGRAM = 5
#: Rows that a join may broadcast: token runs of this number take some tens of megabytes.
FEW = 200_000
# How an added line defines a name.
DEFINED = r"^(?:async[ \t]+)?(?:def|class)[ \t]+([A-Za-z_][A-Za-z0-9_]*)"
ASSIGNED = r"^([A-Za-z_][A-Za-z0-9_]*)[ \t]*(?::[^=]+)?=[^=]"


def ngrams(tokens: Column, n: int = NGRAM) -> Column:
    """Runs of n tokens, lower case, joined by spaces; none where there are fewer."""
    k = F.size(tokens)
    return F.when(k >= n, F.transform(F.sequence(F.lit(1), k - n + 1), lambda i: F.lower(F.array_join(F.slice(tokens, i, n), " ")))).otherwise(F.array().cast("array<string>"))


def spans_of(df: DataFrame, keys: list[str], text: Column, n: int = NGRAM) -> DataFrame:
    """(keys, at, span) of every token run, lower case. Shifted arrays are zipped, which stays inside generated code."""
    t = F.col("_tokens")
    shifted = F.arrays_zip(*(F.slice(t, i + 1, F.size(t)).alias(f"t{i}") for i in range(n)))
    rows = df.select(*keys, T.tokens(text).alias("_tokens")).select(*keys, F.posexplode(shifted).alias("at", "s"))
    return rows.where(F.col("s").getField(f"t{n - 1}").isNotNull()).select(*keys, "at", F.lower(F.concat_ws(" ", *(F.col("s").getField(f"t{i}") for i in range(n)))).alias("span"))


def overlap(left: DataFrame, right: DataFrame, key: str, other: str, n: int = NGRAM, known: DataFrame | None = None) -> DataFrame:
    """(key, other, spans): distinct token runs that a left and a right text share and `known` texts lack.

    An equi-join on the run: the left side's runs are only made distinct where they meet the right side. The right side's runs
    are written and counted first; up to FEW of them travel to the left side's tasks, so that its runs are never shuffled.
    """
    b = spans_of(right, [other], F.col("text"), n).select(other, "span").distinct()
    if known is not None:
        b = b.join(spans_of(known, [], F.col("text"), n).select("span").distinct(), "span", "left_anti")
    b = cut(b)
    b = F.broadcast(b) if b.limit(FEW + 1).count() <= FEW else b.hint("merge")
    return spans_of(left, [key], F.col("text"), n).select(key, "span").join(b, "span").groupBy(key, other).agg(F.count_distinct("span").alias("spans"))


def copied_lines(instructions: DataFrame, diffs: DataFrame, base: DataFrame | None = None, n: int = NGRAM) -> DataFrame:
    """(task_id, line_no, span): of each added line the first token run that the instruction holds and the base tree does not.

    Runs are compared token by token, so a run never matches inside a longer identifier.
    """
    lines = diffs.select("task_id", F.posexplode(T.added_lines(F.col("diff"))).alias("line_no", "line"))
    spans = spans_of(lines, ["task_id", "line_no"], F.col("line"), n)
    hits = spans.join(dealt(spans_of(instructions, ["task_id"], F.col("text"), n).select("task_id", "span").distinct()), ["task_id", "span"])
    if base is not None:
        hits = hits.join(dealt(spans_of(base, ["task_id"], F.col("text"), n).select("task_id", "span").distinct()), ["task_id", "span"], "left_anti")
    return hits.groupBy("task_id", "line_no").agg(F.min_by("span", "at").alias("span"))


def novel_names(diffs: DataFrame, base: DataFrame) -> DataFrame:
    """(task_id, name, private) defined by added lines and absent from base(task_id, name)."""
    lines = diffs.select("task_id", F.explode(T.added_lines(F.col("diff"))).alias("x"))
    name = F.coalesce(F.nullif(F.regexp_extract("x", DEFINED, 1), F.lit("")), F.nullif(F.regexp_extract("x", ASSIGNED, 1), F.lit("")))
    names = lines.select("task_id", name.alias("name")).where("name is not null").distinct()
    return names.join(dealt(base.select("task_id", "name").distinct()), ["task_id", "name"], "left_anti").withColumn("private", F.col("name").startswith("_"))


def leaked_names(instructions: DataFrame, diffs: DataFrame, base: DataFrame) -> DataFrame:
    """(task_id, name, private) of novel names that the task's instruction(task_id, text) mentions. A private one is a leak."""
    said = instructions.select("task_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Za-z_][A-Za-z0-9_]*"), F.lit(0)))).alias("name"))
    return novel_names(diffs, base).join(dealt(said), ["task_id", "name"], "left_semi")


def leak_verdict(instructions: DataFrame, diffs: DataFrame, base: DataFrame, tree: DataFrame | None = None) -> DataFrame:
    """(task_id, clean, copied_spans, private_names, public_names) of every instruction: copied token runs or private names are no clean one."""
    copied = copied_lines(instructions, diffs, tree).groupBy("task_id").agg(F.array_sort(F.collect_list("span")).alias("copied_spans"))
    names = leaked_names(instructions, diffs, base).groupBy("task_id").agg(F.sort_array(F.collect_set(F.when(F.col("private"), F.col("name")))).alias("private_names"), F.sort_array(F.collect_set(F.when(~F.col("private"), F.col("name")))).alias("public_names"))
    none = F.array().cast("array<string>")
    rows = instructions.select("task_id").distinct().join(dealt(copied), "task_id", "left").join(dealt(names), "task_id", "left")
    rows = rows.select("task_id", *(F.coalesce(c, none).alias(c) for c in ("copied_spans", "private_names", "public_names")))
    return rows.select("task_id", ((F.size("copied_spans") == 0) & (F.size("private_names") == 0)).alias("clean"), "copied_spans", "private_names", "public_names")


def quality_flags(title: Column, text: Column) -> Column:
    """Problems of an instruction, in a fixed order."""
    count = lambda c: F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))
    return F.array_compact(F.array(
        F.when(F.length(F.trim(text)) < 120, "too_short"),
        F.when(F.length(text) > 5_000, "too_long"),
        F.when(F.trim(title).rlike(T.GENERIC_TITLE), "generic_title"),
        F.when(text.contains("Implement the behaviour so that") & text.contains(" hold."), "placeholder_grammar"),
        F.when(count("[") != count("]"), "broken_markdown"),
        F.when(text.rlike(r"(?i)\b(?:TODO|TBD|describe-only constraint)\b"), "template_placeholder"),
    ))


def bare_entity(value: Column) -> Column:
    """A cited id without what follows a parenthesis, bar, dash or double blank."""
    return F.trim(F.regexp_extract(F.trim(value), r"^(.(?:(?!\(| \||  | —).)*)", 1))


def grounding(cited: Column, known: Column) -> Column:
    """struct(grounded, cited, unknown, coverage) of cited against known ids."""
    bare = F.filter(F.transform(cited, bare_entity), lambda x: x != "")
    unknown = F.sort_array(F.array_except(bare, known))
    some = (F.size(bare) > 0) | (F.size(known) == 0)
    share = F.when(F.size(known) > 0, F.size(F.array_intersect(F.array_distinct(bare), known)) / F.size(F.array_distinct(known))).otherwise(0.0)
    return F.struct(((F.size(unknown) == 0) & some).alias("grounded"), F.size(bare).alias("cited"), unknown.alias("unknown"), share.alias("coverage"))


def card_summary(cards: DataFrame) -> DataFrame:
    return cards.groupBy("status").agg(F.count(F.lit(1)).alias("cards"), F.avg(F.when(F.col("grounded"), F.col("coverage"))).alias("mean_coverage"))


def budgeted(sections: DataFrame, keys: list[str], budget: int = 40) -> DataFrame:
    """sections(priority, units, cap, required) with shown: required ones to their cap, others from what earlier ones left."""
    cap = F.least("units", F.coalesce("cap", "units"))
    free = sections.withColumn("_want", cap).withColumn("_draw", F.when(F.col("required"), 0).otherwise(F.col("_want")))
    used = F.coalesce(F.sum("_draw").over(Window.partitionBy(*keys).orderBy("priority").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shown = F.when(F.col("required"), F.col("_want")).otherwise(F.greatest(F.lit(0), F.least(F.col("_want"), F.lit(budget) - used)))
    return free.withColumn("shown", shown.cast("long")).drop("_want", "_draw")


def usage(calls: DataFrame) -> DataFrame:
    """Calls, tokens, cost by model, with the grand total under a null model."""
    return calls.rollup("model").agg(F.count(F.lit(1)).alias("calls"), F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"), F.sum("cost").alias("cost"))


def first_title(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """rows with keep: the first of each normalised title. order must tell rows apart; the first of a title is a combinable minimum,
    so that a title which most rows share (none, say) is never sorted in one task."""
    title = T.title_key(F.col("title"))
    first = rows.groupBy(*(F.col(k).alias(f"_k_{k}") for k in keys), title.alias("_title")).agg(F.min(F.struct(*order)).alias("_first"))
    same = title.eqNullSafe(F.col("_title")) & F.struct(*order).eqNullSafe(F.col("_first"))
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    marked = rows.join(first.withColumn("keep", F.lit(True)), same, "left")
    return marked.select(*rows.columns, F.coalesce("keep", F.lit(False)).alias("keep"))


def best_overlap(left: DataFrame, right: DataFrame, key: str, group: str, item: str, order: str) -> DataFrame:
    """(key, group, shared): the group that shares most items; the first on ties; none at zero."""
    shared = left.select(key, item).distinct().join(right.select(group, item, order).distinct(), item).groupBy(key, group).agg(F.count(F.lit(1)).alias("shared"), F.min(order).alias("_o"))
    return shared.groupBy(key).agg(F.min(F.struct((-F.col("shared")).alias("n"), "_o", group)).alias("b")).select(key, F.col(f"b.{group}").alias(group), (-F.col("b.n")).alias("shared"))


def override(measured: DataFrame, verdicts: DataFrame, key: str, value: str) -> DataFrame:
    """The verdict's value where there is one, the measured value beside it, and where the value came from."""
    v = verdicts.select(key, F.col(value).alias("_v"))
    return measured.join(v, key, "left").select(key, F.coalesce("_v", value).alias(value), F.col(value).alias(f"measured_{value}"), F.when(F.col("_v").isNull(), "measured").otherwise("adjudicated").alias("origin"))


def grep(files: DataFrame, pattern: str, most: int = 40) -> DataFrame:
    """(path, line, text) of matching lines, the first `most` in order."""
    lines = files.select("path", F.posexplode(F.split("content", "\n")).alias("n", "text")).where(F.col("text").rlike(pattern))
    return lines.select("path", (F.col("n") + 1).alias("line"), "text").orderBy("path", "line").limit(most)


def read_windows(files: DataFrame, requests: DataFrame, lines: int = 120, chars: int = 4_000) -> DataFrame:
    """(path, start, text, end, of, truncated) of requests(path, start): `lines` lines from `start` (null or below 1: the first), cut to
    `chars` characters. A request for a file that is not there has no row."""
    rows = requests.select("path", F.greatest(F.coalesce(F.col("start"), F.lit(1)), F.lit(1)).cast("int").alias("start")).distinct().join(files.select("path", F.split("content", "\n").alias("_l")), "path")
    text, end = F.array_join(F.slice("_l", F.col("start"), F.lit(lines)), "\n"), F.least(F.col("start") + lines - 1, F.size("_l"))
    return rows.select("path", "start", F.substring(text, 1, chars).alias("text"), end.alias("end"), F.size("_l").alias("of"), ((end < F.size("_l")) | (F.length(text) > chars)).alias("truncated"))


def read_window(files: DataFrame, path: str, start: int = 1, lines: int = 120, chars: int = 4_000) -> DataFrame:
    """(path, text, truncated) of some lines of one file."""
    wanted = files.where(F.col("path") == path)
    return read_windows(wanted, wanted.select("path", F.lit(start).alias("start")), lines, chars).select("path", "text", "truncated")


def list_dir(files: DataFrame, folder: str = "", most: int = 200) -> DataFrame:
    """Names directly below a folder."""
    head = folder.rstrip("/") + "/" if folder else ""
    rest = F.substring(F.col("path"), len(head) + 1, 1 << 20)
    return files.where(F.col("path").startswith(head)).select(F.when(rest.contains("/"), F.concat(F.substring_index(rest, "/", 1), F.lit("/"))).otherwise(rest).alias("name")).distinct().orderBy("name").limit(most)
