"""Text functions as Column expressions. Character classes are ASCII on purpose: engines differ on Unicode classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = r"[A-Za-z_][A-Za-z0-9_]*|[^A-Za-z0-9_ \t\n\r\f\x0B]"
# Titles that name no behaviour.
GENERIC_TITLE = r"(?i)^(?:stable|main|master|merge\b|sync\b|release\b|move to src\b)"
GENERIC_POOL_TITLE = r"(?i)^(?:stable|main|master|merge\b|sync\b|release\b)"
# What differs between two runs of one suite.
VOLATILE = (
    (r"\b[0-9]+\.[0-9]+s\b", "<time>"),
    (r"\b[0-9]+(\.[0-9]+)? ?ms\b", "<time>"),
    (r"0x[0-9a-fA-F]+", "<addr>"),
    (r"/tmp/[^ \t\n\r\"']+", "<tmp>"),
    (r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}[^ \t\n\r]*", "<timestamp>"),
)
LOCATION = (r"([A-Za-z0-9_./\\-]+\.(?:go|rs|py|ts|tsx|js|jsx|mjs|cjs|c|cc|cpp|h|hpp)):[0-9]+(?::[0-9]+)?", "$1:<line>")
# What differs between two failures of one defect.
VARYING = ((r"0x[0-9a-fA-F]+", "0xADDR"), (r"(?:/[A-Za-z0-9_.-]+)+/", "<path>/"), (r"\bline [0-9]+\b", "line N"))
COPULA = ("; ", "; and ")


def _stripped(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$", "")


def context_to_node(context: Column) -> Column:
    """Coverage context to test node: cut at '|'; keep if it has '::', else the last '.' becomes '::'; empty is null."""
    head = F.trim(F.split_part(context, F.lit("|"), F.lit(1)))
    node = F.when(head.contains("::"), head).otherwise(F.regexp_replace(head, r"^(.*)\.([^.]*)$", "$1::$2"))
    return F.when(node != "", node)


def test_name(node: Column) -> Column:
    """What follows the last '::'."""
    return F.substring_index(node, "::", -1)


def test_path(node: Column) -> Column:
    """What precedes the last '::', if it names a Python file."""
    head = F.regexp_extract(node, r"^(.*)::[^:]*$", 1)
    return F.when(head.endswith(".py"), head)


def signature(message: Column, most: int = 200) -> Column:
    """Failure signature: first line without addresses, paths and line numbers."""
    s = F.regexp_extract(_stripped(message), r"^[^\n\r]*", 0)
    for pattern, put in VARYING:
        s = F.regexp_replace(s, pattern, put)
    return F.substring(s, 1, most)


def scrub(text: Column, locations: bool = True) -> Column:
    """A report without its volatile parts, so that two runs compare; with locations, line numbers go as well."""
    for pattern, put in (*VOLATILE, *((LOCATION,) if locations else ())):
        text = F.regexp_replace(text, pattern, put)
    return F.trim(text)


def sanitize(text: Column, most: int = 1200) -> Column:
    """Prose of a description: no fences, diff lines, indented blocks, inline code or URLs; single spaces; cut."""
    # What is no prose.
    for pattern in (r"(?s)```.*?```", r"(?m)^[+-][^+-].*$", r"(?m)^(?: {4}|\t).*$", r"`[^`]*`", r"https?://[^ \t\n\r]+", r"[ \t\n\r\f]+"):
        text = F.regexp_replace(text, pattern, " ")
    return F.substring(F.trim(text), 1, most)


def first_paragraph(doc: Column, least: int = 12, most: int = 200) -> Column:
    """First paragraph of prose: directives and underlines skipped, roles and emphasis unwrapped, cut at a word."""
    lines = F.transform(F.split(doc, "\n"), lambda x: F.trim(x))
    prose = F.filter(lines, lambda x: ~x.rlike(r"^(\.\.[ \t]|:[A-Za-z0-9_]+:|=+$|-+$|~+$)"))
    paragraphs = F.split(F.array_join(prose, "\n"), r"\n\n+")
    flat = F.transform(paragraphs, lambda p: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.trim(F.replace(p, F.lit("\n"), F.lit(" "))), r":[A-Za-z0-9_]+:`~?([^`]*)`", "$1"), r"[*`]+", ""), r" +", " ")))
    first = F.coalesce(F.get(F.filter(flat, lambda p: F.length(p) >= least), F.lit(0)), F.lit(""))
    head = F.regexp_replace(F.regexp_replace(F.substring(first, 1, most), r" [^ ]*$", ""), r"[,;:]+$", "")
    return F.when(F.length(first) > most, F.concat(head, F.lit("…"))).otherwise(first)


def humanise(node: Column) -> Column:
    """Test id to phrase: bare name without its prefix, underscores to spaces."""
    return F.trim(F.replace(F.regexp_replace(test_name(node), r"^test_", ""), F.lit("_"), F.lit(" ")))


def phrase_list(phrases: Column) -> Column:
    """a; b; and c."""
    n = F.size(phrases)
    return F.when(n <= 1, F.coalesce(F.get(phrases, F.lit(0)), F.lit(""))).otherwise(F.concat(F.array_join(F.slice(phrases, F.lit(1), n - 1), COPULA[0]), F.lit(COPULA[1]), F.element_at(phrases, -1)))


def tokens(text: Column) -> Column:
    """Identifiers and single signs."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def added_lines(diff: Column) -> Column:
    """Lines a unified diff adds, without marks and blank ones."""
    plus = F.filter(F.split(F.coalesce(diff, F.lit("")), "\r?\n"), lambda x: x.startswith("+") & ~x.startswith("+++"))
    return F.filter(F.transform(plus, lambda x: _stripped(F.substring(x, 2, 1 << 30))), lambda x: x != "")


def package_name(name: Column) -> Column:
    """Distribution name for comparison: lower case, '_' and '.' to '-'; runs stay."""
    return F.lower(F.translate(name, "_.", "--"))


def requirement_name(requirement: Column) -> Column:
    return F.regexp_extract(requirement, r"^([^ \t<>=!~;\[(]+)", 1)


def redact(text: Column, key: str | None = None) -> Column:
    out = F.regexp_replace(text, r"sk-or-v1-[A-Za-z0-9]{8,}", "[redacted]")
    return F.replace(out, F.lit(key), F.lit("[redacted]")) if key else out


def url_without_credentials(url: Column) -> Column:
    return F.regexp_replace(url, r"^([A-Za-z][A-Za-z0-9+.-]*://)[^/@ ]*@", "$1")


def canonical_remote(url: Column) -> Column:
    """https or ssh remote to host/owner/name: lower case, without credentials, suffix and trailing slash."""
    flat = F.regexp_replace(url_without_credentials(F.trim(url)), r"^(?:ssh://)?git@([^:/]+)[:/]", "https://$1/")
    return F.lower(F.regexp_replace(F.regexp_replace(flat, r"^[A-Za-z+]+://", ""), r"(?:\.git)?/*$", ""))


def merged_ordinal(stamp: Column) -> Column:
    """y*372 + m*31 + d of an ISO date; 0 where it is absent or malformed."""
    day = F.split(F.substring(stamp, 1, 10), "-")
    y, m, d = (F.get(day, F.lit(i)).try_cast("int") for i in range(3))
    return F.coalesce(F.when(F.size(day) == 3, y * 372 + m * 31 + d), F.lit(0))


def title_key(title: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(title), "[^a-z0-9]+", " "))


def strip_model_json(text: Column) -> Column:
    """The JSON object of a model's answer: fences off, the whole or else its outermost braces; null if neither parses to an object."""
    bare = _stripped(text)
    bare = F.when(bare.startswith("```"), _stripped(F.regexp_replace(bare, r"(?m)^[ \t]*```.*$", ""))).otherwise(bare)
    inner = F.regexp_extract(bare, r"(?s)(\{.*\})", 1)
    parses = lambda x: F.try_parse_json(x).isNotNull()
    return F.when(parses(bare), F.when(bare.startswith("{"), bare)).when(parses(inner), F.when(inner != "", inner))


def is_test_path(path: Column) -> Column:
    """Python test by name or by a directory (never the file name) called test, tests or testing."""
    parts = F.split(path, "/")
    name = F.element_at(parts, -1)
    dirs = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
    return name.rlike(r"^test_.*") | name.rlike(r"_test\.py$") | F.arrays_overlap(dirs, F.array(*map(F.lit, ("test", "tests", "testing"))))


def resolve_relative(current: Column, module: Column, level: Column, is_package: Column) -> Column:
    """Absolute module of an import in `current`. A package counts as its own container; each further dot drops a part."""
    parts = F.filter(F.split(F.coalesce(current, F.lit("")), r"\."), lambda x: x != "")
    drop = F.when(is_package, level - 1).otherwise(level)
    base = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - drop, F.lit(0)))
    tail = F.when(F.coalesce(module, F.lit("")) != "", F.array(module)).otherwise(F.array().cast("array<string>"))
    return F.when(level == 0, F.coalesce(module, F.lit(""))).otherwise(F.array_join(F.concat(base, tail), "."))
