"""Code rewriting as row functions: removing bodies, renaming internals, mutating, pruning. Sources are data, never run."""

from __future__ import annotations

import ast
import difflib
import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

CUT = "stubbed string, first_line int, last_line int, is_generator boolean, diff string, refused string"
# The idiom for a missing body, by language.
MISSING = {"rust": "todo!()", "go": 'panic("not implemented")', "javascript": 'throw new Error("Not implemented");', "typescript": 'throw new Error("Not implemented");', "c": 'throw std::runtime_error("Not implemented");', "cpp": 'throw std::runtime_error("Not implemented");'}
OPENING = {"rust": r"\bfn\s+{0}\b", "go": r"\bfunc\s+(?:\([^)]*\)\s*)?{0}\b", "javascript": r"\b(?:function\s+)?{0}\s*\(", "typescript": r"\b(?:function\s+)?{0}\s*\(", "c": r"\b{0}\s*\(", "cpp": r"\b{0}\s*\("}


MISSING["tsx"], OPENING["tsx"] = MISSING["typescript"], OPENING["typescript"]


class Refused(ValueError):
    """A definition that cannot be cut without damage."""


def unified(old: str, new: str, path: str) -> str:
    return "".join(difflib.unified_diff(old.splitlines(True), new.splitlines(True), f"a/{path}", f"b/{path}", n=3))


def _functions(body: list[ast.stmt], owner: str = "") -> Iterator[tuple[str, ast.AST]]:
    for node in body:
        if isinstance(node, ast.FunctionDef | ast.AsyncFunctionDef | ast.ClassDef):
            name = f"{owner}.{node.name}" if owner else node.name
            if not isinstance(node, ast.ClassDef):
                yield name, node
            yield from _functions(node.body, name)


def _yields(node: ast.AST) -> bool:
    """Whether the function's own body yields; inner functions are their own."""
    for child in ast.iter_child_nodes(node):
        if isinstance(child, ast.Yield | ast.YieldFrom) or not isinstance(child, ast.FunctionDef | ast.AsyncFunctionDef | ast.Lambda) and _yields(child):
            return True
    return False


def cut_python(source: str, dotted: str, explicit: bool, line: int | None = None) -> tuple[str, int, int, bool]:
    """(source with the body replaced, first and last line of it, generator). Docstring and comments above stay."""
    tree = ast.parse(source)
    found = [n for name, n in _functions(tree.body) if name == dotted]
    if len(found) > 1:
        found = [n for n in found if n.lineno == line]
    if len(found) != 1:
        raise Refused("not defined exactly once")
    node, lines = found[0], source.splitlines(keepends=True)
    body = node.body[1:] if ast.get_docstring(node, clean=False) is not None else node.body
    if not body:
        raise Refused("docstring only")
    first = min([body[0].lineno, *(d.lineno for d in getattr(body[0], "decorator_list", []))])
    indent = lines[first - 1][: len(lines[first - 1]) - len(lines[first - 1].lstrip())]
    if lines[body[0].lineno - 1][: body[0].col_offset].strip() or len(node.body) > len(body) and lines[node.body[0].lineno - 1][: node.body[0].col_offset].strip():
        raise Refused("body on the signature line")
    last, at = node.end_lineno, node.end_lineno
    while at < len(lines) and (not lines[at].strip() or lines[at].lstrip().startswith("#") and len(lines[at]) - len(lines[at].lstrip()) >= len(indent)):
        at += 1
        last = at if lines[at - 1].strip() else last
    generator = _yields(node)
    if generator and not explicit:
        raise Refused("a neutral stub would end the generator")
    stub = f"raise NotImplementedError({f'{dotted} is not implemented'!r})" if explicit else "return None"
    end = "\r\n" if lines[first - 1].endswith("\r\n") else "\n"
    out = "".join([*lines[: first - 1], indent + stub + end, *lines[last:]])
    ast.parse(out)
    if out == source:
        raise Refused("nothing changed")
    return out, first, last, generator


def closing_brace(code: str, at: int) -> int:
    """Index of the brace that closes the one at `at`; strings, characters and comments do not count. -1 if none does."""
    depth, i, n = 0, at, len(code)
    while i < n:
        two, c = code[i : i + 2], code[i]
        if two == "//":
            i = code.find("\n", i)
        elif two == "/*":
            i = code.find("*/", i) + 1
        elif c in "\"`" or c == "'" and re.match(r"'(?:\\.|[^\\'])'", code[i : i + 4]):
            j = i + 1
            while j < n and code[j] != c:
                j += 1 + (code[j] == "\\" and c != "`")
            i = j
        elif c == "{":
            depth += 1
        elif c == "}":
            depth -= 1
            if not depth:
                return i
        if i < 0 or two == "/*" and i == 0:
            return -1
        i += 1
    return -1


def cut_braces(source: str, name: str, language: str) -> tuple[str, int, int]:
    """The same for a brace language: the block's inside goes, its braces stay."""
    bare = name.split(".")[-1]
    for m in re.finditer(OPENING[language].format(re.escape(bare)), source):
        at = source.find("{", m.end())
        stop = source.find(";", m.end())
        if at < 0 or 0 <= stop < at:
            continue  # a declaration or a call
        end = closing_brace(source, at)
        if end > 0:
            line = source[source.rfind("\n", 0, at) + 1 : at]
            indent = line[: len(line) - len(line.lstrip())]
            out = f"{source[: at + 1]}\n{indent}    {MISSING[language]}\n{indent}{source[end:]}"
            return out, source.count("\n", 0, at) + 1, source.count("\n", 0, end) + 1
    raise Refused("no body found")


def excise(symbols: DataFrame, explicit: bool = False) -> DataFrame:
    """symbols(path, language, content, name, line) with stubbed, first_line, last_line, is_generator, diff, refused."""
    kinds = dict(symbols.dtypes)
    keys = [c for c in symbols.columns if c not in ("content",)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for path, language, content, name, line in zip(pdf.path, pdf.language, pdf.content, pdf.name, pdf.line, strict=True):
                try:
                    if language == "python":
                        out, first, last, gen = cut_python(content, name, explicit, int(line) if pd.notna(line) else None)
                    else:
                        (out, first, last), gen = cut_braces(content, name, language), False
                    rows.append((out, first, last, gen, unified(out, content, path), None))
                except (Refused, SyntaxError, ValueError, RecursionError, KeyError) as e:
                    rows.append((None, None, None, None, None, str(e) or type(e).__name__))
            more = pd.DataFrame(rows, columns=["stubbed", "first_line", "last_line", "is_generator", "diff", "refused"], index=pdf.index)
            more = more.astype({"first_line": "Int32", "last_line": "Int32"})
            yield pd.concat([pdf[keys], more], axis=1)

    return symbols.mapInPandas(run, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", " + CUT)


def _text_map(name: str, f: Callable[[str], str | None]) -> Callable[[Column], Column]:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: f(x) if x is not None else None)

    run.__name__ = name
    return run


DEFINITIONS = "array<struct<name:string,kind:string,line:int,first:int,last:int,body:int,depth:int,asserts:boolean>>"


class _Definitions(ast.NodeVisitor):
    """Every function and class of a module with its lines (decorators included), the line its body begins on, and how deep it
    lies; for functions, whether an assertion or an expected exception lies anywhere inside."""

    def __init__(self):
        self.found: list[dict] = []
        self.open: list[dict] = []

    def _define(self, node: ast.AST) -> None:
        first = min([node.lineno, *(d.lineno for d in node.decorator_list)])
        own = {"name": node.name, "kind": "class" if isinstance(node, ast.ClassDef) else "function", "line": node.lineno, "first": first, "last": node.end_lineno, "body": node.body[0].lineno, "depth": len(self.open), "asserts": False}
        self.found.append(own)
        self.open.append(own)
        self.generic_visit(node)
        self.open.pop()

    visit_FunctionDef = visit_AsyncFunctionDef = visit_ClassDef = _define

    def _assertion(self) -> None:
        for own in self.open:
            own["asserts"] = True

    def visit_Assert(self, node: ast.Assert) -> None:
        self._assertion()
        self.generic_visit(node)

    def visit_Call(self, node: ast.Call) -> None:
        if isinstance(node.func, ast.Attribute) and node.func.attr == "raises":
            self._assertion()
        self.generic_visit(node)


def _defined(source: str) -> list[dict] | None:
    visitor = _Definitions()
    try:
        visitor.visit(ast.parse(source))
    except (SyntaxError, ValueError, RecursionError):
        return None
    return visitor.found


def definitions(content: Column) -> Column:
    """The definitions of a Python source; null where it does not parse."""
    return F.from_json(_text_map("definitions", lambda x: None if (found := _defined(x)) is None else json.dumps(found))(content), DEFINITIONS)


def _lines(content: Column) -> Column:
    """Lines as the parser numbers them, with their ends."""
    return F.split(content, r"(?<=\n)|(?<=\r)(?!\n)", -1)


def spliced(lines: Column, edits: Column) -> Column:
    """Text of lines with each edit(first, last, text) put in place of its lines; an edit inside another is lost with it."""

    def line(x: Column, i: Column) -> Column:
        outer = F.array_min(F.filter(edits, lambda e: (e["first"] <= i + 1) & (i + 1 <= e["last"])))
        return F.when(outer.isNull(), x).when(outer["first"] == i + 1, outer["text"]).otherwise(F.lit(""))

    return F.array_join(F.transform(lines, line), "")


def private_symbols(files: DataFrame) -> DataFrame:
    """(path, name) of module-level private functions and classes of files(path, content)."""
    own = F.filter(definitions(F.col("content")), lambda d: (d["depth"] == 0) & d["name"].startswith("_") & ~d["name"].startswith("__"))
    return files.select("path", F.explode(F.array_distinct(F.transform(own, lambda d: d["name"]))).alias("name"))


def rename_private(files: DataFrame, names: DataFrame, suffix: str = "_alt", keys: tuple[str, ...] = ()) -> DataFrame:
    """(*keys, path, content, changed) with every whole-word private name given a suffix; tests stay as they are.

    The names of one task (`keys`; without them the whole table is one) are its internals, so they travel as one alternation.
    """
    words = F.array_join(F.sort_array(F.collect_set("name")), "|")
    pattern = names.groupBy(*keys).agg(F.when(F.count("name") > 0, F.concat(F.lit(r"\b("), words, F.lit(r")\b"))).alias("_p"))
    rows = files.join(pattern, list(keys), "left") if keys else files.crossJoin(F.broadcast(pattern))
    new = F.when(T.is_test_path(F.col("path")) | F.col("_p").isNull(), F.col("content")).otherwise(F.regexp_replace(F.col("content"), F.col("_p"), F.lit(f"$1{suffix}")))
    return rows.select(*keys, "path", new.alias("content"), (new != F.col("content")).alias("changed"))


def portability(renamed: Column, passing: Column, ran: Column) -> Column:
    """What a rename that keeps meaning shows about a verifier."""
    return F.when(~ran, "not_run").when(renamed == 0, "no_internals_to_rename").when(passing, "survived").otherwise("verifier_depends_on_internals")


def mutate(targets: DataFrame, message: str = "__mutation__") -> DataFrame:
    """(path, mutated) of targets(path, content, lines): functions at those lines raise at once; null where the source does not
    parse. A body on the line of its signature stays."""
    rows = targets.select("path", "lines", _lines(F.col("content")).alias("source"), definitions(F.col("content")).alias("found"))
    aimed = F.filter("found", lambda d: (d["kind"] == "function") & (d["body"] > d["line"]) & F.array_contains("lines", d["line"]))
    indent = lambda d: F.regexp_extract(F.element_at("source", d["body"]), r"^[ \t\f]*", 0)
    edits = F.transform(aimed, lambda d: F.struct(d["body"].alias("first"), d["last"].alias("last"), F.concat(indent(d), F.lit(f"raise RuntimeError({message!r})\n")).alias("text")))
    return rows.select("path", F.when(F.col("found").isNotNull(), spliced(F.col("source"), edits)).alias("mutated"))


def _tests(found: Column) -> Column:
    return F.filter(found, lambda d: (d["kind"] == "function") & d["name"].startswith("test_"))


def test_problem(found: Column) -> Column:
    """Why generated tests with these definitions are of no use: they do not parse, hold no test, or a test asserts nothing."""
    idle = F.array_min(F.transform(F.filter(_tests(found), lambda d: ~d["asserts"]), lambda d: F.struct(d["depth"], d["line"], d["name"])))
    return F.when(found.isNull(), "syntax_error").when(idle.isNotNull(), F.concat(idle["name"], F.lit("_has_no_assertion"))).when(F.size(_tests(found)) == 0, "no_test_functions")


def prune(files: DataFrame) -> DataFrame:
    """(path, content) of files(path, content, failing) without the failing module-level tests; useless rests are dropped."""
    rows = files.select("path", "failing", _lines(F.col("content")).alias("source"), definitions(F.col("content")).alias("found")).where("found is not null")
    goes = F.filter("found", lambda d: (d["kind"] == "function") & (d["depth"] == 0) & F.array_contains("failing", d["name"]))
    rows = rows.withColumn("goes", F.transform(goes, lambda d: F.struct(d["first"].alias("first"), d["last"].alias("last"), F.lit("").alias("text"))))
    stays = F.filter("found", lambda d: ~F.exists("goes", lambda e: (e["first"] <= d["first"]) & (d["last"] <= e["last"])))
    return rows.where(test_problem(stays).isNull()).select("path", spliced(F.col("source"), F.col("goes")).alias("content"))


class _Names(ast.NodeVisitor):
    """Names that a source binds: functions, classes and everything assigned to."""

    def __init__(self):
        self.names: set[str] = set()

    def visit(self, node: ast.AST) -> None:
        if isinstance(node, ast.FunctionDef | ast.AsyncFunctionDef | ast.ClassDef):
            self.names.add(node.name)
        elif isinstance(node, ast.Name) and isinstance(node.ctx, ast.Store):
            self.names.add(node.id)
        self.generic_visit(node)


def _bound(source: str) -> str:
    visitor = _Names()
    try:
        visitor.visit(ast.parse(source))
    except (SyntaxError, ValueError, RecursionError):
        return "[]"
    return json.dumps(sorted(visitor.names))


def base_names(files: DataFrame) -> DataFrame:
    """(name) that the Python sources of a tree bind; a source that does not parse binds none."""
    return files.where(F.col("path").endswith(".py")).select(F.explode(F.from_json(_text_map("bound", _bound)(F.col("content")), "array<string>")).alias("name")).distinct()


def base_text(files: DataFrame, keys: tuple[str, ...] = (), most: int = 4_000_000) -> DataFrame:
    """(*keys, text): a tree's Python sources in path order, joined by line ends, up to the one that passes `most` characters. A
    running sum over (path, length) picks the files first, so no more text than that is gathered."""
    before = F.coalesce(F.sum(F.length("content")).over(Window.partitionBy(*keys).orderBy("path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    some = files.where(F.col("path").endswith(".py")).withColumn("_before", before).where(F.col("_before") <= most)
    return some.groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("path", "content"))), lambda x: x["content"]), "\n").alias("text"))


def canonical_sha(document: Column) -> Column:
    """sha256 of a JSON text with sorted keys and no blanks; null where it does not parse."""

    def one(x: str) -> str | None:
        try:
            return json.dumps(json.loads(x), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        except ValueError:
            return None

    return F.sha2(_text_map("canonical", one)(document), 256)
