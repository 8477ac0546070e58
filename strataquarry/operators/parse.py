"""Python sources to symbols, imports and calls. The syntax tree is only read; nothing of a source is ever run."""

from __future__ import annotations

import ast
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S

NODES = "path string, module string, kind string, symbol struct<" + ", ".join(f"{c.split(' ', 1)[0]}:{c.split(' ', 1)[1]}" for c in S.SYMBOLS.removeprefix("path string, ").split(", ")) + ">, import struct<" + ", ".join(f"{c.split(' ', 1)[0]}:{c.split(' ', 1)[1]}" for c in S.IMPORTS.removeprefix("path string, ").split(", ")) + ">, call struct<" + ", ".join(f"{c.split(' ', 1)[0]}:{c.split(' ', 1)[1]}" for c in S.CALLS.removeprefix("path string, ").split(", ")) + ">, error string"


def dotted(node: ast.AST) -> str | None:
    """a.b.c of names and attributes, null for anything else."""
    parts = []
    while isinstance(node, ast.Attribute):
        parts.append(node.attr)
        node = node.value
    return ".".join([node.id, *reversed(parts)]) if isinstance(node, ast.Name) else None


def _handles_import(handler: ast.ExceptHandler) -> bool:
    names = [handler.type] if not isinstance(handler.type, ast.Tuple) else handler.type.elts
    return any(n is None or (dotted(n) or "").split(".")[-1] in ("ImportError", "ModuleNotFoundError", "Exception") for n in names)


class Reader:
    """Walks one tree and keeps rows in source order."""

    def __init__(self, path: str, module: str, test: bool):
        self.path, self.module, self.test = path, module, test
        self.symbols: list[dict] = []
        self.imports: list[dict] = []
        self.calls: list[dict] = []

    def visit(self, node: ast.AST, scope: list[tuple[str, str]], guard: str | None) -> None:
        match node:
            case ast.FunctionDef() | ast.AsyncFunctionDef() | ast.ClassDef():
                self.define(node, scope, guard)
                return
            case ast.Import() | ast.ImportFrom():
                self.bring(node, scope, guard)
                return
            case ast.Try() if any(map(_handles_import, node.handlers)):
                for child in node.body:
                    self.visit(child, scope, "try_import")
                for child in [*node.handlers, *node.orelse, *node.finalbody]:
                    self.visit(child, scope, "try_import" if isinstance(child, ast.ExceptHandler) else guard)
                return
            case ast.If():
                test = ast.unparse(node.test)
                inner = "type_checking" if "TYPE_CHECKING" in test else "version_gated" if "sys.version_info" in test else guard
                self.visit(node.test, scope, guard)
                for child in node.body:
                    self.visit(child, scope, inner)
                for child in node.orelse:
                    self.visit(child, scope, "version_gated" if inner == "version_gated" else guard)
                return
            case ast.Call():
                name = dotted(node.func)
                if name:
                    self.calls.append({"line": node.lineno, "column": node.col_offset, "expression": name, "scope": self.scope(scope), "ordinal": len(self.calls)})
        for child in ast.iter_child_nodes(node):
            self.visit(child, scope, guard)

    def whole(self, tree: ast.Module) -> None:
        """The module itself, which its definitions name as their parent; it stands at its first statement."""
        first = tree.body[0] if tree.body else None
        line, end, column, stop = (first.lineno, first.end_lineno, first.col_offset, first.end_col_offset) if first else (1, 1, 0, 0)
        self.symbols.append({
            "id": f"{self.path}::{self.module}", "kind": "module", "name": self.module.split(".")[-1] or self.path, "qualified_name": self.module, "line": line, "end_line": end, "column": column, "end_column": stop,
            "parent": None, "bases": [], "decorators": [], "signature": None, "docstring": ast.get_docstring(tree), "is_test": self.test, "is_public": True, "ordinal": 0,
        })

    def scope(self, scope: list[tuple[str, str]]) -> str:
        return ".".join([*filter(None, [self.module]), *(n for n, _ in scope)])

    def define(self, node, scope: list[tuple[str, str]], guard: str | None) -> None:
        is_class = isinstance(node, ast.ClassDef)
        inside = [n for n, _ in scope]
        qualified = ".".join([*filter(None, [self.module]), *inside, node.name])
        kind = "class" if is_class else "method" if scope and scope[-1][1] == "class" else "function"
        sig = None if is_class else f"{node.name}({ast.unparse(node.args)})" + (f" -> {ast.unparse(node.returns)}" if node.returns else "")
        self.symbols.append({
            "id": f"{self.path}::{qualified}", "kind": kind, "name": node.name, "qualified_name": qualified, "line": node.lineno, "end_line": node.end_lineno, "column": node.col_offset, "end_column": node.end_col_offset,
            "parent": f"{self.path}::{self.scope(scope)}", "bases": [b for b in map(dotted, node.bases) if b] if is_class else [], "decorators": [d for d in (dotted(x.func if isinstance(x, ast.Call) else x) for x in node.decorator_list) if d],
            "signature": sig, "docstring": ast.get_docstring(node), "is_test": self.test or node.name.startswith("test_"), "is_public": not any(n.startswith("_") for n in [*inside, node.name]), "ordinal": len(self.symbols),
        })
        for child in node.decorator_list:
            self.visit(child, scope, guard)
        for child in ast.iter_child_nodes(node):
            if child not in node.decorator_list:
                self.visit(child, [*scope, (node.name, "class" if is_class else "function")], guard)

    def bring(self, node, scope: list[tuple[str, str]], guard: str | None) -> None:
        plain = isinstance(node, ast.Import)
        for alias in node.names:
            name = None if plain else alias.name
            bound = alias.asname or (alias.name.split(".")[0] if plain else alias.name)
            self.imports.append({"line": node.lineno, "module": alias.name if plain else node.module or "", "name": name, "alias": alias.asname, "level": 0 if plain else node.level, "scope": self.scope(scope), "guard": guard, "bound_name": bound, "ordinal": len(self.imports)})


def parse_source(path: str, module: str, content: str, test: bool) -> tuple[Reader | None, str | None]:
    try:
        tree = ast.parse(content)
    except (SyntaxError, ValueError, RecursionError) as e:
        return None, f"{type(e).__name__}: {e}"
    reader = Reader(path, module or "", test)
    reader.whole(tree)
    for child in tree.body:
        reader.visit(child, [], None)
    return reader, None


def parse_files(files: DataFrame) -> DataFrame:
    """One row a symbol, import, call or error of files(path, module, content, is_test)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for path, module, content, test in zip(pdf.path, pdf.module, pdf.content, pdf.is_test, strict=True):
                reader, error = parse_source(path, module, content or "", bool(test))
                base = {"path": path, "module": module, "symbol": None, "import": None, "call": None, "error": error}
                rows.append({**base, "kind": "file"})
                for kind, found in (("symbol", reader.symbols), ("import", reader.imports), ("call", reader.calls)) if reader else ():
                    rows += [{**base, "kind": kind, kind: x} for x in found]
            yield pd.DataFrame(rows, columns=["path", "module", "kind", "symbol", "import", "call", "error"])

    return files.select("path", "module", "content", "is_test").mapInPandas(run, NODES)


def tables(parsed: DataFrame) -> dict[str, DataFrame]:
    """symbols, imports, calls, errors of parse_files()."""
    one = lambda kind: parsed.where(F.col("kind") == kind).select("path", f"{kind}.*")
    return {"symbols": one("symbol"), "imports": one("import"), "calls": one("call"), "errors": parsed.where("kind = 'file' and error is not null").select("path", "error")}


def module_names(files: DataFrame) -> DataFrame:
    """files with module: path below its package root. A folder is a package if it holds __init__.py or lies below one that does."""
    parts = F.split("path", "/")
    dirs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    marked = files.where(F.col("path").endswith("/__init__.py")).select(F.regexp_replace("path", "/__init__\\.py$", "").alias("dir")).distinct()
    first = files.where(F.size(parts) > 1).select("path", F.posexplode(dirs).alias("depth", "dir")).join(marked, "dir").groupBy("path").agg(F.min("depth").alias("depth"))
    rows = files.join(first, "path", "left")
    inner = F.slice(parts, F.coalesce("depth", F.greatest(F.size(parts) - 1, F.lit(0))) + 1, F.size(parts))
    name = F.regexp_replace(F.array_join(inner, "."), r"(\.__init__)?\.py$", "")
    return rows.withColumn("module", F.when(name != "__init__", name).otherwise("")).drop("depth")


# Where a definition starts, by language.
REGEX_SYMBOLS = {
    "rust": r"(?m)^[ \t]*(?:pub(?:\([^)]*\))?[ \t]+)?(?:async[ \t]+)?(fn|struct|enum|trait|mod)[ \t]+([A-Za-z_][A-Za-z0-9_]*)",
    "go": r"(?m)^(func|type)[ \t]+(?:\([^)]*\)[ \t]*)?([A-Za-z_][A-Za-z0-9_]*)",
    "javascript": r"(?m)^[ \t]*(?:export[ \t]+)?(?:default[ \t]+)?(?:async[ \t]+)?(function|class)[ \t]+([A-Za-z_$][A-Za-z0-9_$]*)",
    "typescript": r"(?m)^[ \t]*(?:export[ \t]+)?(?:default[ \t]+)?(?:async[ \t]+)?(function|class|interface|enum|type)[ \t]+([A-Za-z_$][A-Za-z0-9_$]*)",
    "c": r"(?m)^(struct|enum|union)[ \t]+([A-Za-z_][A-Za-z0-9_]*)",
    "cpp": r"(?m)^[ \t]*(class|struct|enum|namespace)[ \t]+([A-Za-z_][A-Za-z0-9_]*)",
}


REGEX_SYMBOLS["tsx"] = REGEX_SYMBOLS["typescript"]


def regex_symbols(files: DataFrame) -> DataFrame:
    """(path, language, kind, name, line, ordinal) of files(path, language, content) in languages without a parser here."""
    out = None
    for language, pattern in REGEX_SYMBOLS.items():
        own = files.where(F.col("language") == language)
        lines = own.select("path", "language", F.posexplode(F.split("content", "\n")).alias("n", "x"))
        one = pattern.replace("(?m)", "")
        part = lines.select("path", "language", F.regexp_extract("x", one, 1).alias("kind"), F.regexp_extract("x", one, 2).alias("name"), (F.col("n") + 1).alias("line")).where("name <> ''")
        out = part if out is None else out.unionByName(part)
    return out


# How other languages import, define functions and declare tests.
OTHER_IMPORTS = {
    "rust": (r"\buse\s+([^;]+);",),
    "go": (r'^[ \t]*import\s+(?:[A-Za-z_.][A-Za-z0-9_]*\s+)?"([^"]+)"', r'^[ \t]+(?:[A-Za-z_.][A-Za-z0-9_]*\s+)?"([^"\n]+)"[ \t]*$'),
    "javascript": (r"""\bfrom\s+['"]([^'"]+)['"]""", r"""^[ \t]*import\s+['"]([^'"]+)['"]""", r"""\brequire\s*\(\s*['"]([^'"]+)['"]\s*\)"""),
    "c": (r'^[ \t]*#[ \t]*include[ \t]*[<"]([^>"]+)[>"]',),
}
OTHER_FUNCTIONS = {
    "rust": (r"\bfn\s+([A-Za-z_][A-Za-z0-9_]*)",),
    "go": (r"^func\s+(?:\([^)]*\)\s*)?([A-Za-z_][A-Za-z0-9_]*)",),
    "javascript": (r"\bfunction\s*\*?\s*([A-Za-z_$][A-Za-z0-9_$]*)\s*\(", r"\b(?:const|let|var)\s+([A-Za-z_$][A-Za-z0-9_$]*)\s*=\s*(?:async\s*)?(?:\([^()]*\)|[A-Za-z_$][A-Za-z0-9_$]*)\s*=>"),
    "c": (r"^[A-Za-z_][A-Za-z0-9_:<>,*& \t]*[ \t*&]([A-Za-z_~][A-Za-z0-9_:~]*)\s*\([^;{}()]*\)\s*(?:const\s*)?\{",),
}
OTHER_TESTS = {"javascript": r"""\b(?:it|test|describe)\s*\(\s*['"`]([^'"`]+)['"`]""", "c": r"^TEST(?:_F|_P|_CASE)?\s*\(\s*([^)]*?)\s*\)"}
FAMILY = {"typescript": "javascript", "tsx": "javascript", "cpp": "c"}
NO_FUNCTION = ("if", "for", "while", "switch", "return", "else", "catch", "sizeof")
SOURCE_ROWS = "path string, language string, kind string, name string, line int, end_line int, is_test boolean"


def _block_end(code: str, at: int) -> int:
    """Offset of the brace that closes the block a definition at `at` opens; where none opens before ';', the definition itself."""
    from .rewrite import closing_brace

    opening, stop = code.find("{", at), code.find(";", at)
    end = closing_brace(code, opening) if opening >= 0 and not 0 <= stop < opening else -1
    return end if end >= 0 else at


def source_rows(code: str, language: str) -> list[tuple[str, str, int, int, bool]]:
    """(kind, name, line, end_line, is_test) of imports, functions and declared tests, in order of lines."""
    family, out = FAMILY.get(language, language), []
    line = lambda at: code.count("\n", 0, at) + 1
    go_blocks = [m.span() for m in re.finditer(r"^import\s*\([^)]*\)", code, re.M)] if family == "go" else []
    for i, pattern in enumerate(OTHER_IMPORTS.get(family, ())):
        for m in re.finditer(pattern, code, re.M):
            if family != "go" or i == 0 or any(a <= m.start() < b for a, b in go_blocks):
                out.append(("import", " ".join(m[1].split()), line(m.start(1)), line(m.start(1)), False))
    for pattern in OTHER_FUNCTIONS.get(family, ()):
        for m in re.finditer(pattern, code, re.M):
            if m[1] in NO_FUNCTION:
                continue
            first, above = line(m.start(1)), code[: m.start()].splitlines()[-3:]
            test = any(re.match(r"\s*#\[(?:[a-z_]+::)?test\]", x) for x in above) if family == "rust" else family == "go" and bool(re.match("Test|Benchmark|Fuzz|Example", m[1]))
            out.append(("function", m[1], first, line(_block_end(code, m.start(1))), test))
    if family in OTHER_TESTS:
        for m in re.finditer(OTHER_TESTS[family], code, re.M):
            out.append(("test", m[1], line(m.start()), line(_block_end(code, m.start())), True))
    return sorted(out, key=lambda r: (r[2], r[0], r[1]))


def parse_other(files: DataFrame) -> DataFrame:
    """(path, language, kind, name, line, end_line, is_test) of files(path, language, content) in languages other than Python."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [(path, language, *row) for path, language, content in zip(pdf.path, pdf.language, pdf.content, strict=True) for row in source_rows(content or "", language or "")]
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in SOURCE_ROWS.split(", ")])

    return files.select("path", "language", "content").mapInPandas(run, SOURCE_ROWS)


def _folded(path: Column) -> Column:
    """A path without `.` and `..`; what would leave the root stays at it."""
    step = lambda acc, x: F.when(x.isin("", "."), acc).when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(x)))
    return F.array_join(F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step), "/")


def wanted_files(rows: DataFrame) -> DataFrame:
    """(path, wanted, beside, folded) of parse_other()'s imports in the form graph.suffix_import() takes.

    `wanted` has no leading dots, no extension, and '/' between parts. For imports that begin with a dot, `beside` is that in the
    importer's folder and `folded` what the dots make of it; else null."""
    end = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "::", "/"), r"/?\{.*$|[ ]+as .*$", ""), r"\.(?:js|jsx|ts|tsx|h|hpp)$", "")
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    within = lambda c: F.when(F.col("name").startswith("."), F.concat(F.when(folder != "", F.concat(folder, F.lit("/"))).otherwise(""), c))
    wanted = end(F.regexp_replace("name", r"^(?:\.{1,2}/|crate::|super::|self::)+", ""))
    found = rows.where("kind = 'import'").select("path", "name", wanted.alias("wanted")).where("wanted <> ''")
    return found.select("path", "wanted", within(F.col("wanted")).alias("beside"), _folded(within(end(F.col("name")))).alias("folded")).distinct()


def test_functions(files: DataFrame) -> DataFrame:
    """(path, name, body) of collected tests: module functions and methods of Test classes called test_*."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for path, content in zip(pdf.path, pdf.content, strict=True):
                try:
                    tree = ast.parse(content or "")
                except (SyntaxError, ValueError, RecursionError):
                    continue
                for owner, body in [("", tree.body), *((f"{c.name}.", c.body) for c in tree.body if isinstance(c, ast.ClassDef) and c.name.startswith("Test"))]:
                    rows += [(path, owner + f.name, ast.unparse(f)) for f in body if isinstance(f, ast.FunctionDef | ast.AsyncFunctionDef) and f.name.startswith("test_")]
            yield pd.DataFrame(rows, columns=["path", "name", "body"])

    return files.select("path", "content").mapInPandas(run, "path string, name string, body string")


def test_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, name, change) of tests added, modified or removed between two trees."""
    a, b = before.select("path", "name", F.col("body").alias("old")), after.select("path", "name", F.col("body").alias("new"))
    rows = a.join(b, ["path", "name"], "full_outer")
    return rows.select("path", "name", F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "modified").alias("change")).where("change is not null")
