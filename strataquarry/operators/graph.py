"""The symbol graph: import and name resolution, edges, verification, impact, layers.

Inputs follow schemas.py. Every lookup is an equi-join on the module or symbol table; what cannot be resolved becomes a row
with a reason. Bounded hops are a fixed number of joins, layers an iteration with cut lineage.
"""

from __future__ import annotations

import builtins
import sys

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.joins import dealt, splittable
from ..functions.lineage import cut
from .reach import components, on_cycle, waves

BUILTINS = tuple(sorted(n for n in dir(builtins) if not n.startswith("_")))
STDLIB = tuple(sorted(sys.stdlib_module_names))
MAX_HOPS = 6
SPLIT = 64
EDGE_KEY = ["kind", "source", "target", "path", "line", "expression"]


def node(path: Column, module: Column) -> Column:
    return F.concat_ws("::", path, F.coalesce(module, F.lit("")))


def contains_edges(symbols: DataFrame) -> DataFrame:
    return symbols.where("parent is not null").select(F.lit("contains").alias("kind"), F.col("parent").alias("source"), F.col("id").alias("target"), "path", "line", F.col("name").alias("expression"))


def absolute_imports(imports: DataFrame, files: DataFrame) -> DataFrame:
    """imports with the importing file's module and `absolute`, the module they mean."""
    here = imports.join(dealt(files.select("path", F.col("module").alias("here"))), "path")
    return here.withColumn("absolute", T.resolve_relative(F.col("here"), F.col("module"), F.col("level"), F.col("path").endswith("__init__.py")))


def _submodule() -> Column:
    return F.when(F.coalesce("name", F.lit("")) != "", F.when(F.coalesce("absolute", F.lit("")) != "", F.concat_ws(".", "absolute", "name")).otherwise(F.col("name")))


def import_edges(imports: DataFrame, files: DataFrame, stdlib: tuple[str, ...] = STDLIB) -> tuple[DataFrame, DataFrame]:
    """(edges, unresolved): the module's submodule of that name first, then the module itself; else a reason."""
    modules = files.groupBy("module").agg(F.max("path").alias("to_path")).where("module is not null")
    rows = absolute_imports(imports, files).withColumn("sub", _submodule())
    a, b = modules.select(F.col("module").alias("sub"), F.col("to_path").alias("p1")), modules.select(F.col("module").alias("absolute"), F.col("to_path").alias("p2"))
    rows = rows.join(dealt(a), "sub", "left").join(dealt(b), "absolute", "left")
    target = F.when(F.col("p1").isNotNull(), node(F.col("p1"), F.col("sub"))).when(F.col("p2").isNotNull(), node(F.col("p2"), F.col("absolute")))
    written = F.concat(F.repeat(F.lit("."), F.col("level")), F.concat_ws(".", F.when(F.col("module") != "", F.col("module")), "name"))
    root = F.substring_index(F.when(F.coalesce("absolute", F.lit("")) != "", F.col("absolute")).otherwise(F.col("bound_name")), ".", 1)
    reason = F.when(F.coalesce(root, F.lit("")) == "", "unresolvable_relative_import").when(root.isin(*stdlib), "stdlib_module").otherwise("external_module")
    rows = rows.select(node(F.col("path"), F.col("here")).alias("source"), target.alias("target"), "path", "line", written.alias("expression"), reason.alias("reason"))
    return rows.where("target is not null").select(F.lit("imports").alias("kind"), "source", "target", "path", "line", "expression"), rows.where("target is null").select(F.lit("import").alias("kind"), "expression", "source", "path", "line", "reason")


def bindings(imports: DataFrame, files: DataFrame, symbols: DataFrame, hops: int = MAX_HOPS) -> DataFrame:
    """(path, bound_name, target) of names that imports bind to repository symbols; the last import of a name wins.

    A name that a package re-exports is followed through at most `hops` imports; the first import that binds it counts.
    """
    modules = files.where("module is not null").groupBy("module").agg(F.max("path").alias("to_path"))
    ids = symbols.select("id").distinct()
    every = absolute_imports(imports, files).withColumn("sub", _submodule())
    exports = every.select(F.col("path").alias("e_path"), F.col("bound_name").alias("want"), F.struct("ordinal", "absolute", "name", "sub").alias("e")).groupBy("e_path", "want").agg(F.min("e").alias("e"))
    todo = every.select("path", "bound_name", "ordinal", "absolute", F.col("name").alias("want"), "sub")
    done = None
    for hop in range(hops + 1):
        sub = modules.select(F.col("module").alias("sub"), F.col("to_path").alias("p1"))
        own = modules.select(F.col("module").alias("absolute"), F.col("to_path").alias("p2"))
        step = todo.join(dealt(sub), "sub", "left").join(dealt(own), "absolute", "left")
        step = step.withColumn("attribute", F.when(F.col("want").isNotNull() & F.col("p2").isNotNull(), F.concat(F.col("p2"), F.lit("::"), F.concat_ws(".", "absolute", "want"))))
        step = step.join(dealt(ids.select(F.col("id").alias("attribute"), F.lit(True).alias("known"))), "attribute", "left")
        module_of = F.when(F.col("p1").isNotNull(), node(F.col("p1"), F.col("sub")))
        plain = F.when((F.coalesce("want", F.lit("")) == "") & F.col("p2").isNotNull(), node(F.col("p2"), F.col("absolute")))
        hit = F.coalesce(module_of, F.when(F.col("known"), F.col("attribute")), plain)
        step = step.withColumn("hit", hit)
        found = step.where("hit is not null").select("path", "bound_name", "ordinal", F.lit(hop).alias("hop"), F.col("hit").alias("target"))
        done = found if done is None else done.unionByName(found)
        if hop < hops:
            loose = step.where("hit is null and p2 is not null and want is not null").select("path", "bound_name", "ordinal", F.col("p2").alias("e_path"), "want")
            todo = cut(loose.join(dealt(exports), ["e_path", "want"]).select("path", "bound_name", "ordinal", F.col("e.absolute").alias("absolute"), F.col("e.name").alias("want"), F.col("e.sub").alias("sub")))
            if todo.isEmpty():
                break
    # a name the chase never finds still binds to the module it was taken from
    fallback = every.join(dealt(modules.select(F.col("module").alias("absolute"), F.col("to_path").alias("p2"))), "absolute").select("path", "bound_name", "ordinal", F.lit(hops + 1).alias("hop"), node(F.col("p2"), F.col("absolute")).alias("target"))
    best = done.unionByName(fallback).groupBy("path", "bound_name", "ordinal").agg(F.min_by("target", "hop").alias("target"))
    return cut(best.groupBy("path", "bound_name").agg(F.max_by("target", "ordinal").alias("target")))


def resolve(rows: DataFrame, files: DataFrame, symbols: DataFrame, bound: DataFrame) -> DataFrame:
    """rows(path, expression, ...) with `target`: the file's own symbol first, then the name its head is bound to."""
    ids = symbols.select(F.col("id").alias("_id")).distinct()
    rows = rows.join(dealt(files.select("path", F.col("module").alias("_module"))), "path")
    rows = rows.withColumn("_local", F.concat(F.col("path"), F.lit("::"), F.concat_ws(".", "_module", "expression")))
    rows = rows.withColumn("_head", F.substring_index("expression", ".", 1)).withColumn("_tail", F.when(F.col("expression").contains("."), F.regexp_replace("expression", r"^[^.]*\.", "")))
    rows = rows.join(dealt(bound.select("path", F.col("bound_name").alias("_head"), F.col("target").alias("_bound"))), ["path", "_head"], "left")
    rows = rows.withColumn("_other", F.when(F.col("_bound").isNotNull(), F.concat_ws(".", "_bound", "_tail")))
    a, b = ids.select(F.col("_id").alias("_local"), F.lit(True).alias("_k1")), ids.select(F.col("_id").alias("_other"), F.lit(True).alias("_k2"))
    rows = rows.join(dealt(a), "_local", "left").join(dealt(b), "_other", "left")
    return rows.withColumn("target", F.when(F.col("_k1"), F.col("_local")).when(F.col("_k2"), F.col("_other")))


def inherit_edges(symbols: DataFrame, files: DataFrame, bound: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = symbols.where("kind = 'class'").select("path", "line", F.col("id").alias("source"), F.explode("bases").alias("expression"))
    rows = resolve(rows, files, symbols, bound)
    return rows.where("target is not null").select(F.lit("inherits").alias("kind"), "source", "target", "path", "line", "expression"), rows.where("target is null").select(F.lit("base").alias("kind"), "expression", "source", "path", "line", F.lit("unresolved_base").alias("reason"))


def call_edges(calls: DataFrame, symbols: DataFrame, files: DataFrame, bound: DataFrame, imports: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = resolve(calls.select("path", "line", F.concat_ws("::", "path", "scope").alias("source"), "expression"), files, symbols, bound)
    names = imports.select("path", F.col("bound_name").alias("_head"), F.lit(True).alias("_imported")).distinct()
    rows = rows.join(dealt(names), ["path", "_head"], "left")
    reason = F.when(F.col("_head").isin(*BUILTINS), "builtin").when(F.col("_bound").isNotNull(), "external_attribute").when(F.col("_imported"), "external_module").otherwise("dynamic_or_local")
    return rows.where("target is not null").select(F.lit("calls").alias("kind"), "source", "target", "path", "line", "expression"), rows.where("target is null").select(F.lit("call").alias("kind"), "expression", "source", "path", "line", reason.alias("reason"))


def build(files: DataFrame, symbols: DataFrame, imports: DataFrame, calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, unresolved) of a parsed tree."""
    bound = bindings(imports, files, symbols)
    i, iu = import_edges(imports, files)
    h, hu = inherit_edges(symbols, files, bound)
    c, cu = call_edges(calls, symbols, files, bound, imports)
    return contains_edges(symbols).unionByName(i).unionByName(h).unionByName(c), iu.unionByName(hu).unionByName(cu)


def shared_members(rows: DataFrame, member: str, group: str, one: str, other: str) -> DataFrame:
    """Members that stand in both of two groups, as tests that reach both of two modules. One aggregate instead of a self-join."""
    return rows.where(F.col(group).isin(one, other)).groupBy(member).agg(F.count_distinct(group).alias("_n")).where("_n = 2").select(member)


def known_only(rows: DataFrame, key: str, known: DataFrame, other: str) -> DataFrame:
    """Rows whose key is one of the known ids, as coverage of symbols that exist."""
    return rows.join(known.select(F.col(other).alias(key)).distinct(), key, "left_semi").select(*rows.columns)


def match_rate(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """matched, only_left, only_right, rate of two key sets; two empty sets match at 1. One shuffle for all four."""
    tagged = left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
    sides = tagged.groupBy(*keys).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    out = sides.agg(F.count_if(F.expr("_l = 1 and _r = 1")).alias("matched"), F.count_if(F.expr("_l = 1 and _r = 0")).alias("only_left"), F.count_if(F.expr("_l = 0 and _r = 1")).alias("only_right"))
    total = F.col("matched") + F.col("only_left") + F.col("only_right")
    return out.withColumn("rate", F.when(total == 0, 1.0).otherwise(F.col("matched") / total))


def impact(edges: DataFrame, symbols: DataFrame, changed: DataFrame, most: int = 8) -> DataFrame:
    """Callers from outside into each changed path(path): by `path:line` as text, at most `most`, with the total and a flag."""
    owner = symbols.groupBy("id").agg(F.max("path").alias("owner"))
    c = changed.select("path").distinct()
    # a target or source that most edges have: its owner's row meets them in more than one task
    refs = splittable(edges.where("kind <> 'contains'"), owner.select(F.col("id").alias("target"), F.col("owner").alias("target_path")), ["target"])
    refs = splittable(refs, owner.select(F.col("id").alias("source"), F.col("owner").alias("source_path")), ["source"])
    refs = refs.join(c.select(F.col("path").alias("target_path")), "target_path", "left_semi").join(c.select(F.col("path").alias("source_path")), "source_path", "left_anti")
    anchored = refs.withColumn("anchor", F.concat_ws(":", "path", "line"))
    # a target that everything calls is cut to `most` in each of SPLIT parts before its parts meet; the total is a combinable count
    order = ["anchor", "source", "kind", "expression"]
    part = Window.partitionBy("target_path", "_part").orderBy(*order)
    heads = anchored.withColumn("_part", F.pmod(F.xxhash64("anchor", "source"), F.lit(SPLIT))).withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= most)
    total = anchored.groupBy("target_path").agg(F.count(F.lit(1)).alias("total"))
    ranked = heads.withColumn("rank", F.row_number().over(Window.partitionBy("target_path").orderBy(*order))).where(F.col("rank") <= most).join(total, "target_path")
    return ranked.select("target_path", F.col("source").alias("caller"), "kind", "anchor", "expression", "rank", "total", (F.col("total") > most).alias("truncated"))


def conditional_counts(df: DataFrame, keys: list[str], counts: dict[str, Column]) -> DataFrame:
    """All counts in one pass."""
    return df.groupBy(*keys).agg(*(F.count_if(c).alias(n) for n, c in counts.items()))


def statistics(files: DataFrame, symbols: DataFrame, edges: DataFrame, unresolved: DataFrame) -> DataFrame:
    """(name, n): files, test files, symbols, edges by kind, unresolved by reason."""
    a = files.agg(F.count(F.lit(1)).alias("files"), F.count_if("is_test").alias("test_files")).select(F.explode(F.create_map(F.lit("files"), "files", F.lit("test_files"), "test_files")).alias("name", "n"))
    b = symbols.agg(F.count(F.lit(1)).alias("n")).select(F.lit("symbols").alias("name"), "n")
    c = edges.groupBy(F.concat(F.lit("edges:"), "kind").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    d = unresolved.groupBy(F.concat(F.lit("unresolved:"), "reason").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return a.unionByName(b).unionByName(c).unionByName(d)


def _shared_folders(a: Column, b: Column) -> Column:
    """Leading folders that two paths share."""
    x, y = (F.slice(F.split(p, "/"), F.lit(1), F.size(F.split(p, "/")) - 1) for p in (a, b))
    differs = F.array_position(F.zip_with(x, y, lambda i, j: ~i.eqNullSafe(j)), F.lit(True))
    return F.when(differs == 0, F.size(x)).otherwise(differs - 1)


def suffix_import(imports: DataFrame, files: DataFrame) -> DataFrame:
    """Non-Python imports(path, wanted) to owned files by stem, `target`: equal, then as a path suffix, then by its last part.

    Where imports has `beside` and `folded` (null unless relative, see parse.wanted_files), a file in the importer's folder comes
    first, then one at the folded path, then one whose path ends in the first. Of several the file nearest to the importer counts,
    then the smallest path."""
    stem = F.regexp_replace("path", r"\.[^./]+$", "")
    parts = F.split(stem, "/")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "/"))
    table = files.select(F.col("path").alias("owned"), F.posexplode(suffixes).alias("cut", "suffix"))
    tries, keys = [(6, F.col("wanted")), (10, F.element_at(F.split("wanted", "/"), -1))], ["path", "wanted"]
    if "beside" in imports.columns:
        tries, keys = [(0, F.col("beside")), (2, F.col("folded")), *tries], [*keys, "beside", "folded"]
    rows = imports.select(*keys, F.explode(F.array(*(F.struct(F.lit(way).alias("way"), x.alias("suffix")) for way, x in tries))).alias("w")).select(*keys, "w.*").where("suffix <> ''")
    # a whole stem comes before a suffix of one; a folded path means one place only, and a last part alone never tells them apart
    hits = rows.join(table, "suffix").where("way <> 2 or cut = 0").withColumn("way", F.when((F.col("cut") > 0) & (F.col("way") < 10), F.col("way") + 3).otherwise(F.col("way")))
    hits = hits.withColumn("far", -_shared_folders(F.col("path"), F.col("owned")))
    return hits.groupBy(*keys).agg(F.min(F.struct("way", "far", "owned")).alias("h")).select("path", "wanted", F.col("h.owned").alias("target"))
