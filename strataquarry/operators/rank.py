"""Ranking and selection: weighted scores, tiers, difficulty, diversity under quotas."""

from __future__ import annotations

from collections import Counter, deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as T

# Weights of the history score.
HISTORY_WEIGHTS = {"new_behaviour": 0.35, "verifier_presence": 0.15, "coordination": 0.10, "cross_module": 0.10, "documentation": 0.10, "recency": 0.20}
FACTORS = ("coordinated_change", "cross_module", "misleading_similarity", "business_logic", "scale")
PENALTY = 0.35


def weighted_rank(df: DataFrame, keys: list[str], weights: dict[str, float], tie: str, score: str = "score", digits: int | None = None) -> DataFrame:
    """Min-max each column in its pool, weigh, rank by score down and tie up. A pool of one, or a constant column, scores 1.

    With digits, scores are rounded before they rank, so that those which read alike are ties.
    """
    normal = N.with_min_max(df, keys, list(weights))
    total = sum((F.col(f"{c}_norm") * w for c, w in weights.items()), F.lit(0.0))
    total = total if digits is None else F.round(total, digits)
    return N.with_rank(normal.withColumn(score, total), keys, [F.desc(score), F.col(tie)])


def rank_history(candidates: DataFrame) -> DataFrame:
    rows = candidates.where("reason is null").withColumns({"new_behaviour": F.col("added_tests").cast("double"), "verifier_presence": F.col("test_files_changed").cast("double"), "coordination": F.col("source_files_changed").cast("double"), "cross_module": F.col("modules_touched").cast("double"), "documentation": F.col("body_length").cast("double"), "recency": T.merged_ordinal(F.col("merged_at")).cast("double")})
    return weighted_rank(rows, [], HISTORY_WEIGHTS, "candidate_id")


def distribution(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """n, min, p33, median, p67, p90, max by nearest rank."""
    return N.counted_rank(df, keys, value, {"min": 0.0, "p33": 0.33, "median": 0.5, "p67": 0.67, "p90": 0.9, "max": 1.0})


def terciles(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(low, high) cuts at 1/3 and 2/3; below three values, the first and the last."""
    out = N.counted_rank(df, keys, value, {"first": 0.0, "a": 1 / 3, "b": 2 / 3, "last": 1.0})
    return out.select(*keys, F.when(F.col("n") < 3, F.col("first")).otherwise(F.col("a")).alias("low"), F.when(F.col("n") < 3, F.col("last")).otherwise(F.col("b")).alias("high"))


def dominant(norms: dict[str, Column], most: int = 2) -> Column:
    """Names of the largest factors; equal ones keep the declared order."""
    pairs = F.array(*(F.struct((-c).alias("v"), F.lit(i).alias("i"), F.lit(n).alias("n")) for i, (n, c) in enumerate(norms.items())))
    return F.transform(F.slice(F.array_sort(pairs), F.lit(1), F.lit(most)), lambda x: x["n"])


def difficulty(tasks: DataFrame, keys: list[str] | None = None, factors: tuple[str, ...] = FACTORS, task: str = "task_id") -> DataFrame:
    """Composite of min-max factors, tier by equal thirds of rank, the two dominant factors."""
    rows = N.with_min_max(tasks, keys or [], list(factors))
    rows = rows.withColumn("composite", sum((F.col(f"{f}_norm") for f in factors), F.lit(0.0)) / len(factors))
    rows = N.equal_thirds(rows, keys or [], [F.col("composite"), F.col(task)], "third")
    tier = F.element_at(F.array(F.lit("easy"), F.lit("medium"), F.lit("hard")), (F.col("third") + 1).cast("int"))
    return rows.withColumn("tier", tier).withColumn("dominant", dominant({f: F.col(f"{f}_norm") for f in factors}))


def justification() -> Column:
    """One sentence from the dominant factors that say something, at most two clauses."""
    n = lambda c: F.col(c).cast("long").cast("string")
    # The sentence of each factor.
    clause = {
        "coordinated_change": (F.col("coordinated_change") >= 2, F.concat(F.lit("requires coordinated edits across "), n("coordinated_change"), F.lit(" source files"))),
        "cross_module": (F.col("cross_module") >= 2, F.concat(F.lit("spans "), n("cross_module"), F.lit(" modules, so the change cannot be reasoned about locally"))),
        "misleading_similarity": (F.col("misleading_similarity") >= 1, F.concat(F.lit("the repository defines "), n("misleading_similarity"), F.lit(" similarly named symbols elsewhere, so the right one has to be identified rather than searched for"))),
        "business_logic": (F.col("business_logic") >= 200, F.lit("depends on rules recorded in the change's description rather than inferable from the surrounding code")),
        "scale": ((F.col("churn") >= 40) | (F.col("verifiers") >= 3), F.concat(F.lit("touches "), n("churn"), F.lit(" lines with "), n("verifiers"), F.lit(" tests that must end up passing"))),
    }
    pick = lambda name: F.coalesce(*(F.when((name == k) & ok, s) for k, (ok, s) in clause.items()))
    said = F.slice(F.filter(F.transform("ranked", pick), lambda x: x.isNotNull()), 1, 2)
    fallback = F.concat(F.lit("is a contained change verified by "), n("verifiers"), F.when(F.col("verifiers") == 1, " test").otherwise(" tests"))
    return F.concat(F.lit("This task "), F.when(F.size(said) > 0, F.array_join(said, "; and it ")).otherwise(fallback), F.lit("."))


def lookalikes(symbols: DataFrame, tasks: DataFrame, task: str = "task_id") -> DataFrame:
    """(task_id, lookalikes): other symbols of the same bare name."""
    bare = lambda c: F.coalesce(F.nullif(F.substring_index(c, ".", -1), F.lit("")), c)
    counts = symbols.groupBy(bare(F.col("id")).alias("bare")).agg(F.count(F.lit(1)).alias("n"))
    return tasks.select(task, bare(F.col("subject")).alias("bare")).join(counts, "bare", "left").select(task, F.greatest(F.coalesce("n", F.lit(1)) - 1, F.lit(0)).alias("lookalikes"))


def coherent(tasks: DataFrame) -> DataFrame:
    """tasks with reason: history that is maintenance by title, or too broad against the pool's own medians."""
    pool = tasks.where("source = 'history'").agg(F.coalesce(F.median("files_changed"), F.lit(0.0)).alias("_f"), F.coalesce(F.median("churn"), F.lit(0.0)).alias("_c"))
    rows = tasks.crossJoin(F.broadcast(pool))
    wide = (F.col("files_changed") > F.greatest(F.lit(25), F.floor(F.col("_f") * 4))) & (F.col("churn") > F.greatest(F.lit(2_000), F.floor(F.col("_c") * 6)))
    reason = F.when(F.trim(F.coalesce("title", F.lit(""))).rlike(T.GENERIC_POOL_TITLE), "generic_or_merge_title").when(wide, F.concat(F.lit("change_too_broad:"), "files_changed", F.lit("_files:"), "churn", F.lit("_lines")))
    return rows.withColumn("reason", F.when(F.col("source") == "history", reason)).drop("_f", "_c")


def diverse_top(df: DataFrame, keys: list[str], group: str, score: str, tie: str, most: int, penalty: float = PENALTY) -> DataFrame:
    """Greedy choice of score - penalty * (already taken of the group), as windows: the adjusted score needs only the rank within the group."""
    in_group = Window.partitionBy(*keys, group).orderBy(F.desc(score), F.desc(tie))
    rows = df.withColumn("place", F.row_number().over(in_group)).where(F.col("place") <= most)
    rows = rows.withColumn("adjusted", F.col(score) - F.lit(penalty) * (F.col("place") - 1))
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("adjusted"), F.desc(tie)))).where(F.col("rank") <= most)


def shortlist(df: DataFrame, keys: list[str], total: int) -> DataFrame:
    """Rows that a choice of `total` can ever take: the best `total` of each source and group, and for every module the best
    beyond what may be taken of it. Pools so stay bounded by their sources, groups and modules."""
    best = Window.partitionBy(*keys, "source", "group").orderBy(F.desc("score"), F.desc("task_id"))
    ranked = df.where(F.col("task_id").isNotNull()).withColumn("_n", F.row_number().over(best))
    names = F.coalesce("modules", F.array("group"))
    spread = Window.partitionBy(*keys, "_m").orderBy(F.desc("score"), "task_id")
    spare = ranked.withColumn("_m", F.explode(names)).withColumn("_k", F.row_number().over(spread)).where(F.col("_k") <= total + 1).drop("_m", "_k")
    return ranked.where(F.col("_n") <= total).unionByName(spare).drop("_n").dropDuplicates([*keys, "task_id"])


class Queues:
    """A pool as one queue for each source and group, best first. Taking from a group lowers the heads of all its queues alike,
    so only heads compete; what is taken leaves its queue, wherever it stands."""

    def __init__(self, tasks: list[dict], penalty: float):
        self.penalty, self.taken = penalty, Counter()
        self.queues: dict[tuple[str, str], deque[dict]] = {}
        for task in sorted(tasks, key=lambda t: (t["score"], t["task_id"]), reverse=True):
            self.queues.setdefault((task["source"], task["group"]), deque()).append(task)

    def value(self, task: dict) -> tuple[float, str]:
        return task["score"] - self.penalty * self.taken[task["group"]], task["task_id"]

    def head(self, sources: set[str]) -> dict | None:
        return max((q[0] for (source, _), q in self.queues.items() if q and source in sources), key=self.value, default=None)

    def elsewhere(self, covered: set[str]) -> dict | None:
        """The best by plain score of those that touch a module beyond the covered ones; the first by id on ties."""
        fresh = (t for q in self.queues.values() for t in q if not modules_of(t) <= covered)
        return min(fresh, key=lambda t: (-t["score"], t["task_id"]), default=None)

    def take(self, task: dict) -> dict:
        self.queues[task["source"], task["group"]].remove(task)
        self.taken[task["group"]] += 1
        return task


def modules_of(task: dict) -> set[str]:
    return set(task.get("modules") or [task["group"]])


def choose(tasks: list[dict], total: int = 10, floors: dict[str, int] | None = None, caps: dict[str, int] | None = None, least_groups: int = 4, penalty: float = PENALTY) -> list[dict]:
    """Quota-bound choice over one pool of {task_id, source, group, score, modules}, with position and reason.

    Each source's floor is filled by its best heads, then all sources below their cap compete. While the chosen tasks touch too
    few modules, the best task that touches another replaces one of its own source whose group stands there twice."""
    floors, caps = {"history": 4} if floors is None else floors, {"excision": 4, "net_new": 3} if caps is None else caps
    queues, chosen, number = Queues(tasks, penalty), [], Counter()
    sources = sorted({t["source"] for t in tasks})
    goals = [(f"minimum_{s}", {s}, min(floors[s], caps.get(s, total))) for s in sorted(floors)] + [("ranked", set(sources), total)]
    for reason, of, goal in goals:
        while len(chosen) < total and (reason == "ranked" or sum(number[s] for s in of) < goal):
            found = queues.head({s for s in of if number[s] < caps.get(s, total)})
            if found is None:
                break
            number[found["source"]] += 1
            chosen.append({**queues.take(found), "reason": reason})
    while len(covered := set().union(*map(modules_of, chosen))) < least_groups:
        new = queues.elsewhere(covered)
        twice = [t for t in chosen if new and t["source"] == new["source"] and queues.taken[t["group"]] > 1]
        if not twice:
            break
        old = min(twice, key=lambda t: t["task_id"])
        queues.taken[old["group"]] -= 1
        chosen.remove(old)
        chosen.append({**queues.take(new), "reason": "diversity_repair"})
    return [{**t, "position": i} for i, t in enumerate(chosen)]


def select_quota(df: DataFrame, keys: list[str], total: int = 10, floors: dict[str, int] | None = None, caps: dict[str, int] | None = None, least_groups: int = 4, penalty: float = PENALTY) -> DataFrame:
    """choose() for each pool of df(*keys, task_id, source, group, score[, modules]); pools are shortlisted first."""
    if "modules" not in df.columns:
        df = df.withColumn("modules", F.array("group"))
    pool = shortlist(df.select(*keys, "task_id", "source", "group", "score", "modules"), keys, total)
    kinds = dict(pool.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "task_id string, source string, `group` string, score double, modules array<string>, reason string, position int"])

    def run(pdf):
        import pandas as pd

        rows = choose(pdf.assign(modules=pdf.modules.map(list)).to_dict("records"), total, floors, caps, least_groups, penalty)
        return pd.DataFrame(rows, columns=[*keys, "task_id", "source", "group", "score", "modules", "reason", "position"])

    return pool.groupBy(*(keys or [F.lit(1)])).applyInPandas(run, schema)


def shortfalls(chosen: DataFrame, keys: list[str], total: int = 10, floors: dict[str, int] | None = None, caps: dict[str, int] | None = None, least_groups: int = 4) -> DataFrame:
    """(rule, have, need) of every quota that a selection misses; every module that a task touches counts."""
    names = F.flatten(F.collect_set("modules")) if "modules" in chosen.columns else F.collect_set("group")
    floors, caps = {"history": 4} if floors is None else floors, {"excision": 4, "net_new": 3} if caps is None else caps
    sums = chosen.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.size(F.array_distinct(names)).cast("long").alias("g"), *(F.count_if(F.col("source") == s).alias(f"s_{s}") for s in {**floors, **caps}))
    rules = [F.struct(F.lit("total").alias("rule"), F.col("n").alias("have"), F.lit(total).cast("long").alias("need"), (F.col("n") < total).alias("missed")), F.struct(F.lit("modules").alias("rule"), F.col("g").alias("have"), F.lit(least_groups).cast("long").alias("need"), (F.col("g") < least_groups).alias("missed"))]
    rules += [F.struct(F.lit(f"minimum_{s}").alias("rule"), F.col(f"s_{s}").alias("have"), F.lit(v).cast("long").alias("need"), (F.col(f"s_{s}") < v).alias("missed")) for s, v in floors.items()]
    rules += [F.struct(F.lit(f"maximum_{s}").alias("rule"), F.col(f"s_{s}").alias("have"), F.lit(v).cast("long").alias("need"), (F.col(f"s_{s}") > v).alias("missed")) for s, v in caps.items()]
    return sums.select(*keys, F.explode(F.array(*rules)).alias("r")).where("r.missed").select(*keys, "r.rule", "r.have", "r.need")


def until_enough(rows: DataFrame, keys: list[str], order: list[Column], eligible: Column, group: str, enough: int, groups: int) -> DataFrame:
    """Rows up to and with the first at which `enough` are eligible and cover `groups` groups; all if none is."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    first = Window.partitionBy(*keys, group).orderBy((~eligible).cast("int"), *order)
    rows = rows.withColumn("_new", (eligible & (F.row_number().over(first) == 1)).cast("int"))
    rows = rows.withColumn("_done", ((F.count_if(eligible).over(w) >= enough) & (F.sum("_new").over(w) >= groups)).cast("int"))
    return rows.withColumn("_past", F.sum("_done").over(w)).where("_past <= 1").where("_past = 0 or _done = 1").drop("_new", "_done", "_past")
