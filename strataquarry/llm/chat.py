r"""Chat formatting by a grammar round trip, in DataFrame functions only.

    conversation := turn*          turn := ("<s>" | "<s e>") "[INST]" role "[/INST]" text "</s>"

The five quoted marks are control strings. The parser splits at them and accepts a rendering only if they stand in that
order with nothing between turns. A conversation is rendered raw first; if what the parser recovers differs from the
source, each turn that does not survive alone is escaped (& < [ become &amp; &lt; &#91; and the turn opens with "<s e>"),
and the result is parsed again. It must then be identical, or the query fails.

Defined results: rows order by turn, then role, then text (nulls first); null role or text reads as empty; a null conv_id
is a conversation of its own; repeated rows are turns of their own; only turns of role `assistant` carry loss; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROL = r"<s>|<s e>|\[INST\]|\[/INST\]|</s>"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
TURNS = "array<struct<role:string,text:string>>"


def escape(c: Column) -> Column:
    for plain, coded in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescape(c: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def render_turn(turn: Column, escaped: bool) -> Column:
    role, text = turn["role"], turn["text"]
    if escaped:
        role, text = escape(role), escape(text)
    return F.concat(F.lit("<s e>" if escaped else "<s>"), F.lit("[INST]"), role, F.lit("[/INST]"), text, F.lit("</s>"))


def parsed(df: DataFrame, rendered: str, out: str) -> DataFrame:
    """df with the turns of a rendering as `out`; null where it is not in the language. Marks are found once a row."""
    df = df.withColumn("_marks", F.regexp_extract_all(rendered, F.lit(CONTROL), F.lit(0))).withColumn("_parts", F.split(rendered, CONTROL, -1))
    n = F.floor(F.size("_marks") / 4).cast("int")
    numbers = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def mark(i: Column, k: int) -> Column:
        return F.get("_marks", i * 4 + k)

    def part(i: Column, k: int) -> Column:
        return F.get("_parts", i * 4 + k)

    fits = F.forall(numbers, lambda i: mark(i, 0).isin("<s>", "<s e>") & (mark(i, 1) == "[INST]") & (mark(i, 2) == "[/INST]") & (mark(i, 3) == "</s>") & (part(i, 0) == "") & (part(i, 1) == ""))
    well = (F.size("_marks") == n * 4) & fits & (F.get("_parts", n * 4) == "")
    coded = lambda i, k: F.when(mark(i, 0) == "<s e>", unescape(part(i, k))).otherwise(part(i, k))
    turns = F.transform(numbers, lambda i: F.struct(coded(i, 2).alias("role"), coded(i, 3).alias("text")))
    return df.withColumn(out, F.when(well, turns)).drop("_marks", "_parts")


def survives(turn: Column) -> Column:
    """Whether the parser gets a turn back from its raw rendering alone."""
    return F.split(render_turn(turn, False), CONTROL, -1) == F.array(F.lit(""), F.lit(""), turn["role"], turn["text"], F.lit(""))


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (parsed back) of every conversation of rows(conv_id, turn, role, text)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = F.sort_array(F.collect_list(F.struct("turn", text("role").alias("role"), text("text").alias("text"))))
    found = rows.groupBy("conv_id").agg(turns.alias("rows"))
    found = found.select("conv_id", F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("source"))
    found = parsed(found.withColumn("raw", F.array_join(F.transform("source", lambda t: render_turn(t, False)), "")), "raw", "back")
    alone = F.transform("source", lambda t: F.when(survives(t), render_turn(t, False)).otherwise(render_turn(t, True)))
    same = F.coalesce(F.col("back") == F.col("source"), F.lit(False))
    found = found.select("conv_id", "source", F.when(same, F.col("raw")).otherwise(F.array_join(alone, "")).alias("formatted"))
    found = parsed(found, "formatted", "turns")
    identical = F.coalesce(F.col("turns") == F.col("source"), F.lit(False))
    return found.select("conv_id", "formatted", F.when(identical, F.col("turns")).otherwise(F.raise_error(F.concat(F.lit("no round trip: "), F.col("formatted"))).cast(TURNS)).alias("turns"))


def digests(formatted: DataFrame) -> DataFrame:
    """The contract's columns, read back from a result of format_conversations()."""
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    return formatted.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def hostile(rows: DataFrame) -> DataFrame:
    """rows and conversation -7, whose texts are made of control strings."""
    spark, text = rows.sparkSession, "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, '{text}' AS text FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)")
    return rows.select("conv_id", "turn", "role", "text").unionByName(extra)
