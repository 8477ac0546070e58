import hashlib

from pyspark.sql import functions as F

from strataquarry.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["</s>", "[INST]", "[/INST]", "<s>", "<s e>", "&lt;", "&amp;lt;", "&#91;", "<", "[", "</s", "<s", "", "é\n\n", "a</s>[INST]b[/INST]c</s>"]


def test_round_trip_of_hostile_texts(spark):
    data = [(i, j, r, x) for i, x in enumerate(NASTY) for j, r in enumerate(("user", "assistant", "a[/INST]b"))]
    out = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(data, SCHEMA)).collect()}
    for i, x in enumerate(NASTY):
        assert [(t.role, t.text) for t in out[i].turns] == [("user", x), ("assistant", x), ("a[/INST]b", x)]
    assert "&" not in chat.format_conversations(spark.createDataFrame([(1, 0, "user", "a & b")], SCHEMA)).first().formatted.replace("a & b", "")


def test_digests(spark):
    data = [(1, 1, "assistant", "yo"), (1, 0, "user", "hi"), (1, 2, "assistant", None), (None, 0, None, "x"), (2, 0, "user", "b"), (2, 0, "user", "a")]
    df = spark.createDataFrame(data, SCHEMA).withColumns({"formatted": F.lit(1), "turns": F.lit(2), "_marks": F.lit(3)})
    out = {r.conv_id: r for r in chat.digests(chat.format_conversations(df)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (out[1].n_turns, out[1].turns_sha256, out[1].loss_chars, out[1].loss_sha256) == (3, sha("user\nhi\nassistant\nyo\nassistant\n\n"), 2, sha("yo"))
    assert out[None].turns_sha256 == sha("\nx\n")
    assert out[2].turns_sha256 == sha("user\na\nuser\nb\n") and out[2].loss_chars == 0
    assert chat.format_conversations(df.where("false")).count() == 0


def test_a_broken_rendering_is_not_parsed(spark):
    df = spark.createDataFrame([("<s>[INST]u[/INST]x</s>y",), ("<s>[INST]u[/INST]x",), ("",)], "r string")
    assert [r.t for r in chat.parsed(df, "r", "t").collect()] == [None, None, []]


def test_hostile_conversation(spark):
    rows = chat.hostile(spark.createDataFrame([(1, 0, "user", "x")], SCHEMA))
    turns = {r.conv_id: r.turns for r in chat.format_conversations(rows).collect()}[-7]
    assert [(t.role, t.text) for t in turns] == [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]


def test_very_long_texts_ties_and_clashing_columns(spark):
    marks = "</s>[INST]" * 20_000
    rows = [(1, 0, "user", marks, "x", "y"), (1, 0, "user", marks, "x", "y"), (1, 1, "assistant", "a" * 1_000_000, "x", "y"), (2, 0, None, "&lt; <s e> &", "x", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, source string, formatted string")
    got = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [("user", marks), ("user", marks), ("assistant", "a" * 1_000_000)]
    assert [(t.role, t.text) for t in got[2].turns] == [("", "&lt; <s e> &")]
