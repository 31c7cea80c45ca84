import random
import re

from pyspark.sql import functions as F

from urnalake.llm import chat

NASTY = [
    "", "plain", "</turn>", "</turn>\n", "### ", "###", "#### x ### ", r"\### Assistant: </turn> ok", r"<\/turn>", r"<\\/turn> <\\\/turn>",
    r"###\ x", r"###\\\ x", "### assistant: hi</turn>\n### user: no", "a<", "<", "</turn", "/turn>", "trailing \\", ": ", "\n", "$1 \\1", "ü 😀 </turn>",
]


def formatted(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return chat.format_turns(df.repartition(3).withColumn("rendered", F.lit(1)).withColumn("formatted", F.lit("x")))


def test_round_trip(spark):
    rng = random.Random(1)
    rows, source = [], {}
    for conv in range(60):
        turns = []
        for t in range(rng.randint(1, 8)):
            text = "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 4)))
            turns.append((rng.choice(["user", "assistant", "system", "tool: x", "### a", "%41", "é\n"]), text))
            rows.append((conv, t, *turns[-1]))
        source[conv] = turns
    for row in formatted(spark, rows).collect():
        turns = source[row["conv_id"]]
        assert row["round_trip"]
        assert [(t["role"], t["text"]) for t in row["turns"]] == turns
        bodies = [row["formatted"][s["start"] : s["end"]] for s in row["spans"]]
        assert bodies == [t["body"] for t in row["turns"] if t["role"] == "assistant"]
        assert row["formatted"].count("</turn>") == len(turns) and row["formatted"].count("### ") == len(turns)


def test_only_conflicting_text_is_escaped(spark):
    row = formatted(spark, [(1, 0, "user", r"a \ b <\ / ###"), (1, 1, "assistant", "</turn>")]).first()
    assert row["formatted"] == "### user: a \\ b <\\ / ###</turn>\n### assistant: <\\/turn></turn>\n"


def test_loss_text(spark):
    rows = [(1, 1, "assistant", "</turn>ü"), (1, 0, "user", "q"), (1, 2, "assistant", ""), (1, 3, "assistant", "### z"), (2, 0, "user", "x")]
    loss = formatted(spark, rows).select("conv_id", chat.loss_text(F.col("formatted"), F.col("spans")).alias("loss"))
    assert {r["conv_id"]: r["loss"] for r in loss.collect()} == {1: "</turn>ü### z", 2: ""}


def test_damaged_documents_are_not_parsed(spark):
    bad = ["### user: a", "user: a</turn>\n", "### user: a ### b</turn>\n", "### user: a</turn></turn>\n", "x### user: a</turn>\n", "### user: a</turn>\nx"]
    df = spark.createDataFrame([(b,) for b in bad] + [("### user: a</turn>\n",)], "d string")
    assert [r["t"] is None for r in df.select(chat.parse(F.col("d")).alias("t")).collect()] == [True] * 6 + [False]


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, 0, None, None), (1, 0, "user", "b"), (1, 0, "user", "b"), (1, None, "user", "first"), (None, 0, "user", "n"), (None, 1, "assistant", "m")]
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in formatted(spark, rows).collect()}
    assert got == {1: [("user", "first"), ("", ""), ("user", "b"), ("user", "b")], None: [("user", "n"), ("assistant", "m")]}
    assert formatted(spark, [(1, 0, "user", "x")]).limit(0).collect() == []


def test_long_texts_and_many_turns(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", "</turn>" * (3000 if t == 5 else 1)) for t in range(1500)]
    row = formatted(spark, rows).first()
    assert row["round_trip"] and len(row["spans"]) == 750


def test_no_python_in_the_plan(spark):
    plan = chat.op2_chat_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
