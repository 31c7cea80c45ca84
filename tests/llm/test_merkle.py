import hashlib
import random
import re
from datetime import date, timedelta
from decimal import Decimal

import pytest
from brute import sha
from pyspark.sql import functions as F

from urnalake.llm import merkle


PARAGRAPH, PIECE = r"[^\n]*\n|[^\n]+", r"(?s).{7,63}?[ e]|.{1,64}"


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def root(text):
    sections = re.findall(r"(?s).+?(?:\n{2,}|\Z)", text)
    paragraph = lambda p: sha("".join(map(md5, re.findall(PIECE, p))))
    return sha("".join(sha("".join(map(paragraph, re.findall(PARAGRAPH, s)))) for s in sections))


def leaves(text):
    return {x for p in re.findall(PARAGRAPH, text) for x in re.findall(PIECE, p)}


def likeness(a, b):
    if a == b or not (leaves(a) or leaves(b)):
        return 1.0
    return 2 * len(leaves(a) & leaves(b)) / (len(leaves(a)) + len(leaves(b)))


def expected(docs):
    docs = sorted(((k, t or "") for k, t in docs), key=lambda d: (d[0] is None, d[0] or 0, d[1]))
    out = []
    for i, (key, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1]
        n = len(text) // 4
        edited = text[: len(text) - n] + following[:n]
        out.append((key, len(text), sha(edited), root(text), root(edited), likeness(text, edited), likeness(text, following)))
    return sorted(out, key=str)


CASES = {
    "mixed": [(i * 3, f"Line {i}\n\nSecond section {i % 3}\nmore ü😀 text {i % 2}\n" * (i % 4)) for i in range(60)],
    "one": [(4, "alone\nin the table")],
    "nulls": [(None, "no id"), (3, None), (1, ""), (2, "abc"), (None, None)],
    "ties": [(1, "b"), (1, "a"), (1, "a"), (2, "same text here"), (2, "same text here")],
    "long": [(1, "word " * 40_000), (2, "\n" * 500), (3, "x" * 30_000)],
}


@pytest.mark.parametrize("name", CASES)
def test_equals_brute_force(spark, name):
    df = spark.createDataFrame(CASES[name], "doc_id long, text string").repartition(3)
    df = df.withColumn("range", F.lit(1)).withColumn("fingerprint", F.lit("x")).withColumn("id", F.lit(7))
    assert sorted(map(tuple, merkle.fingerprints(df).collect()), key=str) == expected(CASES[name])


@pytest.mark.parametrize(
    ("kind", "make"),
    [("long", lambda i: 2**60 + 3 * i), ("string", lambda i: f"id-{i * 7919 % 1000}"), ("date", lambda i: date(2000, 1, 1) + timedelta(i)),
     ("decimal(30,2)", lambda i: Decimal(10**25 + i)), ("int", lambda i: -i)],
)
def test_ids_of_any_size_and_kind(spark, kind, make):
    docs = [(make(i), f"text {i} " * (i % 9)) for i in range(400)]
    got = sorted(map(tuple, merkle.fingerprints(spark.createDataFrame(docs, f"doc_id {kind}, text string")).collect()), key=str)
    ordered = sorted(docs)
    numbered = {r[0]: r[1:] for r in expected([(i, t) for i, (_, t) in enumerate(ordered)])}
    assert got == sorted(((key, *numbered[i]) for i, (key, _) in enumerate(ordered)), key=str)


def test_a_character_in_front_changes_little(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(800)]
    text = " ".join(words)
    df = spark.createDataFrame([(text, "X" + text)], "a string, b string")
    alike = df.select(merkle.likeness(merkle.tree(F.col("a")), merkle.tree(F.col("b")))).first()[0]
    assert 0.8 < alike < 1.0 and alike == likeness(text, "X" + text)


def test_empty_table(spark):
    assert merkle.fingerprints(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_no_python_in_the_plan(spark):
    plan = merkle.op9_merkle(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert plan.split("== Physical Plan ==")[1].count("SinglePartition") == 0


def test_edits_are_located(spark):
    before = "A one\nA two\n\nB one\nB two\n\nC one\n"
    after = "A one\nA two\n\nB one\nB changed\nB new\n\nC one\n\nD one\n"
    df = spark.createDataFrame([(before, after)], "a string, b string")
    found = df.select(merkle.edits(merkle.tree(F.col("a")), merkle.tree(F.col("b"))).alias("e")).first()["e"]
    # The last section of the first text gets another line break, so it differs as well.
    assert [(e["section"], e["paragraphs"]) for e in found] == [(1, [1, 2, 3]), (2, [1]), (3, [0])]
    same = df.select(merkle.edits(merkle.tree(F.col("a")), merkle.tree(F.col("a"))).alias("e")).first()["e"]
    assert same == []


def test_empty_text_has_an_empty_tree(spark):
    df = spark.createDataFrame([("", None)], "a string, b string")
    row = df.select(merkle.tree(F.col("a")).alias("a"), merkle.tree(F.col("b")).alias("b")).first()
    assert row["a"] == row["b"] == []
