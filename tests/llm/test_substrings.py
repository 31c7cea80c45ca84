import random

import pytest
from brute import invented, kept_words
from pyspark.sql import functions as F

from urnalake.llm.substrings import PIECE_WORDS, remove_repeats


def removed(df, **options):
    rows = remove_repeats(df, **options).select("row.doc_id", "n_words", "n_removed", "kept").collect()
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[3]))


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[3]))


@pytest.mark.parametrize(("seed", "size"), [(1, 20), (2, 20), (3, 7), (4, 1), (5, 2), (6, 50)])
def test_equals_brute_force(spark, seed, size):
    docs = list(enumerate(invented(seed, 120, 150, 30 if seed == 3 else 400)))
    assert removed(table(spark, docs), size=size) == order(kept_words(docs, size))


def test_few_words_repeat_within_a_text(spark):
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choice("ab") for _ in range(120))) for i in range(20)] + [(99, "a " * 300)]
    assert removed(table(spark, docs)) == order(kept_words(docs, 20))


def test_seed_with_very_many_contexts(spark):
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(24))
    docs = [(i, " ".join(f"x{rng.random()}" for _ in range(30)) + f" {passage} " + " ".join(f"y{rng.random()}" for _ in range(30))) for i in range(300)]
    got = removed(table(spark, docs).coalesce(1))
    assert got == order(kept_words(docs, 20))
    assert [r[2] for r in got] == [0] + [24] * 299


def test_text_longer_than_a_piece(spark):
    long = [f"w{i}" for i in range(PIECE_WORDS + 300)]
    passage = long[PIECE_WORDS - 15 : PIECE_WORDS + 25]
    docs = [(1, " ".join(long)), (2, " ".join(["a", *passage, "b"]))]
    got = removed(table(spark, docs))
    assert [(r[0], r[1], r[2]) for r in got] == [(1, len(long), 0), (2, 42, 40)]
    assert got[1][3] == "a b"


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(25))
    docs = [
        (5, text), (5, text), (None, text), (3, None), (4, ""), (6, " \t\n\x0b "), (7, "a b c\x1cd"), (8, text + " tail"),
    ]
    assert removed(table(spark, docs)) == order(kept_words(docs, 20))


def test_rows_that_share_an_id_only(spark):
    text = " ".join(f"w{i}" for i in range(25))
    docs = [(1, text + " one"), (1, "two " + text), (2, text)]
    assert removed(table(spark, docs)) == order(kept_words(docs, 20))


def test_other_columns_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(25))
    df = table(spark, [(1, text), (2, text)]).select("doc_id", "text", *(F.lit(c).alias(c) for c in ("id", "tag", "row", "kept", "spans", "start")))
    rows = remove_repeats(df).orderBy("row.doc_id").collect()
    assert [(r["row"]["id"], r["row"]["kept"], r["kept"]) for r in rows] == [("id", "kept", text), ("id", "kept", "")]
    assert removed(table(spark, [])) == []
