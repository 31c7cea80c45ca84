import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from urnalake.llm import langid

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def models(spark):
    return langid.train(spark.read.parquet(f"{SF}/documents.parquet"))


def test_held_out_accuracy(spark, models):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(langid.is_held_out(F.col("doc_id")))
    rows = langid.identify(docs, models).select("lang", "lang_pred", "rejected").collect()
    assert len(rows) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.99 * len(rows)
    assert sum(r["rejected"] for r in rows) <= 0.01 * len(rows)


def test_strange_texts_are_rejected(models):
    for text in ("мама мыла раму " * 40, "xqzjk vvkq zzxw qqj " * 40, "Το γρήγορο καφέ άλογο " * 40):
        assert models.judge(text)[2]


def test_probabilities_of_a_context_sum_to_one():
    grams = {"lang": "l", "gram": ["   a", "  ab", " aba", "abab", "abac", " abb", "abb ", "bac ", "aba "], "n": [3, 3, 2, 4, 1, 1, 1, 2, 1]}
    models = langid.build_models(pd.DataFrame(grams))
    alphabet = sorted({c for g in grams["gram"] for c in g[1:]})
    for context in ("aba", " ab", "bac", "xyz", "  a"):
        total = 0.0
        for c in [*alphabet, "?"]:
            codes = np.array([ord(x) for x in context + c], np.uint64)
            total += np.exp(-models.entropies(codes)[0][0])
        # Characters never seen share one place of the alphabet.
        assert total == pytest.approx(1.0)


def test_odd_texts(spark, models):
    rows = [(1, None), (2, ""), (3, "123 $$$ 😀"), (4, "é"), (5, "the and of thing " * 60_000), (4, "é")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("mine")).withColumn("row", F.lit(1))
    got = {r["doc_id"]: r for r in langid.identify(df, models).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3
    assert [got[i]["score"] for i in (1, 2, 3)] == [0.0] * 3
    assert got[4]["lang_pred"] in models.languages and got[5]["lang_pred"] == "en"
    assert langid.identify(df, models).count() == 6
    assert langid.identify(df.limit(0), models).collect() == []


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "abc", None), (2, None, "en")], "doc_id long, text string, lang string")
    models = langid.train(df)
    assert models.languages == [] and models.judge("abc") == ("und", 0.0, True)


def test_held_out_rows_teach_nothing(spark):
    rows = [(i, f"text number {i} " * 5, "en") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    poisoned = df.withColumn("text", F.when(langid.is_held_out(F.col("doc_id")), F.lit("ЖЖЖ")).otherwise(F.col("text")))
    a, b = langid.train(df), langid.train(poisoned)
    assert all((a.grams[k][0] == b.grams[k][0]).all() for k in a.grams)


def test_long_texts_are_scored_in_pieces(models, monkeypatch):
    codes = langid.codes_of("of the thing and then er was on " * 300)
    whole = models.entropies(codes)
    monkeypatch.setattr(langid, "PIECE_CHARS", 100)
    assert np.allclose(whole[0], models.entropies(codes)[0])


def kneser_ney(texts_of, order):
    """Per language a function (context, character) -> probability, from the definition."""
    models, alphabet = {}, set()
    for lang, texts in texts_of.items():
        counts = Counter()
        for text in texts:
            codes = langid.codes_of(text).tolist()
            counts.update(tuple(codes[i : i + order]) for i in range(len(codes) - order + 1))
        levels = {order: counts}
        for k in range(order - 1, 0, -1):
            levels[k] = Counter(g[1:] for g in levels[k + 1])
        alphabet |= set(levels[1])
        models[lang] = levels

    def probability(lang, context, character):
        p = 1.0 / (len(alphabet) + 1)
        for k in range(1, order + 1):
            level, own = models[lang][k], context[len(context) - k + 1 :]
            once, twice = (sum(n == m for n in level.values()) for m in (1, 2))
            d = once / (once + 2 * twice) if once else 0.5
            followers = [n for g, n in level.items() if g[:-1] == own]
            if followers:
                p = max(level[own + (character,)] - d, 0.0) / sum(followers) + d * len(followers) / sum(followers) * p
        return p

    return probability


def test_entropies_equal_the_definition():
    texts = {"a": ["the cat sat on the mat", "the rat sat", "that hat"], "b": ["le chat est la", "la table est belle", "le rat"]}
    rows = []
    for lang, own in texts.items():
        for text in own:
            codes = langid.codes_of(text).tolist()
            rows += [(lang, "".join(map(chr, codes[i : i + 4])), 1) for i in range(len(codes) - 3)]
    models = langid.build_models(pd.DataFrame(rows, columns=["lang", "gram", "n"]))
    probability = kneser_ney(texts, langid.ORDER)
    for text in ("the table", "chat", "xyz zq", "le rat sat on that"):
        codes = langid.codes_of(text).tolist()
        found, n = models.entropies(langid.codes_of(text))
        for column, lang in enumerate(models.languages):
            logs = [math.log(probability(lang, tuple(codes[i : i + 3]), codes[i + 3])) for i in range(len(codes) - 3)]
            assert n == len(logs) and found[column] == pytest.approx(-sum(logs) / n, rel=1e-5)


def test_too_many_labels_raise(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 2)
    rows = [(i, "some text", f"l{i}") for i in range(12)]
    with pytest.raises(ValueError, match="languages"):
        langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
