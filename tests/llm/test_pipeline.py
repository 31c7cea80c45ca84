import numpy as np
import pytest
from brute import kept_words, near_duplicates, sha
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from urnalake.llm import langid, mixing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's input and result, as rows."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*pipeline.COLUMNS)
    odd = [(-1, None, "en", "src0", 0), (-2, "123 $$$", None, None, 7), (-3, "", "en", "src1", 0)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    out = []
    for i, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{i}")
        after = spark.read.parquet(f"{folder}/{i}")
        out.append((name, docs, after))
        docs = after
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_all_but_the_last_return_documents(stages):
    for _, _, after in stages[:-1]:
        assert after.columns == pipeline.COLUMNS
    assert [name for name, _ in pipeline.STAGES] == [name for name, _, _ in stages]


def test_language(spark, stages):
    _, before, after = stages[0]
    models = langid.train(before)
    expected = {k for k, r in rows(before).items() if not models.judge(r["text"])[2]}
    assert rows(after).keys() == expected
    assert len(expected) >= 0.97 * before.where("doc_id >= 0").count()
    assert not {-1, -2, -3} & expected


def test_near_duplicates(stages):
    _, before, after = stages[1]
    found = near_duplicates([(r["doc_id"], r["text"]) for r in before.collect()])
    assert rows(after).keys() == {k for k, v in found.items() if v[2]}


def test_passages(stages):
    _, before, after = stages[2]
    source = rows(before)
    expected = {}
    for key, n, removed, kept in kept_words([(k, r["text"]) for k, r in source.items()], 20):
        if not removed:
            expected[key] = source[key]["text"]
        elif removed < n:
            expected[key] = kept
    got = rows(after)
    assert {k: r["text"] for k, r in got.items()} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_mixing(stages):
    _, before, after = stages[3]
    judged = mixing.mixed(before)
    assert rows(after).keys() == {r["doc_id"] for r in judged.where("kept").collect()}


def test_tokens(stages):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(pipeline.bpe.tokenizer_path())
    _, before, after = stages[4]
    texts, got = rows(before), rows(after)
    assert got.keys() == texts.keys()
    for key, row in got.items():
        ids = library.encode(texts[key]["text"], add_special_tokens=False).ids
        assert np.array(row["ids"]).tolist() == ids and row["n_tokens"] == len(ids)
        assert row["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))


def test_run_applies_all_stages(spark, stages):
    whole = pipeline.run(spark, SF)
    assert whole.count() > 0 and whole.columns == stages[-1][2].columns
    assert whole.where(F.col("n_tokens") != F.size("ids")).count() == 0
