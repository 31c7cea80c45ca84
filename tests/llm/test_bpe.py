import hashlib
import random

import numpy as np
import pytest
from brute import sha
from pyspark.sql import functions as F

from urnalake.llm import bpe

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def model():
    with open(bpe.tokenizer_path(), "rb") as file:
        return bpe.model_of(file.read())


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(bpe.tokenizer_path())


ODD = [
    "", " \n\t ", "ΣΑΣ ΟΔΥΣΣΕΥΣ", "İstanbul ẞ ŉ", "a\x1cb\x85c d　e​f", "don't I'LL we've 'S", "é é ́",
    "x<|endoftext|>y<|startoftext|><|endoftext|>", "<|endoftext", "漢字かな交じり文" * 200, "abc" * 3000, "a" * 1000, "1234 ½ ²", "👩‍👩‍👧 🏽",
    "\u0000", "֋՘a", "한국어", "((((((((!!!!????" * 40,
]


def test_equals_the_library(model, library):
    rng = random.Random(5)
    texts = ODD + [
        "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(128, 0x600), rng.randrange(0x2000, 0x3100)])) for _ in range(40))
        for _ in range(300)
    ]
    for text, ids in zip(texts, model.encode_batch(texts), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, repr(text)
        assert model.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_long_words_and_words_side_by_side_agree(model):
    rng = random.Random(6)
    for length in (1, 2, 3, 17, 64):
        words = ["".join(rng.choice("etaoinshr") for _ in range(n)).encode() for n in (min(length, 64), 1, 3)]
        ids, counts = model.merge(*model.symbols(words))
        alone = [model.merge_alone(model.symbols([w])[0].tolist()) for w in words]
        assert ids.tolist() == sum(alone, []) and counts.tolist() == list(map(len, alone))


def test_lowest_rank_first_then_leftmost(model):
    """Against the definition: look at all pairs, merge the leftmost one of lowest rank."""
    rng = random.Random(7)
    for _ in range(50):
        word = ("".join(rng.choice("the an") for _ in range(12)).replace(" ", "") or "a").encode()
        s = model.symbols([word])[0].tolist()
        mine = model.merge_alone(s)
        assert model.merge(*model.symbols([word]))[0].tolist() == mine
        while True:
            ranked = [(model.pair_table[(a << 32) | b][0], i) for i, (a, b) in enumerate(zip(s, s[1:], strict=False)) if (a << 32) | b in model.pair_table]
            if not ranked:
                break
            i = min(ranked)[1]
            s[i : i + 2] = [model.pair_table[(s[i] << 32) | s[i + 1]][1]]
        assert mine == s


def test_text_cut_into_pieces(model, library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE_CHARS", 50)
    text = "Ünïcode words, and <|endoftext|> more of them. " * 40
    assert np.frombuffer(model.encode_batch([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_every_code_point_as_the_library(model, library):
    every = [chr(c) for c in range(0x20, 0x110000) if not 0xD800 <= c < 0xE000]
    for begin in range(0, len(every), 2048):
        texts = [f"a{c}b 1{c}! e{c}\u0301" for c in every[begin : begin + 2048]]
        mine = [np.frombuffer(ids, "<u4").tolist() for ids in model.encode_batch(texts)]
        theirs = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert [t for t, a, b in zip(texts, mine, theirs, strict=True) if a != b] == []


def test_memory_of_words_is_bounded(model, library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 50)
    monkeypatch.setattr(bpe, "PIECE_CHARS", 100)
    text = " ".join(f"w{i % 70} x{i}y" for i in range(400))
    assert np.frombuffer(model.encode_batch([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_tables(spark, library):
    rows = [(1, "Hello world"), (1, "Hello world"), (2, None), (None, ""), (3, "x" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("theirs")).withColumn("decoded", F.lit(1))
    out = bpe.decode(bpe.encode(df, bpe.tokenizer_path()), bpe.tokenizer_path()).collect()
    for row in out:
        expected = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["ids"] == expected
        assert row["decoded"] == library.decode(expected, skip_special_tokens=False)
    both = bpe.encode_and_digest(df.withColumn("decoded_sha256", F.lit(0)), bpe.tokenizer_path())
    assert both.columns == ["doc_id", "text", "decoded", "ids", "decoded_sha256"]
    assert sorted((r["ids"], r["decoded_sha256"]) for r in both.collect()) == sorted((r["ids"], sha(r["decoded"])) for r in out)
    digests = bpe.token_digests(df, bpe.tokenizer_path())
    got = sorted((r["doc_id"] or 0, r["n_tokens"], r["decoded_sha256"]) for r in digests.collect())
    assert got[:3] == [(0, 0, sha("")), (1, 2, sha("hello</w> world</w>")), (1, 2, sha("hello</w> world</w>"))]
    assert bpe.token_digests(df.limit(0), bpe.tokenizer_path()).collect() == []


def test_query_equals_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for row in bpe.op5_bpe(spark, sf).collect():
        ids = library.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))
