import hashlib
import random

import numpy as np
import pytest
import regex
from brute import sha
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from urnalake.llm import scripts, wordbpe

tiktoken = pytest.importorskip("tiktoken")
PATH, PATTERN = wordbpe.rank_file()


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as file:
        return wordbpe.read_ranks(file.read())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = [
    "", " \n\t ", "a  b   c\n\n d", "don't I'LL we've 'S", "x<|endoftext|>y", "漢字かな交じり文" * 20, "abc" * 300, "a" * 1000, "1234 ½ ²",
    "👩‍👩‍👧 🏽", "\u0000", "֋՘a", "한국어", "((((!!!!????" * 9, "a\x85b\xa0c　d e", "é ñ ŋ ɏɐ", "é" * 70, "a\x1cb\x1d c", " 's'",
]


def test_splits_and_merges_as_the_library(ranks, library):
    rng = random.Random(5)
    splitter = wordbpe.Splitter(PATTERN)
    texts = ODD + [
        "".join(chr(rng.choice([rng.randrange(32, 127), 32, 10, rng.randrange(128, 0x600), rng.randrange(0x2000, 0x3100)])) for _ in range(40))
        for _ in range(300)
    ]
    for text in texts:
        mine = [i for words in splitter.words(text) for w in words for i in wordbpe.merge(w.encode(), ranks)]
        assert mine == library.encode_ordinary(text), repr(text)
        assert wordbpe.decoded(np.array(mine, "<u4"), wordbpe.token_table(ranks)) == text.encode()


def test_every_code_point_is_classed_as_by_the_library():
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for name, newer in ((r"\p{L}", scripts.NEWER_LETTERS), (r"\p{N}", scripts.NEWER_NUMBERS), (r"\s", ())):
        own = tiktoken.Encoding(name, pat_str=name, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        older = regex.compile(f"(?V1)[{name}--[{scripts.character_set(newer)}]]" if newer else name)
        assert "".join(older.findall(every)) == own.decode(own.encode_ordinary(every))
    splitter, exact = wordbpe.Splitter(PATTERN), scripts.with_older_classes(PATTERN)
    for begin in range(0, len(every), 64):
        text = "".join(f"a{c}a 1{c}1 !{c}! " for c in every[begin : begin + 64])
        assert [w for words in splitter.words(text) for w in words] == exact.findall(text)


def test_lowest_rank_first_then_leftmost(ranks):
    rng = random.Random(7)
    for length in (2, 5, 30, 48, 49, 200):
        word = bytes(rng.choice(b"the anx") for _ in range(length))
        parts = [word[i : i + 1] for i in range(length)]
        while word not in ranks:
            ranked = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
            if not ranked:
                break
            i = min(ranked)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert wordbpe.merge(word, ranks) == ([ranks[word]] if word in ranks else [ranks[p] for p in parts])


def test_long_texts_in_pieces(library, ranks, monkeypatch):
    monkeypatch.setattr(wordbpe, "PIECE_CHARS", 30)
    splitter = wordbpe.Splitter(PATTERN)
    for text in ("Some words,  and more \n of them 's a " * 20, "x" * 200, " " * 300, "ab cd" + " " * 90 + "ef gh " * 30):
        lists = list(splitter.words(text))
        assert [i for words in lists for w in words for i in wordbpe.merge(w.encode(), ranks)] == library.encode_ordinary(text)


def test_tables(spark, library):
    texts = [*ODD, None, "x y " * 3000, "Same text", "Same text"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (None, None), (3, "again"), (3, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("theirs")).withColumn("id", F.lit(1)).withColumn("bundle", F.lit(2))
    coded = wordbpe.encode(df.repartition(3), PATH, PATTERN)
    got = wordbpe.decode(coded.withColumn("decoded", F.lit(1)).withColumn("more", F.lit("x")), PATH).collect()
    expected = [(k, library.encode_ordinary(t or ""), (t or "").encode()) for k, t in rows]
    assert sorted(((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in got), key=str) == sorted(expected, key=str)
    digests = wordbpe.digests(coded, PATH).where("doc_id = 3").collect()
    ids = library.encode_ordinary("again")
    assert len([r for r in digests if r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()]) == 2
    assert wordbpe.digests(wordbpe.encode(df.limit(0), PATH, PATTERN), PATH).collect() == []
    assert wordbpe.decode(spark.createDataFrame([(None,)], "ids array<int>"), PATH).collect()[0]["decoded"] == b""
    with pytest.raises(PySparkException, match="no token"):
        wordbpe.decode(spark.createDataFrame([([60000],)], "ids array<int>"), PATH).collect()


def test_small_bundles(spark, library, monkeypatch):
    """Many bundles of few documents share the words' partitions."""
    import pyarrow as pa

    splitter = wordbpe.Splitter(PATTERN)
    monkeypatch.setattr(wordbpe, "BUNDLE_CHARS", 10)
    batch = pa.RecordBatch.from_pydict({"id": list(range(6)), "text": ["one two", "three four five", None, "", "six", "seven eight"]})
    assert [len(b.keys) for b in wordbpe._bundles([batch], splitter)] == [2, 4]


def test_query_equals_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = wordbpe.op13_word_shuffle_bpe(spark, sf).collect()
    assert len(got) == len(texts)
    for row in got:
        ids = np.array(library.encode_ordinary(texts[row["doc_id"]] or ""), "<u4")
        assert (row["n_tokens"], row["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert row["decoded_sha256"] == sha(texts[row["doc_id"]] or "")
