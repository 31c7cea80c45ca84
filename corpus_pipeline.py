"""From documents to training tokens: five stages, each a table that the next one reads.

    language ID → near duplicates → repeated passages → mixing → tokens
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urnalake.llm import bpe, langid, mixing, neardup, substrings
from urnalake.session import scratch_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the ones that language ID rejects go."""
    judged = langid.identify(docs.select(*COLUMNS), langid.train(docs))
    return judged.where("NOT rejected").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    gone = neardup.near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of passages that start earlier; documents left empty by it go.

    A text that loses nothing stays as it is, white space included.
    """
    cut = substrings.remove_repeats(docs.select(*COLUMNS).withColumn("whole", F.col("text")))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.whole"))
    left = cut.where("n_removed = 0 OR n_removed < n_words").select("row.*", text.alias("text"))
    return left.select(
        "doc_id", "text", "lang", "source",
        F.when(F.col("text").eqNullSafe(F.col("whole")), F.col("n_chars")).otherwise(F.char_length("text")).alias("n_chars"),
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens have the target shares of sources, languages and topics."""
    return mixing.mixed(docs).where("kept").select(*COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of what they decode to."""
    coded = bpe.encode_and_digest(docs.select("doc_id", "lang", "source", "text"), bpe.tokenizer_path())
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded_sha256")


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("substring dedup", drop_repeated_passages),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode_tokens),
]

#: Training, components and raking are iterative: tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared scratch folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_folder(spark, "corpus-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
