"""Language identification by interpolated Kneser-Ney models over characters.

Each language has a model of the character after its three predecessors. All models lie in one
pair of sorted hash arrays per order: probabilities by n-gram, back-off weights by context, a
column for each language. A text gets the language with the lowest cross-entropy per character,
unless that is beyond what labelled texts of the language reach.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urnalake.checks.registry import check
from urnalake.llm.common import ship, table
from urnalake.llm.words import mix, window_hashes

ORDER = 4
#: Labelled texts per language that are used, those with the smallest hashes of their ids: about as
#: many as given here, four fifths to count on and a fifth to calibrate rejection on.
TRAIN_DOCS = 2_500
#: Languages at most: the driver holds the n-grams of TRAIN_DOCS texts of each. More labels raise.
MOST_LANGUAGES = 400
#: Where only one language is learned: rejected beyond so many times its own texts' largest excess.
SLACK = 4.0
#: Characters beyond which an entropy counts as exact, for excess and score.
SETTLED = 400
UNKNOWN = "und"
#: Characters scored at a time.
PIECE_CHARS = 1 << 19


def is_held_out(key: Column) -> Column:
    """The quarter of all documents that nothing is learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


# Text to codes

_SPACE = 32
_FOLD: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """Per code point: its lower case where it is a letter, else a space."""
    if not _FOLD:
        table_of = np.full(0x110000, _SPACE, np.uint32)
        for code in range(0x110000):
            letter = chr(code)
            if letter.isalpha():
                low = letter.lower()
                table_of[code] = ord(low) if len(low) == 1 else code
        _FOLD.append(table_of)
    return _FOLD[0]


def codes_of(text: str | None) -> np.ndarray:
    """Letters in lower case, anything between them as one space, and ORDER - 1 spaces in front.

    Empty if there is no letter.
    """
    if not text:
        return np.zeros(0, np.uint64)
    codes = _fold()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    space = codes == _SPACE
    if space.all():
        return np.zeros(0, np.uint64)
    space[1:] &= space[:-1]
    space[0] = codes[0] == _SPACE
    return np.concatenate([np.full(ORDER - 1, _SPACE, np.uint64), codes[~space].astype(np.uint64), [np.uint64(_SPACE)]])


def hashes_of(codes: np.ndarray, order: int) -> np.ndarray:
    return mix(window_hashes(codes, order) + np.uint64(order << 56))


def _codes_of_gram(gram: str) -> np.ndarray:
    return np.array([ord(c) for c in gram], np.uint64)


# Counting and models

def count_grams(docs: DataFrame, label: str, text: str) -> DataFrame:
    """(lang, gram, n) over all texts given."""
    ship(docs.sparkSession)

    def counted(lang: str, texts: list[np.ndarray]) -> pa.RecordBatch:
        joined = np.concatenate(texts)
        # Windows that reach from a text into the next are left out.
        inside = np.concatenate([np.arange(len(t)) <= len(t) - ORDER for t in texts])[: len(joined) - ORDER + 1]
        places = np.flatnonzero(inside)
        _, first, n = np.unique(hashes_of(joined, ORDER)[places], return_index=True, return_counts=True)
        grams = ["".join(map(chr, joined[p : p + ORDER].tolist())) for p in places[first]]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(grams)), pa.array(grams), pa.array(n, pa.int64())], names=["lang", "gram", "n"]
        )

    def run(batches):
        for batch in batches:
            held: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                codes = codes_of(text.as_py())
                if len(codes):
                    held.setdefault(lang, []).append(codes)
                    if sum(map(len, held[lang])) >= PIECE_CHARS:
                        yield counted(lang, held.pop(lang))
            for lang, texts in held.items():
                yield counted(lang, texts)

    rows = docs.select(F.col(label).alias("lang"), F.col(text).alias("text"))
    parts = rows.mapInArrow(run, "lang string, gram string, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class LanguageModels:
    languages: list[str]
    grams: dict[int, tuple[np.ndarray, np.ndarray]]
    weights: dict[int, tuple[np.ndarray, np.ndarray]]
    unseen: np.ndarray
    typical: np.ndarray
    allowed: np.ndarray

    def entropies(self, codes: np.ndarray) -> tuple[np.ndarray, int]:
        """Cross-entropy per character under each language, and the number of characters."""
        total = np.zeros(len(self.languages))
        for begin in range(0, len(codes) - ORDER + 1, PIECE_CHARS):
            piece = codes[begin : begin + PIECE_CHARS + ORDER - 1]
            left = np.arange(len(piece) - ORDER + 1)
            for order in range(ORDER, 0, -1):
                at = left + ORDER - order
                grams = hashes_of(piece, order)[at]
                row, found = _find(self.grams[order][0], grams)
                total += self.grams[order][1][row[found]].sum(0, dtype=np.float64)
                left = left[~found]
                if not len(left):
                    break
                if order > 1:
                    row, found = _find(self.weights[order][0], hashes_of(piece, order - 1)[left + ORDER - order])
                    total += self.weights[order][1][row[found]].sum(0, dtype=np.float64)
                else:
                    total += len(left) * self.unseen
        n = len(codes) - ORDER + 1
        return -total / n, n

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected)."""
        codes = codes_of(text)
        if not len(codes) or not self.languages:
            return UNKNOWN, 0.0, True
        entropy, n = self.entropies(codes)
        best = int(np.argmin(entropy))
        score = 1.0 / float(np.exp(-(entropy - entropy[best]) * min(n, SETTLED)).sum())
        excess = excess_of(entropy[best], self.typical[best], n)
        return self.languages[best], score, bool(excess > self.allowed[best])


def excess_of(entropy: float, typical: float, n: int) -> float:
    """How far an entropy is above the typical one, short texts being allowed more."""
    return (entropy - typical) * math.sqrt(min(n, SETTLED))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    row = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return row, keys[row] == wanted


def build_models(counts: pd.DataFrame) -> LanguageModels:
    """Models from (lang, gram, n) of the highest order; interpolated, with absolute discounts.

    Below the highest order an n-gram counts as often as there are different characters in front
    of it.
    """
    languages = sorted(counts["lang"].unique().tolist())
    levels: dict[str, dict[int, pd.Series]] = {}
    for lang, rows in counts.groupby("lang"):
        level = {ORDER: rows.groupby("gram")["n"].sum()}
        for order in range(ORDER - 1, 0, -1):
            level[order] = level[order + 1].index.to_series().str[1:].value_counts()
        levels[lang] = level
    every = {k: sorted(set().union(*(levels[lang][k].index for lang in languages))) for k in range(1, ORDER + 1)}
    alphabet = len(every[1]) + 1
    grams, weights = {}, {}
    below: dict[str, pd.Series] = {lang: pd.Series(dtype=float) for lang in languages}
    unseen = np.zeros(len(languages))
    for order in range(1, ORDER + 1):
        index = pd.Index(every[order])
        contexts = pd.Index(sorted({g[:-1] for g in every[order]}))
        logs, back = np.zeros((len(index), len(languages))), np.zeros((len(contexts), len(languages)))
        for column, lang in enumerate(languages):
            count = levels[lang][order]
            discount = _discount(count)
            of_context = count.groupby(count.index.str[:-1])
            total, kinds = of_context.sum(), of_context.size()
            weight = (discount * kinds / total).reindex(contexts)
            own = (count.reindex(index, fill_value=0) - discount).clip(lower=0).to_numpy()
            of_gram = index.str[:-1]
            sums = total.reindex(of_gram).to_numpy(float)
            known = ~np.isnan(sums)
            lower = np.full(len(index), 1.0 / alphabet) if order == 1 else below[lang].reindex(index.str[1:]).to_numpy(float)
            share = np.where(known, weight.reindex(of_gram).to_numpy(float), 1.0)
            value = np.where(known, own / np.where(known, sums, 1.0), 0.0) + share * lower
            below[lang] = pd.Series(value, index=index)
            logs[:, column] = np.log(value)
            back[:, column] = np.log(weight.fillna(1.0).to_numpy(float))
            if order == 1:
                unseen[column] = math.log(float(weight.iloc[0]) / alphabet)
        grams[order] = _sorted_rows(every[order], logs, order)
        if order > 1:
            weights[order] = _sorted_rows(list(contexts), back, order - 1)
    none = np.zeros(len(languages))
    return LanguageModels(languages, grams, weights, unseen, none, none)


def _discount(count: pd.Series) -> float:
    once, twice = int((count == 1).sum()), int((count == 2).sum())
    return once / (once + 2 * twice) if once else 0.5


def _sorted_rows(names: list[str], values: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    joined = np.concatenate([_codes_of_gram(n) for n in names])
    keys = hashes_of(joined, order)[::order]
    place = np.argsort(keys)
    return keys[place], values[place].astype(np.float32)


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> LanguageModels:
    """Models from labelled texts outside the held-out quarter; see TRAIN_DOCS for the bound.

    Null texts and labels teach nothing. Without labelled texts there are no languages; more than
    MOST_LANGUAGES raise. All n-grams of the sample are kept.
    """
    rows = docs.where(~is_held_out(F.col(key)) & F.col(label).isNotNull() & F.col(text).isNotNull())
    sizes = {row["lang"]: row["n"] for row in rows.groupBy(F.col(label).alias("lang")).agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sizes:
        return LanguageModels([], {}, {}, np.zeros(0), np.zeros(0), np.zeros(0))
    # A row's hash, spread evenly over 0 to 1, against the share of its language that is wanted.
    place = F.xxhash64(F.col(key), F.lit("langid")).cast("double") / 2.0**64 + 0.5
    limit = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, TRAIN_DOCS / n)])[F.col(label)]
    fifth = F.pmod(F.xxhash64(F.col(key), F.lit("calibrate")), F.lit(5)) == 0
    used = rows.where(place < limit).select(F.col(text).alias("text"), F.col(label).alias("lang"), fifth.alias("fifth"))
    counts = count_grams(used.where("NOT fifth"), "lang", "text")
    return _calibrated(build_models(counts.toPandas()), used.where("fifth"))


def _calibrated(models: LanguageModels, texts: DataFrame) -> LanguageModels:
    """Sets the excess that a text of each language is allowed.

    It lies half way between the largest excess of the language's own texts and what texts of
    the other languages have: those stand in for languages that were not learned.
    """
    shared = texts.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        for batch in batches:
            rows = []
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                codes = codes_of(text)
                if len(codes):
                    entropy, n = shared.value.entropies(codes)
                    rows += [(lang, model, float(e), n) for model, e in zip(shared.value.languages, entropy, strict=True)]
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            kinds = (pa.string(), pa.string(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "model", "entropy", "n"]
            )

    measured = texts.select("text", "lang").mapInArrow(run, "lang string, model string, entropy double, n long").toPandas()
    typical, allowed = np.zeros(len(models.languages)), np.full(len(models.languages), np.inf)
    for column, lang in enumerate(models.languages):
        by_model = measured[measured["model"] == lang]
        own, foreign = by_model[by_model["lang"] == lang], by_model[by_model["lang"] != lang]
        if not len(own):
            continue
        typical[column] = np.average(own["entropy"], weights=own["n"])
        excess = [[excess_of(e, typical[column], n) for e, n in zip(t["entropy"], t["n"], strict=True)] for t in (own, foreign)]
        most = max([*excess[0], 0.1])
        least = float(np.quantile(excess[1], 0.05)) if excess[1] else 0.0
        allowed[column] = (most + least) / 2 if least > most else SLACK * most
    models.typical, models.allowed = typical, allowed
    return models


def identify(docs: DataFrame, models: LanguageModels, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``rejected``, from the whole text alone.

    ``lang_pred`` is ``und``, rejected with score 0, for null texts and texts without a letter, and
    where no language was learned. Ties go to the language that sorts first. Otherwise a text is
    rejected where its entropy is far beyond that of labelled texts; its best language is still
    given. Columns of the new names are replaced, all other columns and all rows stay.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(models)

    @F.pandas_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def judge(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.judge(t) for t in texts], columns=["lang_pred", "score", "rejected"])

    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    return docs.select(*kept, judge(F.col(text)).alias("__judged")).select(*kept, "__judged.*")


@check()
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = identify(docs.select("doc_id", "text"), train(docs))
    return judged.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
