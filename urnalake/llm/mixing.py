"""Mixing sources to target weights by iterative proportional fitting.

Token counts per (source, language, topic) cell are raked until their sums along each of the
three meet the target shares. A document is then kept with its cell's ratio of raked to present
tokens, scaled so that the largest ratio is 1: no probability is cut off, so the expected tokens
of what is kept have the target shares.
"""

from __future__ import annotations

import functools
import warnings

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urnalake.checks.registry import check
from urnalake.llm.common import table, written

MARGINS = ("source", "lang", "topic")
#: Targets of the registered query and the pipeline: shares to this power, so that small sources,
#: languages and topics gain.
TEMPERS = {"source": 0.7, "lang": 0.8, "topic": 0.9}
#: Raking has converged when every marginal is this close to its target, relatively.
TOLERANCE = 1e-4
MOST_ROUNDS = 50
#: Rounds in a row that leave more than this part of the least deviation, before raking ends.
GAIN, PATIENCE = 0.999, 4
SEED = 20

_NEW = ("n_tokens", "topic", "probability", "kept", "deviation")

_WORD = r"[^\x20\x09-\x0D]+"


def tokens_of(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(_WORD)).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse topic from the whole text: notices, contact data, sign-laden text or prose."""
    text = F.coalesce(text, F.lit(""))
    signs = F.char_length(text) - F.char_length(F.translate(text, "$%&*#{}<>|", ""))
    return (
        F.when(text.rlike(r"(?i)licen[cs]ed? |all rights reserved|copyright"), F.lit("notice"))
        .when(text.rlike(r"[A-Za-z0-9_.]@[A-Za-z0-9-]+\.[a-z]|\d{3}[- ]\d{3}"), F.lit("contact"))
        .when(signs * 20 > F.char_length(text), F.lit("signs"))
        .otherwise(F.lit("prose"))
    )


def _category(column: Column) -> Column:
    """A value as text; null is a category too."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("null"))


def tempered_targets(cells: DataFrame, tempers: dict[str, float]) -> dict[str, DataFrame]:
    """Per marginal (value, share): the present shares to a power, as shares again."""
    targets = {}
    for name, power in tempers.items():
        sums = cells.groupBy(F.col(name).alias("value")).agg(F.sum("tokens").alias("n")).where("n > 0")
        targets[name] = sums.select("value", F.pow(F.col("n").cast("double"), F.lit(power)).alias("share"))
    return targets


def rake(cells: DataFrame, targets: dict[str, DataFrame], purpose: str = "mixing", most_rounds: int = MOST_ROUNDS) -> tuple[DataFrame, float]:
    """(``cells`` (marginals, tokens) with raked ``weight``, how far the worst marginal is off).

    Weights sum to 1. Targets are (value, share) per marginal and need not sum to 1. Values without
    a target get weight 0; targets without cells are left out of the sum. Each round fits one
    marginal after the other and is a written table; the number of cells does not grow with the
    documents. Targets that contradict each other or the empty cells cannot all be met: then the
    rounds end when PATIENCE of them bring no gain, or after ``most_rounds``, and the deviation, relative to
    the target, says what is left. It is TOLERANCE at most where raking has converged.
    """
    names = list(targets)
    weighted = cells.withColumn("weight", F.col("tokens").cast("double"))
    wanted = {}
    for name, target in targets.items():
        present = cells.where("tokens > 0").select(F.col(name).alias("value")).distinct()
        rows = target.groupBy("value").agg(F.sum("share").alias("share")).join(present, "value").where("share > 0")
        total = rows.agg(F.sum("share")).first()[0] or 1.0
        wanted[name] = written(rows.select("value", (F.col("share") / total).alias("share")), purpose)
    current, off, least, idle = written(weighted, purpose), float("inf"), float("inf"), 0
    for _ in range(most_rounds):
        for name in names:
            target = wanted[name].select(F.col("value").alias(name), F.col("share").alias("__share"))
            fitted = F.col("weight") * F.col("__share") / F.sum("weight").over(Window.partitionBy(name))
            current = current.join(target, name, "left").withColumn(
                "weight", F.when(F.col("weight") > 0, F.coalesce(fitted, F.lit(0.0))).otherwise(0.0)
            ).drop("__share")
        current = written(current.select(*cells.columns, "weight"), purpose)
        off = _largest_deviation(current, wanted)
        idle = idle + 1 if off > least * GAIN else 0
        least = min(least, off)
        if off <= TOLERANCE or idle == PATIENCE:
            break
    if TOLERANCE < off < float("inf"):
        warnings.warn(f"raking has not converged: a marginal is off by {off:.3g} of its target", stacklevel=2)
    return current, off


def _largest_deviation(current: DataFrame, wanted: dict[str, DataFrame]) -> float:
    parts = []
    for name, target in wanted.items():
        sums = current.groupBy(F.col(name).alias("value")).agg(F.sum("weight").alias("sum"))
        parts.append(target.join(sums, "value").select(F.max(F.abs(F.col("sum") / F.col("share") - 1)).alias("d")))
    every = functools.reduce(DataFrame.unionByName, parts)
    return every.agg(F.max("d")).first()[0] or 0.0


def featured(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
    topic: str | None = None, seed: int = SEED,
) -> DataFrame:
    """``docs`` with ``n_tokens``, ``topic`` and what :func:`sampled` needs; texts are read here only.

    ``topic`` names a column to take topics from; without one they are :func:`topic_of` the texts.
    """
    kept = [c for c in docs.columns if c not in _NEW]
    draw = F.xxhash64(F.col(key), F.col(text), F.lit(seed)).cast("double") / 2.0**64 + 0.5
    subject = F.col(topic) if topic else topic_of(F.col(text))
    return docs.select(
        *kept, tokens_of(F.col(text)).alias("n_tokens"), subject.alias("topic"), _category(F.col(source)).alias("__source"),
        _category(F.col(lang)).alias("__lang"), _category(subject).alias("__topic"), draw.alias("__draw"),
    )


def sampled(rows: DataFrame, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """Rows of :func:`featured` with ``probability``, ``kept`` and ``deviation``."""
    rows = written(rows, "mixing-rows")
    own = {name: f"__{name}" for name in MARGINS}
    cells = rows.groupBy(*(F.col(own[n]).alias(n) for n in MARGINS)).agg(F.sum("n_tokens").alias("tokens"))
    cells = written(cells, "mixing-cells")
    raked, off = rake(cells, targets or tempered_targets(cells, TEMPERS))
    rated = raked.withColumn("ratio", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")))
    most = rated.agg(F.max("ratio")).first()[0] or 1.0
    chances = rated.select(*(F.col(n).alias(own[n]) for n in MARGINS), (F.col("ratio") / most).alias("probability"))
    chance = F.when(F.col("n_tokens") == 0, F.lit(1.0)).otherwise(F.coalesce("probability", F.lit(0.0)))
    return (
        rows.join(chances, list(own.values()), "left")
        .withColumn("probability", chance)
        .withColumn("kept", F.col("__draw") < F.col("probability"))
        .withColumn("deviation", F.lit(off))
        .drop("__draw", *own.values())
    )


def mixed(docs: DataFrame, targets: dict[str, DataFrame] | None = None, **names) -> DataFrame:
    """``docs`` with ``n_tokens``, ``topic``, ``probability``, ``kept`` and ``deviation``.

    ``targets`` has (value, share) tables for "source", "lang" and "topic", values as strings
    with "=" in front ("null" for null); by default shares tempered by TEMPERS. ``deviation`` is
    how far the worst marginal is off its target, relatively (see :func:`rake`). ``names`` go to
    :func:`featured`. Documents without tokens weigh nothing and are kept. Whether a document is
    kept follows from its id and text and the seed alone, so repeated rows are kept or dropped
    together. Columns of the new names are replaced; other columns and all rows stay; an empty
    table gives no rows.
    """
    kept = [c for c in docs.columns if c not in _NEW]
    return sampled(featured(docs, **names), targets).select(*kept, *_NEW)


@check()
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return sampled(featured(docs).drop("text"))
