"""Audit views and work planning over an append-only log.

Parquet has no MERGE, so an upsert is an append and readers take the latest row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urnalake import schema as S
from urnalake.operators.union import unite

KEY = ("dataset", "ano")


def latest(log: DataFrame) -> DataFrame:
    """The current row of each (dataset, ano): last end time, run id as tie-break.

    Only the first row per key is kept, which Spark applies before the shuffle as well, so
    a key with very many runs does not gather in one task.
    """
    newest = Window.partitionBy(*KEY).orderBy(F.desc("timestamp_fim"), F.desc("run_id"))
    return log.withColumn("__n", F.row_number().over(newest)).where("__n = 1").drop("__n")


def lookup(log: DataFrame, dataset: str, year: int) -> DataFrame:
    """Zero or one row."""
    return latest(log.where((F.col("dataset") == dataset) & (F.col("ano") == year)))


def listing(log: DataFrame) -> DataFrame:
    return latest(log).orderBy(F.desc("ano"), "dataset")


def evolve(log: DataFrame, newer: DataFrame) -> DataFrame:
    """Rows of both logs with the columns of both; the ones a log lacks are NULL, types are widened."""
    return unite([log, newer])


def with_duration(df: DataFrame) -> DataFrame:
    start, end = F.col("timestamp_inicio").cast("timestamp"), F.col("timestamp_fim").cast("timestamp")
    micros = F.unix_micros(end) - F.unix_micros(start)
    return df.withColumn("duracao_segundos", micros / F.lit(1_000_000.0))


def successes(log: DataFrame) -> DataFrame:
    return latest(log).where(F.col("status") == S.STATUS_OK).select(*KEY)


def loads(log: DataFrame) -> DataFrame:
    """Runs that load a whole year; batches of the stream add to one and finish none."""
    return log.where(F.col("carga").isNull()) if "carga" in log.columns else log


def pending_bronze(manifest: DataFrame, log: DataFrame) -> DataFrame:
    """Manifest rows (dataset, ano, …) whose latest load is not a success, whatever batches were added."""
    return manifest.join(successes(loads(log)), list(KEY), "left_anti")


def pending_silver(
    manifest: DataFrame,
    log: DataFrame,
    silver_years: DataFrame,
    bronze_years: DataFrame,
    bronze_log: DataFrame | None = None,
) -> DataFrame:
    """Manifest rows to build: bronze is there, and not (succeeded before and output still there).

    With ``bronze_log``, a year is built again if a load or batch succeeded after its build began.
    """
    finished = successes(log).join(silver_years, "ano", "left_semi")
    if bronze_log is not None:
        changed = bronze_log.where(F.col("status") == S.STATUS_OK).groupBy("ano").agg(F.max("timestamp_fim").alias("__changed"))
        began = latest(log).select(*KEY, "timestamp_inicio").join(changed, "ano")
        stale = began.where(F.col("__changed") > F.col("timestamp_inicio"))
        finished = finished.join(stale, list(KEY), "left_anti")
    return manifest.join(bronze_years, "ano", "left_semi").join(finished, list(KEY), "left_anti")


def missing_years(requested: DataFrame, present: DataFrame) -> DataFrame:
    """Requested years that have no data."""
    return requested.join(present, "ano", "left_anti")
