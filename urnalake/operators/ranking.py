"""Top rows and exact repeatable samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urnalake import schema as S
from urnalake.functions.casting import quoted
from urnalake.functions.text import sample_key

TOP_COLUMNS = ("NM_MUNICIPIO", "SG_UF", "QT_COMPARECIMENTO", "QT_APTOS")


def top_by_turnout(bronze: DataFrame, n: int = 10) -> DataFrame:
    """The n rows with the highest turnout; every shown column breaks ties."""
    return (
        bronze.select(*TOP_COLUMNS)
        .orderBy(
            F.desc("QT_COMPARECIMENTO"),
            F.asc_nulls_last("NM_MUNICIPIO"),
            F.asc_nulls_last("SG_UF"),
            F.desc("QT_APTOS"),
        )
        .limit(n)
    )


_SLICES = 1000


def exact_sample(
    df: DataFrame,
    n: int = S.SAMPLE_ROWS,
    seed: int = S.SAMPLE_SEED,
    hash_columns: list[str] | None = None,
) -> DataFrame:
    """Exactly n rows of each year ``Ano`` (all rows of smaller years), the same on every run.

    Ranking by a content hash makes this a top-n per year, and the input is read once. Spark
    keeps at most n rows per year and map task before a shuffle (for n up to the group-limit
    threshold of the session); as the tasks may be very many, they are merged in slices of tasks
    first, so the last step ranks at most n rows per slice however large a year is. Rows that
    tie are identical, so the slices do not influence the result. Rows without a year are a
    group like any year.
    """
    columns = hash_columns or df.columns
    keyed = df.withColumn("__key", sample_key(columns, seed))
    ranked = keyed.withColumn("__slice", F.pmod(F.spark_partition_id(), F.lit(_SLICES)))
    order = [F.col("__key")] + [F.asc_nulls_first(quoted(c)) for c in columns]
    for group in (["Ano", "__slice"], ["Ano"]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        ranked = ranked.withColumn("__n", rank).where(F.col("__n") <= n).drop("__n")
    return ranked.select(*[quoted(c) for c in df.columns])
