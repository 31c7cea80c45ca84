"""Report filters, the latest-year figures, orderings and labels."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urnalake import schema as S
from urnalake.functions.places import row_type_of
from urnalake.functions.text import grouped_text, percent_text


def choose_years(df: DataFrame, years: Iterable[int]) -> DataFrame:
    return df.where(F.col("Ano").isin(list(years)))


def choose_regions(
    df: DataFrame, regions: Iterable[str] = S.REPORT_REGIONS, column: str = S.REGION
) -> DataFrame:
    """The default list leaves ``Desconhecido`` out, as the report's own filter does."""
    return df.where(F.col(column).isin(list(regions)))


def map_slice(
    states: DataFrame,
    selected_years: Sequence[int],
    map_year: int | None = None,
    regions: Iterable[str] = S.REPORT_REGIONS,
) -> DataFrame:
    """State rates of one year, by default the last year of the selection."""
    if map_year is None:
        map_year = selected_years[-1] if selected_years else None
    one_year = states.where(F.lit(False) if map_year is None else F.col("Ano") == map_year)
    return choose_regions(one_year, regions, "regiao")


def colour_range(states: DataFrame) -> DataFrame:
    return states.agg(
        F.min("taxa_comparecimento").alias("rate_min"), F.max("taxa_comparecimento").alias("rate_max")
    )


def latest_figures(national: DataFrame, selected_years: Sequence[int]) -> DataFrame:
    """The row of the highest year asked for; no row when that year has no data."""
    if not selected_years:
        return national.where(F.lit(False))
    return national.where(F.col("Ano") == max(selected_years))


def latest_figures_text(national: DataFrame, selected_years: Sequence[int]) -> DataFrame:
    return latest_figures(national, selected_years).select(
        "Ano",
        percent_text("taxa_comparecimento").alias("rate_text"),
        grouped_text("comparecimento_total").alias("turnout_text"),
        grouped_text("abstencao_total").alias("abstention_text"),
    )


def national_trend(national: DataFrame) -> DataFrame:
    """Years in order, as text so that the axis is categorical."""
    return national.orderBy("Ano").withColumn("Ano", F.col("Ano").cast("string"))


def regional_evolution(regional: DataFrame) -> DataFrame:
    return regional.orderBy(S.REGION, "Ano")


def with_row_type(df: DataFrame) -> DataFrame:
    """``Internacional`` for the overseas region; national tables are all ``Nacional``."""
    if S.REGION in df.columns:
        return df.withColumn("tipo", row_type_of(S.REGION))
    return df.withColumn("tipo", F.lit(S.NATIONAL_ROW))


def labelled(df: DataFrame) -> DataFrame:
    """Report labels for the columns, ``Ano`` as a 64-bit integer."""
    return df.withColumn("Ano", F.col("Ano").cast("long")).withColumnsRenamed(S.REPORT_LABELS)
