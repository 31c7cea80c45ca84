"""Turnout by year, by region and by state.

Group keys are few (years x 28 codes), so partial aggregation leaves each task a handful
of rows and the shuffle stays small however skewed the input is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urnalake import schema as S
from urnalake.functions.places import region_of, state_name_of

NATIONAL, REGIONAL, STATE = "national", "regional", "state"


def tag_year(df: DataFrame, years: list[int], year: str = "year") -> DataFrame:
    """Rows of the requested years with the report's ``Ano`` column (prunes partitions)."""
    return df.where(F.col(year).isin(years)).withColumn("Ano", F.col(year).cast("int"))


def _totals() -> list[Column]:
    return [
        F.sum("QT_COMPARECIMENTO").alias("comparecimento_total"),
        F.sum("QT_ABSTENCAO").alias("abstencao_total"),
    ]


def _mean_rate() -> Column:
    # Mean of the row rates, deliberately not weighted by the electorate.
    return F.avg(S.RATE_TURNOUT).alias("taxa_comparecimento")


def not_overseas() -> Column:
    return F.col("SG_UF") != S.OVERSEAS_UF


def national_by_year(silver: DataFrame) -> DataFrame:
    return silver.groupBy("Ano").agg(*_totals(), _mean_rate())


def regional_by_year(silver: DataFrame) -> DataFrame:
    return silver.groupBy("Ano", S.REGION).agg(*_totals(), _mean_rate())


def state_by_year(silver: DataFrame) -> DataFrame:
    """Mean rate per state without overseas votes; the region is added to the few result rows."""
    states = silver.where(not_overseas()).groupBy("Ano", "SG_UF").agg(_mean_rate())
    return states.withColumn("regiao", region_of("SG_UF"))


def with_state_name(states: DataFrame) -> DataFrame:
    return states.withColumn("nome_estado", state_name_of("SG_UF"))


def rollup_cells(silver: DataFrame) -> DataFrame:
    """Additive measures per (Ano, region, state): the one pass all three rollups share."""
    return silver.groupBy("Ano", S.REGION, "SG_UF").agg(
        *_totals(),
        F.sum(S.RATE_TURNOUT).alias("rate_sum"),
        F.count(S.RATE_TURNOUT).alias("rate_count"),
    )


def rollups_fused(silver: DataFrame) -> DataFrame:
    """National, regional and state rollups in one scan, told apart by ``level``.

    Grouping sets straight over silver would expand every row three times; here they run
    over the cells, of which there is at most one per year and state code.
    """
    mean = F.try_divide(F.sum("rate_sum"), F.sum("rate_count"))
    return _rollups_over(rollup_cells(silver), mean)


def _rollups_over(cells: DataFrame, mean: Column) -> DataFrame:
    year, region, uf = F.col("Ano"), F.col(S.REGION), F.col("SG_UF")
    level = (
        F.when(F.grouping("SG_UF") == 0, STATE).when(F.grouping(S.REGION) == 0, REGIONAL).otherwise(NATIONAL)
    )
    fused = cells.groupingSets([[year], [year, region], [year, uf]], year, region, uf).agg(
        level.alias("level"),
        F.sum("comparecimento_total").alias("comparecimento_total"),
        F.sum("abstencao_total").alias("abstencao_total"),
        mean.alias("taxa_comparecimento"),
    )
    return fused.where((F.col("level") != STATE) | not_overseas())


def stored_cells(silver: DataFrame) -> DataFrame:
    """Cells that can be kept and merged later: ``CELL_SCHEMA`` and ``Ano``.

    NaN and infinite rates are counted apart, so ``rate_sum`` is finite and adding up cells in any
    order and any grouping tells the same mean as the rows do.
    """
    rate = F.col(S.RATE_TURNOUT)
    infinity = F.lit(float("inf"))
    nan, above, below = F.isnan(rate), rate == infinity, rate == -infinity
    return silver.groupBy("Ano", S.REGION, "SG_UF").agg(
        *_totals(),
        F.coalesce(F.sum(F.when(~(nan | above | below), rate)), F.lit(0.0)).alias("rate_sum"),
        F.count(rate).alias("rate_count"),
        F.count_if(nan).alias("rate_nan"),
        F.count_if(above).alias("rate_infinite"),
        F.count_if(below).alias("rate_negative_infinite"),
    )


def rollups_of_cells(cells: DataFrame) -> DataFrame:
    """What :func:`rollups_fused` gives for the rows that the stored cells were made of."""
    nan, above, below = (F.sum(c) > 0 for c in ("rate_nan", "rate_infinite", "rate_negative_infinite"))
    infinity = F.lit(float("inf"))
    mean = (
        F.when(nan | (above & below), F.lit(float("nan")))
        .when(above, infinity)
        .when(below, -infinity)
        .otherwise(F.try_divide(F.sum("rate_sum"), F.sum("rate_count")))
    )
    return _rollups_over(cells, mean)


def level_of(fused: DataFrame, level: str) -> DataFrame:
    """One of the three rollups back out of the fused form, with that rollup's columns."""
    rows = fused.where(F.col("level") == level)
    if level == NATIONAL:
        return rows.select("Ano", "comparecimento_total", "abstencao_total", "taxa_comparecimento")
    if level == REGIONAL:
        return rows.select("Ano", S.REGION, "comparecimento_total", "abstencao_total", "taxa_comparecimento")
    return rows.select("Ano", "SG_UF", "taxa_comparecimento", region_of("SG_UF").alias("regiao"))


RATES_BY_YEAR_SQL = """
SELECT ANO_ELEICAO,
       round(avg(TAXA_COMPARECIMENTO_PCT), 2) AS taxa_comparecimento_medio,
       round(avg(TAXA_ABSTENCAO_PCT), 2) AS taxa_abstencao_medio
FROM {silver}
GROUP BY ANO_ELEICAO
ORDER BY ANO_ELEICAO DESC
"""

BY_REGION_SQL = """
SELECT NOME_REGIAO,
       count(*) AS n_rows,
       round(avg(QT_COMPARECIMENTO), 0) AS comparecimento_medio,
       round(avg(TAXA_COMPARECIMENTO_PCT), 2) AS taxa_comparecimento_pct
FROM {silver}
GROUP BY NOME_REGIAO
ORDER BY taxa_comparecimento_pct DESC, NOME_REGIAO
"""


def rates_by_year(silver: DataFrame) -> DataFrame:
    return silver.sparkSession.sql(RATES_BY_YEAR_SQL, silver=silver)


def by_region(silver: DataFrame) -> DataFrame:
    return silver.sparkSession.sql(BY_REGION_SQL, silver=silver)


def municipalities_by_region(silver: DataFrame) -> DataFrame:
    """Distinct municipalities beside the row count, which counts voter-profile cells.

    The inner grouping collapses repeated cells on the map side, so a municipality that
    holds much of the data does not make one task heavy.
    """
    cells = silver.groupBy(S.REGION, "CD_MUNICIPIO").agg(F.count(F.lit(1)).alias("n"))
    return cells.groupBy(S.REGION).agg(
        F.sum("n").alias("n_rows"), F.count("CD_MUNICIPIO").alias("n_municipios")
    )
