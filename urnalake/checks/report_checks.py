"""Rollups, report filters, orderings and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from urnalake import schema as S
from urnalake.checks import inputs as I
from urnalake.checks.registry import check
from urnalake.operators import rollups, selection
from urnalake.plans.reports import report_of

# Mean rates are compared at six decimals: the order of summation is not fixed.
_TOTALS = """CAST(sum(QT_COMPARECIMENTO) AS BIGINT) AS comparecimento_total,
  CAST(sum(QT_ABSTENCAO) AS BIGINT) AS abstencao_total"""
_MEAN = "round(avg(TAXA_COMPARECIMENTO_PCT), 6) AS taxa_comparecimento"

NATIONAL_SQL = f"SELECT Ano, {_TOTALS}, {_MEAN} FROM silver GROUP BY Ano"
REGIONAL_SQL = f"SELECT Ano, NOME_REGIAO, {_TOTALS}, {_MEAN} FROM silver GROUP BY Ano, NOME_REGIAO"
STATE_SQL = f"""SELECT Ano, SG_UF, {_MEAN}, NOME_REGIAO AS regiao
FROM silver WHERE SG_UF <> 'ZZ' GROUP BY Ano, SG_UF, NOME_REGIAO"""

ALL_YEARS = list(range(1995, 2002))


def rounded(df):
    return df.withColumn("taxa_comparecimento", F.round("taxa_comparecimento", 6))


def _national(spark, sf_dir, empty_cells=False):
    return rounded(rollups.national_by_year(I.silver(spark, sf_dir, empty_cells)))


def _regional(spark, sf_dir):
    return rounded(rollups.regional_by_year(I.silver(spark, sf_dir)))


def _states(spark, sf_dir):
    return rounded(rollups.state_by_year(I.silver(spark, sf_dir)))


def _list(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


@check(I.with_silver(NATIONAL_SQL))
def national_by_year(spark, sf_dir):
    return _national(spark, sf_dir)


@check(I.with_silver(NATIONAL_SQL, empty_cells=True))
def national_nan_edge(spark, sf_dir):
    """One NaN rate makes the year's mean NaN."""
    return _national(spark, sf_dir, empty_cells=True)


@check(I.with_silver(REGIONAL_SQL))
def regional_by_year(spark, sf_dir):
    return _regional(spark, sf_dir)


@check(I.with_silver(STATE_SQL))
def state_by_year(spark, sf_dir):
    return _states(spark, sf_dir)


FUSED_SQL = f"""SELECT CASE WHEN grouping(SG_UF) = 0 THEN 'state'
       WHEN grouping(NOME_REGIAO) = 0 THEN 'regional' ELSE 'national' END AS level,
  Ano, NOME_REGIAO, SG_UF, {_TOTALS}, {_MEAN}
FROM silver GROUP BY GROUPING SETS ((Ano), (Ano, NOME_REGIAO), (Ano, SG_UF))
HAVING grouping(SG_UF) = 1 OR SG_UF <> 'ZZ'"""


@check(I.with_silver(FUSED_SQL))
def rollups_fused(spark, sf_dir):
    return rounded(rollups.rollups_fused(I.silver(spark, sf_dir)))


@check(I.with_silver(FUSED_SQL, empty_cells=True))
def rollups_fused_nan_edge(spark, sf_dir):
    return rounded(rollups.rollups_fused(I.silver(spark, sf_dir, empty_cells=True)))


@check(
    I.with_silver(
        """SELECT ANO_ELEICAO, round(avg(TAXA_COMPARECIMENTO_PCT), 2) AS taxa_comparecimento_medio,
  round(avg(TAXA_ABSTENCAO_PCT), 2) AS taxa_abstencao_medio
FROM silver GROUP BY ANO_ELEICAO ORDER BY ANO_ELEICAO DESC"""
    )
)
def doc_rates_by_year(spark, sf_dir):
    return rollups.rates_by_year(I.silver(spark, sf_dir))


@check(
    I.with_silver(
        """SELECT NOME_REGIAO, count(*) AS n_rows, round(avg(QT_COMPARECIMENTO), 0) AS comparecimento_medio,
  round(avg(TAXA_COMPARECIMENTO_PCT), 2) AS taxa_comparecimento_pct
FROM silver GROUP BY NOME_REGIAO ORDER BY taxa_comparecimento_pct DESC, NOME_REGIAO"""
    )
)
def doc_by_region(spark, sf_dir):
    return rollups.by_region(I.silver(spark, sf_dir))


@check(
    I.with_silver(
        """SELECT NOME_REGIAO, count(*) AS n_rows, count(DISTINCT CD_MUNICIPIO) AS n_municipios
FROM silver GROUP BY NOME_REGIAO"""
    )
)
def municipalities_by_region(spark, sf_dir):
    return rollups.municipalities_by_region(I.silver(spark, sf_dir))


@check(I.with_silver("SELECT * FROM silver WHERE Ano IN (1996, 2000)"))
def multi_year_scan(spark, sf_dir):
    rows = I.silver(spark, sf_dir).drop("Ano")
    return rollups.tag_year(rows, [1996, 2000, 2024], year="ANO_ELEICAO")


@check(I.with_silver(f"SELECT * FROM ({NATIONAL_SQL}) WHERE Ano IN (1996, 1998)"))
def filter_years(spark, sf_dir):
    return selection.choose_years(_national(spark, sf_dir), [1996, 1998])


@check(I.with_silver(f"SELECT * FROM ({NATIONAL_SQL}) WHERE 1 = 0"))
def filter_no_years(spark, sf_dir):
    """An empty selection gives an empty report."""
    return selection.choose_years(_national(spark, sf_dir), [])


@check(
    I.with_silver(
        f"SELECT * FROM ({REGIONAL_SQL}) WHERE NOME_REGIAO IN ({_list(S.REPORT_REGIONS)})"
    )
)
def filter_regions_default(spark, sf_dir):
    return selection.choose_regions(_regional(spark, sf_dir))


@check(I.with_silver(f"SELECT * FROM ({REGIONAL_SQL}) WHERE NOME_REGIAO IN ('Sul', 'Exterior')"))
def filter_regions(spark, sf_dir):
    return selection.choose_regions(_regional(spark, sf_dir), ["Sul", "Exterior"])


_MAP_SQL = f"SELECT * FROM ({STATE_SQL}) WHERE regiao IN ({_list(S.REPORT_REGIONS)})"


@check(I.with_silver(f"{_MAP_SQL} AND Ano = 1998"))
def map_year(spark, sf_dir):
    return selection.map_slice(_states(spark, sf_dir), ALL_YEARS, map_year=1998)


@check(I.with_silver(f"{_MAP_SQL} AND Ano = 2001"))
def map_year_default(spark, sf_dir):
    return selection.map_slice(_states(spark, sf_dir), ALL_YEARS)


@check(
    I.with_silver(
        f"""SELECT min(taxa_comparecimento) AS rate_min, max(taxa_comparecimento) AS rate_max
FROM ({_MAP_SQL} AND Ano = 1998)"""
    )
)
def colour_range(spark, sf_dir):
    return selection.colour_range(selection.map_slice(_states(spark, sf_dir), [1998]))


@check(I.with_silver(f"SELECT * FROM ({NATIONAL_SQL}) WHERE Ano = 2000"))
def kpi_latest(spark, sf_dir):
    return selection.latest_figures(_national(spark, sf_dir), [1998, 2000, 1996])


@check(I.with_silver(f"SELECT * FROM ({NATIONAL_SQL}) WHERE Ano = 2024"))
def kpi_absent_year(spark, sf_dir):
    """The latest year asked for counts, even when it has no data."""
    return selection.latest_figures(_national(spark, sf_dir), [1998, 2024])


@check(
    I.with_silver(
        f"""SELECT Ano, format('{{:.1f}}%', taxa_comparecimento) AS rate_text,
  format('{{:,}}', comparecimento_total) AS turnout_text, format('{{:,}}', abstencao_total) AS abstention_text
FROM ({NATIONAL_SQL}) WHERE Ano = 2000"""
    )
)
def kpi_text(spark, sf_dir):
    return selection.latest_figures_text(_national(spark, sf_dir), ALL_YEARS[:-1])


@check(
    I.with_silver(
        f"""SELECT CAST(Ano AS VARCHAR) AS Ano, comparecimento_total, abstencao_total, taxa_comparecimento
FROM ({NATIONAL_SQL}) ORDER BY Ano"""
    )
)
def trend_sorted(spark, sf_dir):
    return selection.national_trend(_national(spark, sf_dir))


@check(I.with_silver(f"SELECT * FROM ({REGIONAL_SQL}) ORDER BY NOME_REGIAO, Ano"))
def regional_sorted(spark, sf_dir):
    return selection.regional_evolution(_regional(spark, sf_dir))


_NAMES = ", ".join(f"('{uf}', '{name}')" for uf, name in S.STATE_NAME_BY_UF.items())


@check(
    I.with_silver(
        f"""SELECT s.*, n.nome AS nome_estado FROM ({STATE_SQL}) s
LEFT JOIN (VALUES {_NAMES}) AS n(uf, nome) ON s.SG_UF = n.uf"""
    )
)
def state_names(spark, sf_dir):
    return rollups.with_state_name(_states(spark, sf_dir))


@check(
    I.with_silver(
        f"""SELECT *, CASE WHEN NOME_REGIAO = 'Exterior' THEN 'Internacional' ELSE 'Nacional' END AS tipo
FROM ({REGIONAL_SQL})"""
    )
)
def row_type(spark, sf_dir):
    return selection.with_row_type(_regional(spark, sf_dir))


_LABELS = """comparecimento_total AS "Total de Comparecimentos",
  abstencao_total AS "Total de Abstenções", taxa_comparecimento AS "Taxa de Comparecimento (%)\""""


@check(I.with_silver(f"""SELECT CAST(Ano AS BIGINT) AS "Ano", {_LABELS}, 'Nacional' AS "Tipo" FROM ({NATIONAL_SQL})"""))
def labels_national(spark, sf_dir):
    return selection.labelled(selection.with_row_type(_national(spark, sf_dir)))


@check(
    I.with_silver(
        f"""SELECT CAST(Ano AS BIGINT) AS "Ano", NOME_REGIAO AS "Região", {_LABELS},
  CASE WHEN NOME_REGIAO = 'Exterior' THEN 'Internacional' ELSE 'Nacional' END AS "Tipo"
FROM ({REGIONAL_SQL})"""
    )
)
def labels_regional(spark, sf_dir):
    return selection.labelled(selection.with_row_type(_regional(spark, sf_dir)))


@check(
    I.with_silver(
        f"""SELECT CAST(Ano AS BIGINT) AS "Ano", SG_UF AS "Estado (UF)", regiao,
  taxa_comparecimento AS "Taxa de Comparecimento (%)" FROM ({STATE_SQL})"""
    )
)
def labels_state(spark, sf_dir):
    return selection.labelled(_states(spark, sf_dir))


@check(
    I.with_silver(
        f"""SELECT Ano, SG_UF, taxa_comparecimento, regiao, n.nome AS nome_estado
FROM ({_MAP_SQL} AND Ano = 2000 AND regiao IN ('Norte', 'Sudeste')) s
LEFT JOIN (VALUES {_NAMES}) AS n(uf, nome) ON s.SG_UF = n.uf"""
    )
)
def report_map(spark, sf_dir):
    """The map of a whole report, whose parts share one scan."""
    shown = report_of(I.silver(spark, sf_dir), [1998, 2000], regions=("Norte", "Sudeste"))
    return rounded(shown.map())
