import math

import pytest

from urnalake import schema as S
from urnalake.operators import rollups, selection
from urnalake.plans.reports import report_of

DDL = (
    "Ano int, SG_UF string, NOME_REGIAO string, QT_COMPARECIMENTO long, QT_ABSTENCAO long,"
    " TAXA_COMPARECIMENTO_PCT double"
)
ROWS = [
    (2022, "SP", "Sudeste", 1000, 100, 90.9),
    (2022, "RJ", "Sudeste", 800, 200, 80.0),
    (2022, "MG", "Sudeste", 600, 150, 80.0),
]
OTHER_PLACES = [(2022, "ZZ", "Exterior", 10, 90, 10.0), (2022, "XX", "Desconhecido", 30, 70, 30.0)]


@pytest.fixture(scope="module")
def silver(spark):
    return spark.createDataFrame(ROWS, DDL)


@pytest.fixture(scope="module")
def places(spark):
    older = [(2020, *row[1:]) for row in ROWS]
    return spark.createDataFrame(ROWS + OTHER_PLACES + older, DDL)


def test_national(silver):
    row = rollups.national_by_year(silver).first()
    assert (row["comparecimento_total"], row["abstencao_total"]) == (2400, 450)
    assert row["taxa_comparecimento"] == pytest.approx(83.6333, abs=1e-3)


def test_regional_and_state(silver):
    regional = rollups.regional_by_year(silver).collect()
    assert [(r["NOME_REGIAO"], r["comparecimento_total"]) for r in regional] == [("Sudeste", 2400)]
    states = {r["SG_UF"]: (r["taxa_comparecimento"], r["regiao"]) for r in rollups.state_by_year(silver).collect()}
    assert states == {"SP": (90.9, "Sudeste"), "RJ": (80.0, "Sudeste"), "MG": (80.0, "Sudeste")}


def test_overseas_counts_everywhere_but_in_the_states(places):
    national = {r["Ano"]: r["comparecimento_total"] for r in rollups.national_by_year(places).collect()}
    assert national == {2022: 2440, 2020: 2400}
    regions = {r["NOME_REGIAO"] for r in rollups.regional_by_year(places).collect()}
    assert regions == {"Sudeste", "Exterior", "Desconhecido"}
    states = {r["SG_UF"] for r in rollups.state_by_year(places).collect()}
    assert states == {"SP", "RJ", "MG", "XX"}


def test_default_regions_leave_unknown_out(places):
    regional = selection.choose_regions(rollups.regional_by_year(places))
    assert {r["NOME_REGIAO"] for r in regional.collect()} == {"Sudeste", "Exterior"}


def _close(left, right):
    left, right = sorted(map(tuple, left), key=str), sorted(map(tuple, right), key=str)
    assert len(left) == len(right)
    for a, b in zip(left, right, strict=True):
        assert a == pytest.approx(b)


def test_fused_equals_separate(places):
    fused = rollups.rollups_fused(places)
    for level, single in [
        (rollups.NATIONAL, rollups.national_by_year),
        (rollups.REGIONAL, rollups.regional_by_year),
        (rollups.STATE, rollups.state_by_year),
    ]:
        part, whole = rollups.level_of(fused, level), single(places)
        assert part.columns == whole.columns
        _close(part.collect(), whole.collect())


def test_nan_and_infinity_reach_the_mean(spark):
    rows = [
        (2020, "SP", "Sudeste", 1, 1, 50.0), (2020, "RJ", "Sudeste", 0, 0, math.nan),
        (2022, "SP", "Sudeste", 1, 1, 50.0), (2022, "RJ", "Sudeste", 5, 0, math.inf),
    ]
    df = spark.createDataFrame(rows, DDL)
    for result in (rollups.national_by_year(df), rollups.level_of(rollups.rollups_fused(df), "national")):
        rates = {r["Ano"]: r["taxa_comparecimento"] for r in result.collect()}
        assert math.isnan(rates[2020]) and rates[2022] == math.inf


def test_latest_figures_use_the_year_asked_for(places):
    national = rollups.national_by_year(places)
    assert selection.latest_figures(national, [2020, 2022]).first()["Ano"] == 2022
    assert selection.latest_figures(national, [2022, 2020]).first()["Ano"] == 2022
    assert selection.latest_figures(national, [2020, 2024]).count() == 0
    assert selection.latest_figures(national, []).count() == 0


def test_latest_figures_text(silver):
    row = selection.latest_figures_text(rollups.national_by_year(silver), [2022]).first()
    assert row == (2022, "83.6%", "2,400", "450")


def test_empty_selection_is_empty(places):
    national = rollups.national_by_year(places)
    assert selection.choose_years(national, []).count() == 0
    assert selection.map_slice(rollups.state_by_year(places), []).count() == 0


def test_map_year_defaults_to_the_last_of_the_selection(places):
    states = rollups.state_by_year(places)
    assert {r["Ano"] for r in selection.map_slice(states, [2022, 2020]).collect()} == {2020}
    assert {r["Ano"] for r in selection.map_slice(states, [2022, 2020], map_year=2022).collect()} == {2022}


def test_colour_range(places):
    shown = selection.map_slice(rollups.state_by_year(places), [2022])
    assert selection.colour_range(shown).first() == (80.0, 90.9)


def test_orderings(places):
    trend = selection.national_trend(rollups.national_by_year(places)).collect()
    assert [r["Ano"] for r in trend] == ["2020", "2022"]
    regional = selection.regional_evolution(rollups.regional_by_year(places)).collect()
    keys = [(r["NOME_REGIAO"], r["Ano"]) for r in regional]
    assert keys == sorted(keys)


def test_labels_and_row_types(places):
    regional = selection.labelled(selection.with_row_type(rollups.regional_by_year(places)))
    assert regional.columns == [
        "Ano", "Região", "Total de Comparecimentos", "Total de Abstenções", "Taxa de Comparecimento (%)", "Tipo",
    ]
    assert dict(regional.dtypes)["Ano"] == "bigint"
    kinds = {r["Região"]: r["Tipo"] for r in regional.collect()}
    assert kinds == {"Sudeste": "Nacional", "Exterior": "Internacional", "Desconhecido": "Nacional"}
    national = selection.with_row_type(rollups.national_by_year(places))
    assert {r["tipo"] for r in national.collect()} == {"Nacional"}


def test_documented_sql(spark):
    ddl = (
        "ANO_ELEICAO int, CD_MUNICIPIO int, NOME_REGIAO string, QT_COMPARECIMENTO long,"
        " TAXA_COMPARECIMENTO_PCT double, TAXA_ABSTENCAO_PCT double"
    )
    rows = [
        (2020, 1, "Sul", 2, 2.675, 50.0), (2022, 1, "Sul", 3, 80.0, 20.0), (2022, 2, "Norte", 7, 90.0, 10.0),
        (2022, 2, "Norte", 8, 90.0, 10.0),
    ]
    df = spark.createDataFrame(rows, ddl)
    by_year = rollups.rates_by_year(df).collect()
    assert by_year == [(2022, 86.67, 13.33), (2020, 2.68, 50.0)]
    by_region = rollups.by_region(df).collect()
    assert by_region == [("Norte", 2, 8.0, 90.0), ("Sul", 2, 3.0, 41.34)]
    distinct = {r["NOME_REGIAO"]: (r["n_rows"], r["n_municipios"]) for r in rollups.municipalities_by_region(df).collect()}
    assert distinct == {"Norte": (2, 1), "Sul": (2, 1)}


def test_report(places):
    report = report_of(places, [2020, 2022])
    try:
        assert report.latest_figures().first()["comparecimento_total"] == 2440
        assert [r["Ano"] for r in report.trend().collect()] == ["2020", "2022"]
        assert {r["Região"] for r in report.regional_table().collect()} == {"Sudeste", "Exterior"}
        assert {r["nome_estado"] for r in report.map().collect()} == {
            "São Paulo", "Rio de Janeiro", "Minas Gerais",
        }
        assert {r["Tipo"] for r in report.national_table().collect()} == {"Nacional"}
        assert [r["Ano"] for r in report.regional_evolution().collect()] == [2022, 2020, 2022]
        assert report.latest_figures_text().first()["turnout_text"] == "2,440"
    finally:
        report.release()


def test_report_of_no_years(places):
    report = report_of(places, [])
    assert report.national.count() == 0 and report.map().count() == 0
    assert report.latest_figures().count() == 0
    report.release()


def test_unknown_state_has_no_name(places):
    states = rollups.with_state_name(rollups.state_by_year(places))
    assert {r["nome_estado"] for r in states.where("SG_UF = 'XX'").collect()} == {None}
    assert S.UNKNOWN_REGION in {r["regiao"] for r in states.collect()}
