"""Every registered query against DuckDB, and the driver contract."""

import __spark_entry__ as entry_point
import pytest
from compare import difference, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = entry_point.queries()[name](spark, SF)
    assert difference(df, con, entry_point.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry_point.queries()) - set(entry_point.oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert entry_point.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == [
        "Ano", "NOME_REGIAO", "SG_UF", "level", "comparecimento_total", "abstencao_total", "taxa_comparecimento",
    ]
    assert df.count() > 0


def test_sorted_queries_are_in_order(spark):
    run = {name: query(spark, SF).collect() for name, query in entry_point.queries().items() if name in {
        "trend_sorted", "regional_sorted", "doc_rates_by_year", "doc_by_region", "audit_list", "top10_turnout",
        "manifest_years",
    }}
    assert [r["Ano"] for r in run["trend_sorted"]] == sorted(r["Ano"] for r in run["trend_sorted"])
    regional = [(r["NOME_REGIAO"], r["Ano"]) for r in run["regional_sorted"]]
    assert regional == sorted(regional)
    for name, column in [
        ("doc_rates_by_year", "ANO_ELEICAO"), ("doc_by_region", "taxa_comparecimento_pct"), ("audit_list", "ano"),
        ("top10_turnout", "QT_COMPARECIMENTO"), ("manifest_years", "ano"),
    ]:
        values = [r[column] for r in run[name]]
        assert values == sorted(values, reverse=True)
