import math

from helpers import BRONZE_DDL, bronze_rows, cell

from urnalake import schema as S
from urnalake.operators import silver

RATES = [cell("SP", 100, 80, 20), cell("RJ", 200, 150, 50), cell("MG", 300, 240, 60)]


def test_rates(spark):
    rows = silver.to_silver(bronze_rows(spark, RATES)).collect()
    assert [(r[S.RATE_TURNOUT], r[S.RATE_ABSTENTION]) for r in rows] == [(80.0, 20.0), (75.0, 25.0), (80.0, 20.0)]


def test_regions(spark):
    df = bronze_rows(spark, [cell(uf) for uf in ["SP", "RJ", "MG", "BA", "XX"]])
    got = [r[S.REGION] for r in silver.to_silver(df).collect()]
    assert got == ["Sudeste", "Sudeste", "Sudeste", "Nordeste", "Desconhecido"]


def test_rows_with_any_null_go(spark):
    rows = [*RATES[:2], cell("MG", 300, 240, 60, year=None), cell(uf=None), cell(name=None)]
    assert silver.to_silver(bronze_rows(spark, rows)).count() == 2


def test_null_in_extra_column_drops_the_row(spark):
    df = spark.createDataFrame([(*cell(), "x"), (*cell(), None)], BRONZE_DDL + ", DS_PERFIL string")
    assert silver.to_silver(df).count() == 1


def test_zero_electorate_stays(spark):
    df = bronze_rows(spark, [cell("SP", 0, 0, 0), cell("SP", 0, 5, 0)])
    rates = [r[S.RATE_TURNOUT] for r in silver.to_silver(df).collect()]
    assert math.isnan(rates[0]) and rates[1] == math.inf


def test_derive_then_drop_gives_the_same_rows(spark):
    df = bronze_rows(spark, [cell("SP", 0, 0, 0), cell(uf=None), *RATES, cell(name=None)])
    late = silver.drop_incomplete(silver.with_region(silver.with_rates(df)))
    assert sorted(map(str, late.collect())) == sorted(map(str, silver.to_silver(df).collect()))


def test_columns_are_kept_in_order(spark):
    df = spark.createDataFrame([(*cell(), "x")], BRONZE_DDL + ", DS_PERFIL string")
    assert silver.to_silver(df).columns == [*df.columns, S.RATE_TURNOUT, S.RATE_ABSTENTION, S.REGION]


def test_removal_stats(spark):
    df = bronze_rows(spark, [*RATES, cell(uf=None)])
    assert silver.removal_stats(df).first() == (4, 3, 1, 25.0)
    assert silver.removal_stats(df.limit(0)).first() == (0, 0, 0, None)
