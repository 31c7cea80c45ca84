from helpers import bronze_rows, cell
from pyspark.sql import functions as F

from urnalake.operators import ranking


def test_top_rows(spark):
    rows = [cell("SP", 1000, 10 * i, 0, name=f"C{i:02d}") for i in range(30)]
    got = ranking.top_by_turnout(bronze_rows(spark, rows)).collect()
    assert [r["QT_COMPARECIMENTO"] for r in got] == [290 - 10 * i for i in range(10)]
    assert got[0].asDict().keys() == {"NM_MUNICIPIO", "SG_UF", "QT_COMPARECIMENTO", "QT_APTOS"}


def test_top_ties_are_broken_by_every_column(spark):
    rows = [cell(uf, 100 + i, 5, 0, name=n) for uf in ("SP", "RJ") for i in range(3) for n in ("B", "A", None)]
    df = bronze_rows(spark, rows)
    first = ranking.top_by_turnout(df, 5).collect()
    assert first == ranking.top_by_turnout(df.repartition(7), 5).collect()
    assert [(r["NM_MUNICIPIO"], r["SG_UF"], r["QT_APTOS"]) for r in first][:4] == [
        ("A", "RJ", 102), ("A", "RJ", 101), ("A", "RJ", 100), ("A", "SP", 102),
    ]


def _years(spark, n=5000):
    """A hot year with two thirds of the rows, half of them copies of one row."""
    row = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    return spark.range(n).select(
        F.when(F.col("id") % 3 < 2, 2022).when(F.col("id") % 3000 == 2, 2018).otherwise(2020).alias("Ano"),
        row.alias("x"),
        F.when(row % 2 == 0, F.concat(F.lit("n"), row)).alias("y"),
    )


def _expected(df, n):
    keyed = df.withColumn("k", ranking.sample_key(["Ano", "x", "y"])).collect()
    result = []
    for year in {r["Ano"] for r in keyed}:
        mine = sorted((r for r in keyed if r["Ano"] == year), key=lambda r: r["k"])
        result += [(r["Ano"], r["x"], r["y"]) for r in mine[:n]]
    return sorted(result, key=str)


def test_sample_is_exact_and_repeatable(spark):
    df = _years(spark)
    for n in (1, 100, 1700):
        expected = _expected(df, n)
        for parts in (1, 5, 16):
            got = ranking.exact_sample(df.repartition(parts), n=n).collect()
            assert sorted(map(tuple, got), key=str) == expected
    counts = {r["Ano"]: r["count"] for r in ranking.exact_sample(df).groupBy("Ano").count().collect()}
    assert counts == {2022: 100, 2020: 100, 2018: 2}


def test_seed_changes_the_sample(spark):
    df = _years(spark).where("Ano = 2020")
    one, other = ranking.exact_sample(df, 50), ranking.exact_sample(df, 50, seed=1)
    assert set(one.collect()) != set(other.collect())


def test_rows_without_a_year_are_a_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (2022, 3)], "Ano int, x int")
    assert sorted(map(tuple, ranking.exact_sample(df, 5).collect()), key=str) == [(2022, 3), (None, 1), (None, 2)]
    assert ranking.exact_sample(df, 1).count() == 2
