import math
import random

import pytest
from helpers import bronze_rows, cell
from pyspark.sql import functions as F

from urnalake import functions as fn
from urnalake import schema as S


def test_percentage_is_ieee(spark):
    rows = [(80, 100), (0, 0), (5, 0), (-5, 0), (None, 0), (None, 10), (3, None), (1, 3)]
    df = spark.createDataFrame(rows, "n long, d long")
    got = [r[0] for r in df.select(fn.percentage("n", "d")).collect()]
    assert got[0] == 80.0
    assert math.isnan(got[1])
    assert got[2] == math.inf and got[3] == -math.inf
    assert got[4] is None and got[5] is None and got[6] is None
    assert got[7] == 1 / 3 * 100


def test_every_state_has_its_region(spark):
    assert len(S.REGION_BY_UF) == 28
    assert len(S.STATE_NAME_BY_UF) == 27
    df = spark.createDataFrame([(uf,) for uf in S.REGION_BY_UF], "uf string")
    got = {r[0]: (r[1], r[2]) for r in df.select("uf", fn.region_of("uf"), fn.state_name_of("uf")).collect()}
    assert {uf: region for uf, (region, _) in got.items()} == S.REGION_BY_UF
    assert {uf: name for uf, (_, name) in got.items() if name} == S.STATE_NAME_BY_UF


@pytest.mark.parametrize("uf", ["XX", "", "ABC", "sp", "São Paulo", None])
def test_other_codes_are_unknown(spark, uf):
    df = spark.createDataFrame([(uf,)], "uf string")
    assert df.select(fn.region_of("uf"), fn.state_name_of("uf")).first() == (S.UNKNOWN_REGION, None)


def test_region_join_gives_the_same(spark):
    from urnalake.operators import silver

    df = bronze_rows(spark, [cell(uf) for uf in ["SP", "ZZ", "XX", "sp", None]])
    joined, looked_up = silver.with_region_joined(df), silver.with_region(df)
    assert joined.columns == looked_up.columns
    assert sorted(joined.collect(), key=str) == sorted(looked_up.collect(), key=str)


def test_percent_text_matches_python_formatting(spark):
    random.seed(7)
    values = [0.0, 82.25, 82.35, 0.05, 0.15, 99.95, 100.0, 1234.5, 83.63333, math.nan, math.inf, -math.inf]
    values += [random.uniform(0, 100) for _ in range(500)] + [i / 8 for i in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(fn.percent_text("x")).collect()]
    assert got == [f"{v:.1f}%" for v in values]


def test_grouped_text(spark):
    df = spark.createDataFrame([(v,) for v in [0, 999, 1000, 2400, 123456789]], "x long")
    got = [r[0] for r in df.select(fn.grouped_text("x")).collect()]
    assert got == ["0", "999", "1,000", "2,400", "123,456,789"]


def test_ids(spark):
    row = spark.range(1).select(
        fn.dataset_id(F.lit("d"), F.lit(2022)), fn.source_id(F.lit("d"), F.lit(2022))
    ).first()
    assert row == ("d:2022", "tse:d:2022")


def test_strict_cast_fails_on_unreadable_text(spark):
    df = spark.createDataFrame([("12",), (" 13 ",), (None,)], "QT_APTOS string")
    assert [r[0] for r in fn.cast_by_name(df).collect()] == [12, 13, None]
    bad = spark.createDataFrame([("foo",)], "QT_APTOS string")
    with pytest.raises(Exception, match="cannot read 'foo' as bigint"):
        fn.cast_by_name(bad).collect()


def test_strict_cast_does_not_depend_on_ansi_mode(spark):
    bad = spark.createDataFrame([("300",)], "NR_TURNO string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="cannot read '300' as tinyint"):
            fn.cast_by_name(bad).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_both_null_tokens(spark):
    df = spark.createDataFrame([("#NULO#", "#NE#", 1), ("a", "#nulo#", 2)], "a string, b string, n int")
    assert fn.nullify_tokens(df).collect() == [(None, None, 1), ("a", "#nulo#", 2)]


def test_sample_key_differs_for_null_and_seed(spark):
    df = spark.createDataFrame([("a", None), ("a", "b"), ("a", "b")], "x string, y string")
    keys = [r[0] for r in df.select(fn.sample_key(["x", "y"])).collect()]
    assert keys[1] == keys[2] and keys[0] != keys[1]
    assert df.select(fn.sample_key(["x", "y"], seed=1)).first()[0] != keys[0]
