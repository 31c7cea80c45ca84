import itertools
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from urnalake.functions.widening import EXACT_IN_DOUBLE, common_type
from urnalake.operators.union import unite
from urnalake.sources import tables

B, H, I, L, F, D = (t() for t in (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType))
TEXT, NOTHING = T.StringType(), T.NullType()


@pytest.mark.parametrize(
    ("one", "other", "both"),
    [
        (B, H, H), (I, B, I), (I, L, L), (F, D, D), (I, D, D), (L, D, D), (H, F, F), (I, F, D), (L, F, D),
        (I, T.DecimalType(7, 2), T.DecimalType(12, 2)), (T.DecimalType(5, 0), T.DecimalType(5, 4), T.DecimalType(9, 4)),
        (L, T.DecimalType(38, 20), None), (T.DecimalType(5, 1), D, None), (I, TEXT, None), (NOTHING, TEXT, TEXT),
        (T.DateType(), T.TimestampType(), None), (T.BooleanType(), I, None), (T.ArrayType(I), T.ArrayType(L), None),
    ],
)
def test_common_types(one, other, both):
    assert common_type(one, other) == both == common_type(other, one)


def test_the_order_of_frames_does_not_matter():
    kinds = [B, H, I, L, F, D, NOTHING, T.DecimalType(7, 2), T.DecimalType(20, 0), TEXT]

    def fold(types):
        settled = types[0]
        for other in types[1:]:
            settled = settled and common_type(settled, other)
        return settled

    for chosen in itertools.combinations(kinds, 3):
        assert len({str(fold(order)) for order in itertools.permutations(chosen)}) == 1, chosen


def frame(spark, ddl, *values):
    return spark.createDataFrame([(v,) for v in values], ddl)


def test_values_stay_as_they_are(spark):
    ints, longs = frame(spark, "a int", 1, None), frame(spark, "A long", 2**40, -EXACT_IN_DOUBLE)
    doubles = frame(spark, "a double", 0.1, float("nan"))
    united = unite([ints, longs, doubles])
    assert united.dtypes == [("a", "double")]
    assert [str(r["a"]) for r in united.collect()] == ["1.0", "None", str(float(2**40)), str(float(-EXACT_IN_DOUBLE)), "0.1", "nan"]
    exact = unite([frame(spark, "a decimal(5,2)", Decimal("1.25")), frame(spark, "a long", 2**63 - 1)])
    assert [r["a"] for r in exact.collect()] == [Decimal("1.25"), Decimal(2**63 - 1)]


@pytest.mark.parametrize("value", [EXACT_IN_DOUBLE + 1, -EXACT_IN_DOUBLE - 1, 2**63 - 1, -(2**63)])
def test_values_that_do_not_fit_fail(spark, value):
    united = unite([frame(spark, "a long", value), frame(spark, "a double", 1.0)])
    with pytest.raises(Exception, match="column a: no double for"):
        united.collect()


def test_types_without_a_common_one_are_refused(spark):
    with pytest.raises(TypeError, match="column a: no type holds all values of int, string"):
        unite([frame(spark, "a int", 1), frame(spark, "a string", "1")])


def test_absent_columns_strange_names_and_single_frames(spark):
    one = spark.createDataFrame([(1, 2)], "`a.b` int, `c``d` int")
    other = spark.createDataFrame([(3, "x")], "`a.b` long, e string")
    assert [tuple(r) for r in unite([one, other]).collect()] == [(1, 2, None), (3, None, "x")]
    assert unite([one]) is one


def test_years_of_several_types(spark, tmp_path):
    root = str(tmp_path)
    tables.write_year(frame(spark, "QT_APTOS int", 5), root, 2018)
    tables.write_year(frame(spark, "QT_APTOS long", 2**40), root, 2020)
    read = tables.read_years_in_full(spark, root, [2018, 2020])
    assert dict(read.dtypes)["QT_APTOS"] == "bigint"
    assert sorted(r["QT_APTOS"] for r in read.collect()) == [5, 2**40]
