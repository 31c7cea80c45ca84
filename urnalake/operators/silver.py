"""Bronze rows to silver rows: rates, region, removal of incomplete rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urnalake import schema as S
from urnalake.functions.casting import quoted
from urnalake.functions.places import region_dimension, region_of
from urnalake.functions.rates import percentage


def with_rates(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            S.RATE_TURNOUT: percentage("QT_COMPARECIMENTO", "QT_APTOS"),
            S.RATE_ABSTENTION: percentage("QT_ABSTENCAO", "QT_APTOS"),
        }
    )


def with_region(df: DataFrame) -> DataFrame:
    return df.withColumn(S.REGION, region_of("SG_UF"))


def with_region_joined(df: DataFrame) -> DataFrame:
    """Same result through a join; the dimension has 28 fixed rows, so it is broadcast."""
    dimension = F.broadcast(region_dimension(df.sparkSession))
    joined = df.join(dimension, "SG_UF", "left")
    return joined.select(
        *[quoted(c) for c in df.columns],
        F.coalesce(S.REGION, F.lit(S.UNKNOWN_REGION)).alias(S.REGION),
    )


def is_complete(df: DataFrame) -> Column:
    """No NULL in any column. NaN counts as data, which ``na.drop`` would not allow."""
    return reduce(and_, [quoted(c).isNotNull() for c in df.columns])


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.where(is_complete(df))


def to_silver(bronze: DataFrame) -> DataFrame:
    """All bronze columns in order, then the two rates and the region.

    The derived columns are NULL only where a bronze column is, so the rows are dropped
    first: the null test then reaches the Parquet scan and no rate is computed twice.
    """
    return with_region(with_rates(drop_incomplete(bronze)))


def removal_stats(df: DataFrame) -> DataFrame:
    """Rows before and after the null removal, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(is_complete(df)).alias("rows_after"),
    )
    removed = F.col("rows_before") - F.col("rows_after")
    return counts.select(
        "rows_before",
        "rows_after",
        removed.alias("rows_removed"),
        F.when(F.col("rows_before") > 0, removed / F.col("rows_before") * 100).alias("pct_removed"),
    )
