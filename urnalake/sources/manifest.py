"""The source manifest: which year of which dataset comes from where."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urnalake import schema as S
from urnalake.functions.text import dataset_id, is_valid_origin, source_id


def published_years(spark: SparkSession) -> DataFrame:
    """Years with published data, newest first."""
    years = ", ".join(f"({y})" for y in S.PUBLISHED_YEARS)
    return spark.sql(f"SELECT * FROM VALUES {years} AS t(ano)").orderBy(F.desc("ano"))


def manifest_of(years: DataFrame, dataset: str = S.BRONZE_DATASET) -> DataFrame:
    """(dataset, ano, origin, ids) for a frame of years."""
    return years.select(
        F.lit(dataset).alias("dataset"),
        F.col("ano").cast("int").alias("ano"),
        F.format_string(S.ORIGIN_FORMAT, F.col("ano").cast("int")).alias("origin"),
        dataset_id(F.lit(dataset), F.col("ano")).alias("dataset_id"),
        source_id(F.lit(dataset), F.col("ano")).alias("source_id"),
    )


def with_validity(manifest: DataFrame) -> DataFrame:
    """One rule column per validity rule and ``is_valid`` over all of them; NULLs are invalid."""

    def holds(condition):
        return F.coalesce(condition, F.lit(False))

    checked = manifest.withColumns(
        {
            "name_given": holds(F.trim("dataset") != ""),
            "name_known": holds(F.col("dataset").isin(*S.KNOWN_DATASETS)),
            "year_in_range": holds(F.col("ano").between(S.FIRST_YEAR, S.LAST_YEAR)),
            "origin_valid": holds(is_valid_origin("origin") & (F.trim("origin") != "")),
        }
    )
    return checked.withColumn(
        "is_valid",
        F.col("name_given") & F.col("name_known") & F.col("year_in_range") & F.col("origin_valid"),
    )
