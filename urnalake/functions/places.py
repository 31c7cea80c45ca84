"""Region and state lookups as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urnalake import schema as S


def _lookup(table: dict[str, str], key: Column | str) -> Column:
    # A literal map folds into one constant, so the lookup stays inside generated code.
    entries = F.expr("map(" + ", ".join(f"'{k}', '{v}'" for k, v in table.items()) + ")")
    return F.try_element_at(entries, F.col(key) if isinstance(key, str) else key)


def region_of(uf: Column | str) -> Column:
    """Region of a state code; case-sensitive, anything unknown is ``Desconhecido``."""
    return F.coalesce(_lookup(S.REGION_BY_UF, uf), F.lit(S.UNKNOWN_REGION))


def state_name_of(uf: Column | str) -> Column:
    """Full state name, NULL for codes that are not one of the 27 states."""
    return _lookup(S.STATE_NAME_BY_UF, uf)


def row_type_of(region: Column | str) -> Column:
    region = F.col(region) if isinstance(region, str) else region
    return F.when(region == S.OVERSEAS_REGION, S.INTERNATIONAL_ROW).otherwise(S.NATIONAL_ROW)


def region_dimension(spark: SparkSession) -> DataFrame:
    """The 28 fixed (SG_UF, NOME_REGIAO) rows, for joins from SQL."""
    rows = ", ".join(f"('{uf}', '{region}')" for uf, region in S.REGION_BY_UF.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(SG_UF, {S.REGION})")
