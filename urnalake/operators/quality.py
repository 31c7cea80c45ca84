"""Contract, value-rule and consistency reports over whole tables.

Each report is one aggregation: partial results are one row per task, and the final row is
turned into one row per field or rule.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urnalake import schema as S
from urnalake.functions.casting import does_not_conform


class ContractError(ValueError):
    """A required field is missing or cannot be read as its type."""


def type_conformance(
    landed: DataFrame,
    types: T.StructType = S.BRONZE_SCHEMA,
    optional: Iterable[str] = S.OPTIONAL_FIELDS,
) -> DataFrame:
    """Per contract field: is it there, and how many values cannot be read as its type."""
    optional = set(optional)
    present = set(landed.columns)
    counts = landed.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[
            F.count_if(does_not_conform(f.name, f.dataType)).alias(f.name)
            for f in types
            if f.name in present
        ],
    )
    lines = [
        F.struct(
            F.lit(f.name).alias("field"),
            F.lit(f.dataType.simpleString()).alias("expected_type"),
            F.lit(f.name not in optional).alias("required"),
            F.lit(f.name in present).alias("present"),
            (F.col(f.name) if f.name in present else F.lit(0)).cast("long").alias("bad_values"),
        )
        for f in types
    ]
    return counts.select(F.inline(F.array(*lines)))


def contract_violations(conformance: DataFrame) -> DataFrame:
    """Required fields that are missing, and any field with unreadable values."""
    missing = F.col("required") & ~F.col("present")
    return conformance.where(missing | (F.col("bad_values") > 0))


def require_contract(landed: DataFrame, types: T.StructType = S.BRONZE_SCHEMA) -> None:
    """Fail when a required field is missing. Looks at the header only and runs no job.

    Unreadable values are left to the strict casts of the load itself, which saves a pass.
    """
    missing = [f.name for f in types if f.name not in S.OPTIONAL_FIELDS and f.name not in landed.columns]
    if missing:
        raise ContractError(f"required fields missing: {', '.join(missing)}")


_TYPE_CLASSES = {"inteiro": S.INTEGER_TYPES, "texto": S.TEXT_TYPES, "decimal": S.DECIMAL_TYPES}


def _type_class(data_type: T.DataType) -> str:
    for name, members in _TYPE_CLASSES.items():
        if isinstance(data_type, members):
            return name
    return "outro"


def schema_contract(df: DataFrame, contract: T.StructType = S.SILVER_SCHEMA) -> DataFrame:
    """Per contract field: is the column there, of the right class (integer, text, decimal), and full.

    ``nulls`` counts the rows without a value, which silver must not have; a missing column
    has none to count.
    """
    actual = {f.name: f.dataType for f in df.schema}
    found = [f.name for f in contract if f.name in actual]
    counts = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.isnull(c)).alias(c) for c in found])
    lines = []
    for f in contract:
        data_type = actual.get(f.name)
        matches = data_type is not None and _type_class(data_type) == _type_class(f.dataType)
        lines.append(
            F.struct(
                F.lit(f.name).alias("field"),
                F.lit(_type_class(f.dataType)).alias("expected_class"),
                F.lit(data_type.simpleString() if data_type else None).cast("string").alias("actual_type"),
                F.lit(matches).alias("type_ok"),
                (F.col(f.name) if data_type else F.lit(None)).cast("long").alias("nulls"),
            )
        )
    return counts.select(F.inline(F.array(*lines)))


def require_schema(df: DataFrame, contract: T.StructType = S.SILVER_SCHEMA) -> None:
    actual = {f.name: f.dataType for f in df.schema}
    wrong = [
        f.name for f in contract if f.name not in actual or _type_class(actual[f.name]) != _type_class(f.dataType)
    ]
    if wrong:
        raise ContractError(f"columns missing or of the wrong type: {', '.join(wrong)}")


def rule_violations(df: DataFrame, rules: list[S.Rule]) -> DataFrame:
    """Number of rows that break each rule. Reports only, no row is removed."""
    counts = df.agg(*[F.count_if(rule.broken).alias(f"r{i}") for i, rule in enumerate(rules)])
    lines = [
        F.struct(
            F.lit(rule.field).alias("field"),
            F.lit(rule.name).alias("rule"),
            F.col(f"r{i}").alias("violations"),
        )
        for i, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*lines)))


def broken_rules(rules: list[S.Rule]) -> Column:
    """The rules that a row breaks, as an array of "field:name" in the order of ``rules``."""
    named = [F.when(rule.broken, F.lit(f"{rule.field}:{rule.name}")) for rule in rules]
    return F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")


def is_consistent() -> Column:
    return F.col("QT_COMPARECIMENTO") + F.col("QT_ABSTENCAO") == F.col("QT_APTOS")


def _consistency_columns() -> list[Column]:
    consistent = F.count_if(is_consistent())
    return [
        F.count(F.lit(1)).alias("n_rows"),
        consistent.alias("n_consistent"),
        F.try_divide(consistent, F.count(F.lit(1))).alias("consistent_ratio"),
    ]


def consistency_by_state(df: DataFrame) -> DataFrame:
    return df.groupBy("ANO_ELEICAO", "SG_UF").agg(*_consistency_columns())


def consistency_gate(df: DataFrame, minimum: float = 0.99) -> DataFrame:
    """One row: the share of rows where turnout and abstention add up, and whether it suffices."""
    totals = df.agg(*_consistency_columns())
    return totals.withColumn("passes", F.col("consistent_ratio") >= minimum)


def minimum_quantities(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min("QT_APTOS").alias("min_aptos"),
        F.min("QT_COMPARECIMENTO").alias("min_comparecimento"),
        F.min("QT_ABSTENCAO").alias("min_abstencao"),
    )


def years_present(df: DataFrame) -> DataFrame:
    return df.select("ANO_ELEICAO").distinct()


def malformed_rows(landed: DataFrame, corrupt_column: str) -> DataFrame:
    """How many landed lines have too few or too many fields.

    Spark refuses a CSV query that touches the malformed-line column alone, so the first
    field is counted along with it.
    """
    return landed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(landed.columns[0]).alias("n_first_field"),
        F.count(corrupt_column).alias("n_malformed"),
    )
