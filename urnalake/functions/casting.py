"""Text to typed columns: null tokens, casts by name, conformance tests."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urnalake import schema as S


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def nullify_tokens(df: DataFrame, tokens: Iterable[str] = S.NULL_TOKENS) -> DataFrame:
    """Replace the null tokens by NULL in every string column."""
    tokens = list(tokens)
    return df.select(
        *[
            F.when(~quoted(f.name).isin(tokens), quoted(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else quoted(f.name)
            for f in df.schema
        ]
    )


def strict_cast(name: str, data_type: T.DataType) -> Column:
    """Cast that fails the job on unreadable text instead of turning it into NULL."""
    text = quoted(name)
    value = text.try_cast(data_type)  # NULL for NULL and for unreadable text
    problem = F.concat(
        F.lit(f"column {name}: cannot read '"),
        text.cast("string"),
        F.lit(f"' as {data_type.simpleString()}"),
    )
    return F.coalesce(value, F.when(text.isNotNull(), F.raise_error(problem)))


def cast_by_name(df: DataFrame, types: T.StructType = S.BRONZE_SCHEMA) -> DataFrame:
    """Give the named columns their types; absent ones are tolerated, others kept as they are."""
    wanted = {f.name: f.dataType for f in types}
    return df.select(
        *[
            strict_cast(f.name, wanted[f.name]).alias(f.name)
            if f.name in wanted and f.dataType != wanted[f.name]
            else quoted(f.name)
            for f in df.schema
        ]
    )


# Spark ignores blanks and control characters around a number.
_WHOLE_NUMBER = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*$"
_LARGEST = {T.ByteType: 2**7, T.ShortType: 2**15, T.IntegerType: 2**31}


def does_not_conform(name: str, data_type: T.DataType) -> Column:
    """True for text that is present but cannot be read as ``data_type``.

    A failing ``try_cast`` is about a hundred times slower than a good one, as it goes
    through an exception. Whole numbers are therefore tested by shape and range first, and
    only digits too many for a bigint reach the cast. Plain digits, as nearly all text is, need
    no regular expression.
    """
    text = quoted(name)
    if isinstance(data_type, T.StringType):
        return F.lit(False)
    unreadable = text.try_cast(data_type).isNull()
    if isinstance(data_type, S.INTEGER_TYPES):
        limit = _LARGEST.get(type(data_type))
        number = text.cast("long")
        plain = F.translate(text, "0123456789", "") == ""
        out_of_range = F.lit(False) if limit is None else (number < -limit) | (number >= limit)
        unreadable = (
            F.when(plain & F.length(text).between(1, 18), out_of_range)
            .when(~text.rlike(_WHOLE_NUMBER), True)
            .when(F.length(text) <= 18, out_of_range)
            .otherwise(unreadable)
        )
    return text.isNotNull() & unreadable
