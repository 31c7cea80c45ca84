"""Percentages with IEEE results where Spark's own division would raise or give NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _double(value: str) -> Column:
    return F.lit(float(value))


def percentage(part: Column | str, whole: Column | str) -> Column:
    """``part / whole * 100``: 0/0 is NaN, n/0 is an infinity, NULL only for NULL input."""
    n = (F.col(part) if isinstance(part, str) else part).cast("double")
    d = (F.col(whole) if isinstance(whole, str) else whole).cast("double")
    return (
        F.when(d != 0, n / d * 100)
        .when(d.isNull(), F.lit(None).cast("double"))
        .when(n > 0, _double("inf"))
        .when(n < 0, _double("-inf"))
        .when(n == 0, _double("nan"))
    )
