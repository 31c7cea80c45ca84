"""Types that hold every value of two others, and casts to them that lose nothing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urnalake.functions.casting import quoted

# Decimal digits of the whole-number types, the narrowest first.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_WHOLE = list(_DIGITS)
_FLOATING = (T.FloatType, T.DoubleType)
#: Up to here a double holds every whole number.
EXACT_IN_DOUBLE = 2**53


def common_type(first: T.DataType, second: T.DataType) -> T.DataType | None:
    """The narrowest type with all values of both, or None if there is none.

    byte → short → int → long, float → double, whole numbers → decimal, and whole numbers → double;
    a long goes into a double as far as its value allows, see :func:`widened`. A decimal does not go into
    a double, nor a number into text.
    """
    if first.simpleString() == second.simpleString():
        return first
    kinds = (type(first), type(second))
    if T.NullType in kinds:
        return second if kinds[0] is T.NullType else first
    if all(k in _DIGITS for k in kinds):
        return max(first, second, key=lambda t: _WHOLE.index(type(t)))
    if all(k in _FLOATING for k in kinds):
        return T.DoubleType()
    if T.DecimalType in kinds and all(k in _DIGITS or k is T.DecimalType for k in kinds):
        digits = [_decimal_digits(t) for t in (first, second)]
        whole, scale = (max(d[i] for d in digits) for i in (0, 1))
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    if any(k in _FLOATING for k in kinds) and any(k in _DIGITS for k in kinds):
        number = next(k for k in kinds if k in _DIGITS)
        # A float holds whole numbers of 24 bits.
        return T.FloatType() if T.FloatType in kinds and number in (T.ByteType, T.ShortType) else T.DoubleType()
    return None


def _decimal_digits(data_type: T.DataType) -> tuple[int, int]:
    """Digits before and behind the point."""
    if isinstance(data_type, T.DecimalType):
        return data_type.precision - data_type.scale, data_type.scale
    return _DIGITS[type(data_type)], 0


def widened(name: str, old: T.DataType, new: T.DataType) -> Column:
    """The column in its :func:`common_type`; a long that a double may not hold fails the job."""
    value = quoted(name)
    if old.simpleString() == new.simpleString():
        return value
    if isinstance(old, T.LongType) and isinstance(new, T.DoubleType):
        problem = F.concat(F.lit(f"column {name}: no double for "), value.cast("string"))
        lossy = ~value.between(-EXACT_IN_DOUBLE, EXACT_IN_DOUBLE)
        return F.when(lossy, F.raise_error(problem).cast("double")).otherwise(value.cast("double")).alias(name)
    return value.cast(new).alias(name)
