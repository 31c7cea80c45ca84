"""Unions of frames whose columns and types differ."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from urnalake.functions.widening import common_type, widened


def unite(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by name; a column that a frame lacks is NULL in its rows.

    A column of several types gets the narrowest one with all their values. Where there is none, the
    union is refused with the column's name. Types are settled over all frames first, so their order only
    decides the order of the columns. Frames that need no cast are left as they are.
    """
    exact = frames[0].sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    key = (lambda name: name) if exact else str.lower
    types: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for field in frame.schema:
            known = types.setdefault(key(field.name), [])
            if field.dataType not in known:
                known.append(field.dataType)
    target = {name: _settled(name, known) for name, known in types.items()}
    cast = []
    for frame in frames:
        fields = frame.schema.fields
        if any(f.dataType.simpleString() != target[key(f.name)].simpleString() for f in fields):
            frame = frame.select(*[widened(f.name, f.dataType, target[key(f.name)]) for f in fields])
        cast.append(frame)
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), cast)


def _settled(name: str, known: list[T.DataType]) -> T.DataType:
    settled = known[0]
    for other in known[1:]:
        found = common_type(settled, other)
        if found is None:
            kinds = ", ".join(t.simpleString() for t in known)
            raise TypeError(f"column {name}: no type holds all values of {kinds}")
        settled = found
    return settled
