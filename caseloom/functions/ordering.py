"""Composite sort keys, so that one ``min_by`` can replace a sort and a rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sort_key(df: DataFrame, order: list[tuple[str, str]]) -> Column:
    """Struct that is smallest on the first row of ``order``; nulls go last.

    ``order`` holds (column, "asc" | "desc"). Descending works for numbers,
    booleans, dates and timestamps, whose negation exists.
    """
    parts: list[Column] = []
    for i, (name, direction) in enumerate(order):
        c = F.col(name)
        if direction == "desc":
            c = _negated(c, df.schema[name].dataType, name)
        parts += [c.isNull().alias(f"n{i}"), c.alias(f"v{i}")]
    return F.struct(*parts)


def _negated(c: Column, dtype: T.DataType, name: str) -> Column:
    if isinstance(dtype, T.NumericType):
        return -c
    if isinstance(dtype, T.BooleanType):
        return -c.cast("int")
    if isinstance(dtype, T.DateType):
        return -F.unix_date(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return -F.unix_micros(c.cast("timestamp"))
    raise TypeError(f"cannot sort {name} ({dtype.simpleString()}) descending")
