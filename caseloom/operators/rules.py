"""Rule arrays: every rule that fires adds its code to one array column."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions import parsing as p


class Rule(NamedTuple):
    code: str
    fires: Column


def validate(
    df: DataFrame, rules: Sequence[Rule], out: str = "validation_errors", valid_flag: str | None = None
) -> DataFrame:
    """Add the array of fired codes and, if named, the flag that none fired."""
    checked = df.withColumn(out, p.codes_when(rules))
    return checked.withColumn(valid_flag, F.size(out) == 0) if valid_flag else checked


def missing_fields(df: DataFrame, spec: dict[str, Column], out: str = "missing_fields") -> DataFrame:
    """Add the names of the required fields whose "is missing" predicate holds."""
    return df.withColumn(out, p.codes_when(spec.items()))


def code_counts(df: DataFrame, codes: str, by: Sequence[str] = (), name: str = "code") -> DataFrame:
    """Rows per code of an array column (rule violations, PII types, review reasons)."""
    # explode would put a non-empty filter below the rules and so evaluate every rule again
    rows = df.select(*by, F.explode_outer(codes).alias(name)).where(F.col(name).isNotNull())
    return rows.groupBy(*by, name).agg(F.count(F.lit(1)).alias("row_count"))


def flag_active(df: DataFrame, day: str, start: str, end: str, status: str, out: str, wanted: str = "ACTIVE"):
    """Add whether the row's day lies in its interval under the wanted status."""
    return df.withColumn(out, p.active_on(F.col(day), F.col(start), F.col(end), F.col(status), wanted))
