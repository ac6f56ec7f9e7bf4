"""Standardise noisy text columns; raw columns stay beside the new ones."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions import parsing as p


def _add(df: DataFrame, cols: Iterable[str], suffix: str, make: Callable[[Column], Column]) -> DataFrame:
    return df.withColumns({f"{c}{suffix}": make(F.col(c)) for c in cols})


def standardize_text(df: DataFrame, cols: dict[str, bool], suffix: str = "_normalized") -> DataFrame:
    """Collapse whitespace and trim; upper-case the columns mapped to True."""
    return df.withColumns({f"{c}{suffix}": p.tidy(F.col(c), upper) for c, upper in cols.items()})


def digits_only(df: DataFrame, cols: Iterable[str], suffix: str = "_normalized") -> DataFrame:
    return _add(df, cols, suffix, p.digits)


def parse_dates(
    df: DataFrame, cols: Iterable[str], formats: Sequence[str] = fv.DATE_FORMATS, suffix: str = "_parsed"
) -> DataFrame:
    return _add(df, cols, suffix, lambda c: p.date_of(c, formats))


def parse_code_lists(df: DataFrame, cols: Iterable[str], suffix: str = "_array") -> DataFrame:
    return _add(df, cols, suffix, p.codes_of)


def parse_amounts(df: DataFrame, cols: Sequence[str], suffix: str = "_parsed") -> DataFrame:
    # the bare text is a column of its own, so that it is stripped once and not once per pattern
    bare = _add(df, cols, "_bare", p.bare_amount)
    parsed = bare.withColumns({f"{c}{suffix}": p.amount_of(F.col(f"{c}_bare")) for c in cols})
    return parsed.drop(*[f"{c}_bare" for c in cols])


def standardize_enums(
    df: DataFrame,
    enums: Sequence[str] = (),
    numbers: Sequence[str] = (),
    flags: Sequence[str] = (),
    days: Sequence[str] = (),
) -> DataFrame:
    """Clean scalar columns in place: status words, numbers, booleans and ISO dates."""
    cleaned = {c: p.enum(F.col(c)) for c in enums}
    cleaned |= {c: F.trim(F.col(c).cast("string")).try_cast("double") for c in numbers}
    cleaned |= {c: F.trim(F.col(c).cast("string")).try_cast("boolean") for c in flags}
    cleaned |= {c: F.trim(F.col(c).cast("string")).try_cast("date") for c in days}
    return df.withColumns(cleaned)


def with_warnings(df: DataFrame, rules: dict[str, Column], out: str = "normalization_warnings") -> DataFrame:
    """Add the codes of the rewrites that changed how a value reads."""
    return df.withColumn(out, p.codes_when(rules.items()))


def profile_parses(df: DataFrame, dates: Sequence[str] = (), amounts: Sequence[str] = ()) -> DataFrame:
    """Row count per (column, outcome): which format fitted, and how often none did."""
    seen = [F.struct(F.lit(c).alias("column_name"), p.date_outcome(F.col(c)).alias("outcome")) for c in dates]
    seen += [
        F.struct(F.lit(c).alias("column_name"), p.amount_outcome(F.col(f"{c}_bare")).alias("outcome")) for c in amounts
    ]
    return (
        _add(df, amounts, "_bare", p.bare_amount)
        .select(F.inline(F.array(*seen)))
        .groupBy("column_name", "outcome")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("parsed", ~F.col("outcome").isin("NULL_INPUT", "UNPARSED"))
    )
