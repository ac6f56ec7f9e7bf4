"""Tolerant parsing expressions: bad input gives null, never an ANSI error."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom import fixed_values as fv

MONEY = "decimal(18,2)"


def tidy(c: Column, upper: bool = False) -> Column:
    """Collapse every whitespace run to one blank, then trim."""
    out = F.trim(F.regexp_replace(c, r"\s+", " "))
    return F.upper(out) if upper else out


def enum(c: Column) -> Column:
    return F.upper(F.trim(c))


def digits(c: Column) -> Column:
    """Digits of a value; null when there are none, so it can never join."""
    return F.nullif(F.regexp_replace(c, "[^0-9]", ""), F.lit(""))


def present(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c) != "")


def blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def _shaped(text: Column, fmt: str) -> Column:
    """Whether the text has the length and digits of the format.

    A failed parse costs an exception per row, so only text of the right shape
    is tried. Formats with parts other than yyyy, MM and dd are always tried.
    """
    if not re.fullmatch(r"(?:yyyy|MM|dd|[^A-Za-z])+", fmt):
        return F.lit(True)
    runs = re.findall(r"yyyy|MM|dd|[^yMd]+", fmt)
    shape = "".join(rf"\d{{{len(r)}}}" if r[0] in "yMd" else re.escape(r) for r in runs)
    return text.rlike(f"^{shape}$")


def date_of(c: Column, formats: Sequence[str] = fv.DATE_FORMATS) -> Column:
    """Date under the first format that fits, otherwise null."""
    text = F.trim(c)
    return F.coalesce(*[F.when(_shaped(text, f), F.try_to_date(text, f)) for f in formats])


def date_outcome(c: Column, formats: Sequence[str] = fv.DATE_FORMATS) -> Column:
    """Name of the format that fits, or NULL_INPUT / UNPARSED."""
    text = F.trim(c)
    out = F.when(c.isNull(), "NULL_INPUT")
    for f in formats:
        out = out.when(_shaped(text, f) & F.try_to_date(text, f).isNotNull(), f)
    return out.otherwise("UNPARSED")


def bare_amount(c: Column) -> Column:
    """The amount text without currency marks and blanks."""
    return F.regexp_replace(F.trim(c), fv.CURRENCY_MARKS, "")


def amount_outcome(c: Column) -> Column:
    """DECIMAL_COMMA, THOUSANDS, PLAIN, or NULL_INPUT / UNPARSED, of a bare amount."""
    return (
        F.when(c.isNull(), "NULL_INPUT")
        .when(c.rlike(fv.AMOUNT_PLAIN), "PLAIN")
        .when(c.rlike(fv.AMOUNT_DECIMAL_COMMA), "DECIMAL_COMMA")
        .when(c.rlike(fv.AMOUNT_THOUSANDS), "THOUSANDS")
        .otherwise("UNPARSED")
    )


def amount_of(c: Column) -> Column:
    """Money value of a bare amount; a comma is a decimal mark before exactly two last digits."""
    number = (
        F.when(c.rlike(fv.AMOUNT_PLAIN), c)
        .when(c.rlike(fv.AMOUNT_DECIMAL_COMMA), F.replace(c, F.lit(","), F.lit(".")))
        .when(c.rlike(fv.AMOUNT_THOUSANDS), F.replace(c, F.lit(","), F.lit("")))
    )
    return number.try_cast(MONEY)


def codes_of(c: Column) -> Column:
    """Distinct, upper-case, non-blank codes of a delimited text."""
    text = F.upper(F.trim(F.coalesce(c, F.lit(""))))
    text = F.when(text.isin(*fv.EMPTY_CODE_LITERALS), "").otherwise(text)
    parts = F.split(F.regexp_replace(text, fv.CODE_DELIMITERS, "|"), r"\|")
    return F.array_distinct(F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != ""))


def active_on(day: Column, start: Column, end: Column, status: Column, wanted: str = "ACTIVE") -> Column:
    """True when ``status`` is wanted and ``day`` lies in [start, end]; unknowns are False."""
    return F.coalesce((status == wanted) & day.between(start, end), F.lit(False))


def codes_when(pairs) -> Column:
    """Array of the codes whose predicate holds, in the order given."""
    items = [F.when(predicate, F.lit(code)) for code, predicate in pairs]
    return F.array_compact(F.array(*items))
