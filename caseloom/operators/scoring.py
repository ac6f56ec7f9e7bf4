"""Additive scores with a cap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom import fixed_values as fv


def score(df: DataFrame, rules: Sequence[tuple[Column, int]], cap: int, out: str) -> DataFrame:
    """Sum the points of the predicates that hold (unknown does not), up to ``cap``."""
    total = sum((F.when(fires, points).otherwise(0) for fires, points in rules), F.lit(0))
    return df.withColumn(out, F.least(F.lit(cap), total))


def risk_rules(billed: str = "billed_amount_parsed") -> list[tuple[Column, int]]:
    c = F.col
    above_mean = c(billed).cast("double") > c("historical_average_claim_amount") * fv.AMOUNT_FACTOR
    return [
        (c("duplicate_claim_flag"), fv.RISK_DUPLICATE),
        (c("prior_claim_count_365d") > fv.MANY_PRIOR, fv.RISK_MANY_PRIOR),
        (c("same_procedure_claim_count_365d") > fv.MANY_SAME_PROCEDURE, fv.RISK_SAME_PROCEDURE),
        (above_mean, fv.RISK_AMOUNT),
    ]
