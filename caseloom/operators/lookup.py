"""Resolve records against reference tables whose keys may repeat or be missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions import parsing as p
from caseloom.functions.ordering import sort_key
from caseloom.functions.skew import none_null, spread_join
from caseloom.operators.rules import Rule


def reduce_dimension(
    dim: DataFrame, keys: list[str], order: list[tuple[str, str]], count_as: str = "match_count"
) -> DataFrame:
    """One row per key: the first under ``order`` and how many rows share the key.

    Rows with a null key are left out, as nothing can match them.
    """
    rest = [c for c in dim.columns if c not in keys]
    best = F.min_by(F.struct(*rest), sort_key(dim, order))
    return (
        dim.where(none_null(keys))
        .groupBy(*keys)
        .agg(best.alias("_best"), F.count(F.lit(1)).alias(count_as))
        .select(*keys, "_best.*", count_as)
    )


def lookup(df: DataFrame, reduced: DataFrame, on: dict[str, str], count_as: str, prefix: str) -> DataFrame:
    """Left join to a reduced table; adds match count, ``_exists`` and ``_ambiguous`` flags.

    ``on`` maps columns of ``df`` to the key columns of ``reduced``. Every row
    of ``df`` comes back exactly once.
    """
    right = reduced.withColumnsRenamed({theirs: f"_on_{ours}" for ours, theirs in on.items()})
    keyed = df.withColumns({f"_on_{ours}": F.col(ours) for ours in on})
    count = F.coalesce(F.col(count_as), F.lit(0))
    return (
        spread_join(keyed, right, [f"_on_{ours}" for ours in on])
        .drop(*[f"_on_{ours}" for ours in on])
        .withColumns({count_as: count, f"{prefix}_exists": count > 0, f"{prefix}_ambiguous": count > 1})
    )


def attach(df: DataFrame, per_key: DataFrame, keys: list[str], defaults: dict[str, Column] | None = None) -> DataFrame:
    """Left join one-row-per-key results back to ``df``, filling what is absent."""
    joined = spread_join(df, per_key, keys)
    return joined.withColumns({c: F.coalesce(F.col(c), v) for c, v in (defaults or {}).items()})


def match_score(
    df: DataFrame, pairs: Sequence[tuple[str, str, str, int]], exists: str, out: str = "entity_match_confidence"
) -> DataFrame:
    """Weighted share of fields that agree.

    ``pairs`` holds (flag to add, our column, their column, points); points are
    hundredths, summed as integers so that a full match is exactly 1.
    """
    flags = {
        flag: F.coalesce(F.col(exists) & (F.col(ours) == F.col(theirs)), F.lit(False))
        for flag, ours, theirs, _ in pairs
    }
    points = sum((F.col(flag).cast("int") * weight for flag, _, _, weight in pairs), F.lit(0))
    return df.withColumns(flags).withColumn(out, points / F.lit(100.0))


def flag_policy_active(df: DataFrame, day: str, out: str = "policy_active_on_service_date") -> DataFrame:
    active = p.active_on(
        F.col(day), F.col("coverage_start_date"), F.col("coverage_end_date"), F.col("policy_status")
    )
    return df.withColumn(out, F.col("policy_exists") & active)


def reference_rules() -> list[Rule]:
    """What can go wrong when a claim is resolved (needs the columns the lookups add)."""
    c = F.col
    return [
        Rule("POLICY_NOT_FOUND", ~c("policy_exists")),
        Rule("POLICY_AMBIGUOUS", c("policy_ambiguous")),
        Rule("POLICY_INACTIVE_ON_SERVICE_DATE", c("policy_exists") & ~c("policy_active_on_service_date")),
        Rule("MEMBER_NOT_FOUND", ~c("member_exists")),
        Rule("MEMBER_IDENTITY_MISMATCH", c("member_exists") & (c("entity_match_confidence") < 1)),
        Rule("PROVIDER_NOT_FOUND", ~c("provider_exists")),
        Rule("PROVIDER_AMBIGUOUS", c("provider_ambiguous")),
        Rule("PROVIDER_INACTIVE", c("provider_exists") & ~c("provider_active")),
    ]
