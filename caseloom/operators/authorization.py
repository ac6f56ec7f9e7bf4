"""Match requests to time-bounded grants and roll the outcome up by priority.

Like ``history``, nothing here pairs a request with the grants of its key: per
key facts are one aggregate, and what is valid on a day is a running aggregate
over the key's opening and closing days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions.skew import none_null, spread_join
from caseloom.operators.history import Between, as_is

NO_DAY = -(2**31)
GRANT = ("authorization_id", "authorization_status", "valid_from", "valid_to")


def match_authorizations(
    requests: DataFrame, grants: DataFrame, keys: list[str], day: str, between: Between = as_is
) -> DataFrame:
    """Add match count, valid count and the representative grant of each request.

    A grant is valid on a day when APPROVED and the day lies in
    [valid_from, valid_to]. The representative is a valid grant if there is
    one, then the one that ends last (unknown end last), then the lowest id.
    ``between`` may write what is used several times, see ``sources.lineage.cut``.
    """
    asked_day = F.coalesce(F.unix_date(F.col(day)), F.lit(NO_DAY))
    asked = requests.where(none_null(keys)).select(*keys, asked_day.alias("_day")).distinct()
    # grants that nobody asks for are folded neither by key nor by day
    wanted = grants.where(none_null(keys)).select(*keys, *GRANT)
    usable = between(wanted.join(asked.select(*keys).distinct(), keys, "left_semi"), "asked_grants")
    ends = F.coalesce(-F.unix_date("valid_to"), F.lit(2**31 - 1))
    record = F.struct(ends.alias("_ends"), *GRANT)
    per_key = usable.groupBy(*keys).agg(
        F.count("authorization_id").alias("authorization_match_count"), F.min(record).alias("_any")
    )
    approved = usable.where((F.col("authorization_status") == "APPROVED") & (F.col("valid_from") <= F.col("valid_to")))
    opened = approved.select(
        *keys, F.unix_date("valid_from").alias("_day"), F.lit(1).alias("_step"), record.alias("_open")
    )
    closed = approved.select(*keys, (F.unix_date("valid_to") + 1).alias("_day"), F.lit(-1).alias("_step"))
    per_day = (
        opened.unionByName(closed, allowMissingColumns=True)
        .unionByName(asked.withColumn("_asked", F.lit(1)), allowMissingColumns=True)
        .groupBy(*keys, "_day")
        .agg(F.sum("_step").alias("_step"), F.min("_open").alias("_open"), F.max("_asked").alias("_asked"))
    )
    so_far = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    valid = F.col("valid_authorization_count")
    # of all grants opened so far the one ending last is valid if any is, so the running minimum is the valid best
    answers = (
        per_day.withColumn("valid_authorization_count", F.coalesce(F.sum("_step").over(so_far), F.lit(0)))
        .withColumn("_best", F.min("_open").over(so_far))
        .where("_asked = 1")
        .join(per_key, keys, "left")
        .select(
            *keys,
            "_day",
            F.coalesce("authorization_match_count", F.lit(0)).alias("authorization_match_count"),
            valid,
            F.when(valid > 0, F.col("_best")).otherwise(F.col("_any")).alias("_grant"),
        )
    )
    joined = spread_join(requests.withColumn("_day", asked_day), answers, [*keys, "_day"])
    zero = F.lit(0).cast("long")
    return joined.select(
        *requests.columns,
        F.coalesce("authorization_match_count", zero).alias("authorization_match_count"),
        F.coalesce("valid_authorization_count", zero).alias("valid_authorization_count"),
        *[F.col(f"_grant.{c}").alias(c) for c in GRANT],
    )


def classify_authorization(df: DataFrame, needed: str, out: str = "authorization_result") -> DataFrame:
    """Add one of the priority codes; ``needed`` is null where none is required."""
    count, status = F.col("authorization_match_count"), F.col("authorization_status")
    result = (
        F.when(F.col(needed).isNull(), "NOT_REQUIRED")
        .when(count == 0, "MISSING")
        .when(count > 1, "AMBIGUOUS")
        .when(F.col("valid_authorization_count") > 0, "VALID")
        .when(status.isin("DENIED", "PENDING", "CANCELLED"), status)
        .when(status == "APPROVED", "EXPIRED")
        .otherwise("MISSING")
    )
    return df.withColumn(out, result)


def _rank(status: Column, order: Sequence[str]) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in order]), status)


def worst_status(status: Column, order: Sequence[str] = fv.AUTHORIZATION_PRIORITY) -> Column:
    """Aggregate: the status that stands first in ``order``; the rank is what is shuffled."""
    rank = F.min(F.when(status.isin(*order), _rank(status, order)))
    return F.get(F.array(*[F.lit(s) for s in order]), rank.cast("int") - 1)


def rollup_priority(
    df: DataFrame, key: list[str], status: str, order: Sequence[str] = fv.AUTHORIZATION_PRIORITY, out: str = "status"
) -> DataFrame:
    return df.groupBy(*key).agg(worst_status(F.col(status), order).alias(out))


def rollup_authorization(df: DataFrame, key: list[str]) -> DataFrame:
    """One row per record: authorized and missing codes, evidence, worst status."""
    code, result = F.col("procedure_code"), F.col("authorization_result")
    lacking = code.isNotNull() & ~result.isin("VALID", "NOT_REQUIRED")
    evidence = F.struct("procedure_code", "authorization_result", *GRANT, "valid_authorization_count")

    def collected(condition: Column, value: Column, name: str) -> Column:
        return F.sort_array(F.collect_list(F.when(condition, value))).alias(name)

    return df.groupBy(*key).agg(
        collected(result == "VALID", code, "authorized_procedure_codes"),
        collected(lacking, code, "missing_authorization_procedure_codes"),
        collected(code.isNotNull(), evidence, "authorization_evidence"),
        worst_status(result).alias("pre_authorization_status"),
    )
