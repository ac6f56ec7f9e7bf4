"""Per-line coverage: explode code lists, price each line, roll up to the record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions import parsing as p
from caseloom.operators.lookup import lookup
from caseloom.operators.rules import Rule

SHARE = "decimal(18,4)"
RATE = "decimal(18,9)"


def explode_lines(
    df: DataFrame, array_col: str, value: str = "procedure_code", index: str = "procedure_index"
) -> DataFrame:
    """One row per array element with its position and the element count.

    An empty or null array keeps its row, with null position and value.
    """
    count = F.size(F.coalesce(F.col(array_col), F.array()))
    return df.select("*", count.alias("line_count"), F.posexplode_outer(array_col).alias(index, value)).drop(array_col)


def allocate_evenly(lines: DataFrame, amount: str, count: str, out: str) -> DataFrame:
    """Split a record's amount over its lines; null where there are no lines."""
    share = F.when(F.col(count) > 0, F.col(amount).cast(p.MONEY) / F.col(count))
    return lines.withColumn(out, share.cast(SHARE))


def eligible_amount(found: Column, billed: Column, rate: Column, copay: Column) -> Column:
    """max(0, billed * rate - copay) of a covered line; unknown billed stays unknown."""
    due = billed * rate - copay
    return F.when(found & due.isNotNull(), F.greatest(due, F.lit(0).cast(p.MONEY)))


def coverage_join(lines: DataFrame, plans: DataFrame, on: dict[str, str]) -> DataFrame:
    """Add each line's coverage terms and estimated eligible amount."""
    priced = lookup(lines, plans, on, "coverage_match_count", "coverage").drop(
        "coverage_match_count", "coverage_ambiguous"
    )
    found = F.col("coverage_exists")
    due = eligible_amount(
        found,
        F.col("procedure_billed_amount"),
        F.col("coverage_percentage").cast(RATE),
        F.col("copay_amount").cast(p.MONEY),
    )
    return priced.withColumn("estimated_eligible_amount", due.cast("decimal(18,4)")).withColumnRenamed(
        "coverage_exists", "coverage_found"
    )


def rollup_coverage(lines: DataFrame, key: list[str]) -> DataFrame:
    """Back to one row per record: code lists, line evidence, counts, total.

    Lines hold each code of a record once, so the lists are as long as the
    record's own list of codes.
    """
    has = F.col("procedure_code").isNotNull()
    covered, uncovered = has & F.col("coverage_found"), has & ~F.col("coverage_found")
    evidence = F.struct(
        "procedure_code",
        "coverage_found",
        "coverage_type",
        "coverage_percentage",
        "deductible_amount",
        "copay_amount",
        "requires_pre_authorization",
        "procedure_billed_amount",
        "estimated_eligible_amount",
    )

    def collected(condition: Column, value: Column, name: str) -> Column:
        return F.sort_array(F.collect_list(F.when(condition, value))).alias(name)

    code = F.col("procedure_code")
    return (
        lines.groupBy(*key)
        .agg(
            collected(covered, code, "covered_procedure_codes"),
            collected(uncovered, code, "uncovered_procedure_codes"),
            collected(covered & F.col("requires_pre_authorization"), code, "pre_auth_required_procedure_codes"),
            collected(has, evidence, "coverage_evidence"),
            F.sum("estimated_eligible_amount").cast(p.MONEY).alias("estimated_eligible_amount"),
            F.count_if(covered).cast("int").alias("covered_procedure_count"),
            F.count_if(uncovered).cast("int").alias("uncovered_procedure_count"),
        )
        .withColumn(
            "all_procedures_have_coverage",
            (F.col("uncovered_procedure_count") == 0) & (F.col("covered_procedure_count") > 0),
        )
    )


def coverage_rules() -> list[Rule]:
    return [Rule("PROCEDURE_NOT_COVERED", F.col("uncovered_procedure_count") > 0)]
