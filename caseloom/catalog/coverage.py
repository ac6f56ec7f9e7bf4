"""Procedure lines of claims and what a plan pays for them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.catalog import Source, query
from caseloom.catalog.world import PLAN_COVERAGE, RAW, ctes, derive, raw_orders
from caseloom.catalog.orders import sql_amount, sql_codes
from caseloom.operators import coverage, rules, standardize
from caseloom.plans import claims


@query(
    "explode_lines",
    f"""WITH {RAW}, parsed AS (SELECT o_orderkey, {sql_codes('codes')} AS cds, {sql_amount('amount')} AS amt FROM raw),
      lines AS (SELECT o_orderkey, len(cds) AS n, amt, unnest(cds) AS code, generate_subscripts(cds, 1) - 1 AS i FROM parsed
        UNION ALL SELECT o_orderkey, 0, amt, NULL, NULL FROM parsed WHERE len(cds) = 0)
    SELECT o_orderkey, CAST(n AS INT) AS line_count, CAST(i AS INT) AS code_index, code,
      CASE WHEN n > 0 THEN CAST(round(amt / n, 4) AS DECIMAL(18,4)) END AS line_amount FROM lines""",
)
def explode_lines(src: Source) -> DataFrame:
    parsed = (
        raw_orders(src)
        .transform(standardize.parse_code_lists, ["codes"])
        .transform(standardize.parse_amounts, ["amount"])
        .select("o_orderkey", "amount_parsed", F.array_sort("codes_array").alias("codes_array"))
    )
    lines = coverage.explode_lines(parsed, "codes_array", "code", "code_index")
    return coverage.allocate_evenly(lines, "amount_parsed", "line_count", "line_amount").drop("amount_parsed")


def order_lines(src: Source) -> DataFrame:
    """Two procedure codes per order, some of which no plan covers."""
    k = F.col("o_orderkey")
    first, second = 70000 + k % 50, 70000 + (k * 7 + 3) % 60
    orders = src.orders.select(
        "o_orderkey",
        F.concat(F.lit("PLAN-"), (F.col("o_custkey") % 30).cast("string")).alias("plan_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("billed"),
        F.array_distinct(F.array(first.cast("string"), second.cast("string"))).alias("codes"),
    )
    lines = coverage.explode_lines(orders, "codes")
    return coverage.allocate_evenly(lines, "billed", "line_count", "procedure_billed_amount")


def covered_lines(src: Source) -> DataFrame:
    plans = claims.reduced_coverage(derive(src, PLAN_COVERAGE))
    on = {"plan_id": "plan_id", "procedure_code": "procedure_code"}
    return coverage.coverage_join(order_lines(src), plans, on)


COVERED = f"""{ctes('plan_coverage')}, plans AS (SELECT * FROM (SELECT *, row_number() OVER (
      PARTITION BY plan_id, procedure_code ORDER BY coverage_type, coverage_percentage, copay_amount,
        requires_pre_authorization DESC, deductible_amount) AS rn
      FROM w_plan_coverage) WHERE rn = 1),
  listed AS (SELECT o_orderkey, 'PLAN-' || CAST(o_custkey % 30 AS STRING) AS plan_id,
    CAST(o_totalprice AS DECIMAL(18,2)) AS billed, CAST(70000 + o_orderkey % 50 AS STRING) AS c1,
    CAST(70000 + (o_orderkey * 7 + 3) % 60 AS STRING) AS c2 FROM orders),
  ol AS (SELECT o_orderkey, plan_id, billed, CASE WHEN c1 = c2 THEN 1 ELSE 2 END AS n, c1 AS code FROM listed
    UNION ALL SELECT o_orderkey, plan_id, billed, 2, c2 FROM listed WHERE c1 <> c2),
  covered AS (SELECT o_orderkey, ol.plan_id, code AS procedure_code, plans.procedure_code IS NOT NULL AS found,
    coverage_type, coverage_percentage, deductible_amount, copay_amount, requires_pre_authorization,
    CAST(round(billed / n, 4) AS DECIMAL(18,4)) AS share,
    CASE WHEN plans.procedure_code IS NOT NULL THEN CAST(greatest(CAST(round(billed / n, 4) AS DECIMAL(18,4))
      * CAST(coverage_percentage AS DECIMAL(38,9)) - copay_amount, 0) AS DECIMAL(18,4)) END AS eligible
    FROM ol LEFT JOIN plans ON ol.plan_id = plans.plan_id AND ol.code = plans.procedure_code)"""


@query(
    "coverage_join",
    f"""WITH {COVERED} SELECT o_orderkey, plan_id, procedure_code, found AS coverage_found, coverage_type,
      coverage_percentage, deductible_amount, copay_amount, requires_pre_authorization,
      share AS procedure_billed_amount, eligible AS estimated_eligible_amount FROM covered""",
)
def coverage_join(src: Source) -> DataFrame:
    return covered_lines(src).select(
        "o_orderkey",
        "plan_id",
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


def rolled_up(src: Source) -> DataFrame:
    rolled = coverage.rollup_coverage(covered_lines(src), ["o_orderkey"])
    return rules.validate(rolled, coverage.coverage_rules(), "coverage_errors")


@query(
    "coverage_rollup",
    f"""WITH {COVERED} SELECT o_orderkey,
      coalesce(string_agg(procedure_code, '|' ORDER BY procedure_code) FILTER (found), '') AS covered_procedure_codes,
      coalesce(string_agg(procedure_code, '|' ORDER BY procedure_code) FILTER (NOT found), '') AS uncovered_procedure_codes,
      coalesce(string_agg(procedure_code, '|' ORDER BY procedure_code) FILTER (requires_pre_authorization), '')
        AS pre_auth_required_procedure_codes,
      string_agg(procedure_code || ':' || coalesce(CAST(eligible AS STRING), '-'), '|' ORDER BY procedure_code) AS evidence,
      CAST(sum(eligible) AS DECIMAL(18,2)) AS estimated_eligible_amount,
      CAST(count(*) FILTER (found) AS INT) AS covered_procedure_count,
      CAST(count(*) FILTER (NOT found) AS INT) AS uncovered_procedure_count,
      count(*) FILTER (NOT found) = 0 AND count(*) FILTER (found) > 0 AS all_procedures_have_coverage,
      CASE WHEN count(*) FILTER (NOT found) > 0 THEN 'PROCEDURE_NOT_COVERED' ELSE '' END AS coverage_errors
    FROM covered GROUP BY o_orderkey""",
)
def coverage_rollup(src: Source) -> DataFrame:
    line = F.transform(
        "coverage_evidence",
        lambda x: F.concat(
            x["procedure_code"],
            F.lit(":"),
            F.coalesce(x["estimated_eligible_amount"].cast("string"), F.lit("-")),
        ),
    )
    lists = (
        "covered_procedure_codes",
        "uncovered_procedure_codes",
        "pre_auth_required_procedure_codes",
        "coverage_errors",
    )
    return rolled_up(src).select(
        "o_orderkey",
        *[F.array_join(c, "|").alias(c) for c in lists],
        F.array_join(line, "|").alias("evidence"),
        "estimated_eligible_amount",
        "covered_procedure_count",
        "uncovered_procedure_count",
        "all_procedures_have_coverage",
    )
