"""Inputs derived from the given tables, by SQL that Spark and DuckDB read alike.

Only the noisy inputs are made here; what the operators do with them is written
twice, once with the operators and once as the SQL of each query.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from caseloom.catalog import Source

_ISO = "CAST(CAST({0} AS DATE) AS STRING)"


def _date_forms(day: str) -> dict[str, str]:
    iso = _ISO.format(day)
    y, m, d = f"substr({iso}, 1, 4)", f"substr({iso}, 6, 2)", f"substr({iso}, 9, 2)"
    return {
        "iso": iso,
        "us": f"{m} || '/' || {d} || '/' || {y}",
        "slashed": f"{y} || '/' || {m} || '/' || {d}",
        "dashed": f"{d} || '-' || {m} || '-' || {y}",
        "short": f"{m} || '/' || {d} || '/' || substr({y}, 3, 2)",
    }


def _amount_forms(amount: str) -> dict[str, str]:
    plain = f"CAST(CAST({amount} AS DECIMAL(18,2)) AS STRING)"
    grouped = (
        f"CASE WHEN length({plain}) > 6 THEN substr({plain}, 1, length({plain}) - 6) || ',' || "
        f"substr({plain}, length({plain}) - 5) ELSE {plain} END"
    )
    return {
        "plain": plain,
        "dollar": f"'$ ' || {plain}",
        "comma": f"replace({plain}, '.', ',')",
        "grouped": grouped,
        "letter": f"replace({plain}, '0', 'O')",
        "minus": f"'-' || {plain}",
    }


_D = _date_forms("o_orderdate")
_A = _amount_forms("o_totalprice")

RAW_ORDERS = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
  CASE o_orderkey % 6 WHEN 0 THEN {_D['iso']} WHEN 1 THEN {_D['us']} WHEN 2 THEN {_D['slashed']}
    WHEN 3 THEN {_D['dashed']} WHEN 4 THEN {_D['short']} ELSE 'NULL' END AS order_date,
  CASE WHEN o_orderkey % 10 = 9 THEN NULL ELSE
    CASE o_orderkey % 7 WHEN 0 THEN {_A['plain']} WHEN 1 THEN {_A['dollar']} WHEN 2 THEN {_A['comma']}
      WHEN 3 THEN {_A['grouped']} WHEN 4 THEN {_A['letter']} WHEN 5 THEN {_A['minus']} ELSE 'n/a' END END AS amount,
  CASE o_orderkey % 5 WHEN 0 THEN ' ' || o_orderpriority || '; ' || o_orderstatus WHEN 1 THEN 'N/A' WHEN 2 THEN
    lower(o_orderpriority) || ',,' || o_orderstatus || '|' || upper(o_orderpriority)
    WHEN 3 THEN NULL ELSE o_orderstatus || chr(10) || 'X1' END AS codes,
  CASE o_orderkey % 8 WHEN 0 THEN chr(9) || ' pol-' || CAST(o_custkey AS STRING) || ' ' WHEN 1 THEN NULL
    WHEN 2 THEN '' WHEN 3 THEN 'P0L-' || CAST(o_custkey AS STRING) WHEN 4 THEN 'POL-1;POL-2'
    WHEN 5 THEN 'Policy_Number' ELSE 'POL-' || CAST(o_custkey AS STRING) END AS policy_number,
  CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN ' eur' WHEN 2 THEN 'usd ' ELSE 'USD' END AS currency,
  CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' ELSE
    ' ' || CAST(CAST((o_orderkey % 130) / 100.0 - 0.1 AS DECIMAL(5,2)) AS STRING) END AS confidence,
  CASE o_orderkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN ' FALSE ' WHEN 2 THEN 'maybe' ELSE NULL END AS flag,
  CASE WHEN o_orderkey % 19 = 0 THEN '123-45-' || lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0') END AS ssn
FROM {{orders}}
"""

# --- a claims world ----------------------------------------------------------------------------
_S = _date_forms("d + 20")
_B = _amount_forms("amt")
# one provider after the other, one number more than there are, so that some are unknown
_SUPPLIERS = "(SELECT max(s_suppkey) + 2 FROM {supplier})"
_NPI = f"CAST(9100000000 + k % {_SUPPLIERS} AS STRING)"
_CODE1 = "CAST(70000 + k % 50 AS STRING)"
_CODE2 = "CAST(70000 + (k * 7 + 3) % 60 AS STRING)"

OCR_DOCUMENTS = f"""
WITH scans AS (
  SELECT o_orderkey AS k, o_custkey AS ck, CAST(o_orderdate AS DATE) AS d,
    CAST(o_totalprice AS DECIMAL(18,2)) AS amt, 1 AS scan FROM {{orders}}
  UNION ALL
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE),
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 3 = 0 THEN 100 ELSE 0 END AS DECIMAL(18,2)), 2
  FROM {{orders}} WHERE o_orderpriority = '1-URGENT'
)
SELECT 'DOC-' || CAST(k AS STRING) || '-' || CAST(scan AS STRING) AS source_document_id,
  CASE WHEN k % 97 = 0 THEN NULL ELSE 'CLM-' || CAST(k AS STRING) END AS claim_id,
  CASE k % 11 WHEN 0 THEN NULL WHEN 1 THEN chr(9) || ' pol-' || CAST(ck AS STRING) || ' '
    WHEN 2 THEN 'P0L-' || CAST(ck AS STRING) WHEN 3 THEN 'POL-' || CAST(ck AS STRING) || '/POL-1'
    WHEN 4 THEN 'Policy_Number' ELSE 'POL-' || CAST(ck AS STRING) END AS policy_number,
  CASE WHEN k % 13 = 0 THEN '' ELSE ' first' || CAST(ck % 7 AS STRING) END AS member_first_name,
  CASE WHEN k % 37 = 0 THEN 'Patient Last Name' ELSE 'Customer#' || lpad(CAST(ck AS STRING), 9, '0') END
    AS member_last_name,
  CASE WHEN k % 31 = 0 THEN '01/19/82' ELSE {_ISO.format("DATE '1950-01-01' + CAST(ck % 15000 AS INT)")} END
    AS member_dob,
  CASE k % 9 WHEN 0 THEN NULL WHEN 1 THEN substr({_NPI}, 1, 3) || '-' || substr({_NPI}, 4) WHEN 2 THEN 'ABCDEFGHIJ'
    WHEN 3 THEN substr({_NPI}, 1, 6) WHEN 4 THEN {_NPI} || '/' || {_NPI} ELSE {_NPI} END AS provider_npi,
  CASE k % 12 WHEN 1 THEN {_S['us']} WHEN 2 THEN {_S['slashed']} WHEN 3 THEN {_S['dashed']}
    WHEN 4 THEN 'Date of Service' WHEN 5 THEN NULL WHEN 6 THEN '2026-19-44' ELSE {_S['iso']} END AS service_date,
  CASE k % 17 WHEN 0 THEN {_ISO.format('d + 25')} WHEN 1 THEN {_ISO.format('d + 21')}
    WHEN 2 THEN {_ISO.format('d + 19')} END AS admission_date,
  CASE k % 17 WHEN 0 THEN {_ISO.format('d + 22')} WHEN 1 THEN {_ISO.format('d + 25')}
    WHEN 2 THEN {_ISO.format('d + 21')} END AS discharge_date,
  CASE WHEN scan = 2 THEN 'Z00.0;e11.9' ELSE CASE k % 12 WHEN 0 THEN 'K219' WHEN 1 THEN 'E11.9, ; I25.10'
    WHEN 2 THEN 'N/A' ELSE 'E11.9|I25.10' END END AS diagnosis_codes,
  CASE k % 14 WHEN 0 THEN NULL WHEN 1 THEN '7' WHEN 2 THEN {_CODE1} || ', ; ' || {_CODE2}
    WHEN 3 THEN {_CODE1} || chr(10) || {_CODE2} ELSE {_CODE1} || '|' || {_CODE2} END AS procedure_codes,
  CASE k % 8 WHEN 1 THEN {_B['dollar']} WHEN 2 THEN {_B['comma']} WHEN 3 THEN {_B['grouped']}
    WHEN 4 THEN {_B['letter']} WHEN 5 THEN {_B['minus']} ELSE {_B['plain']} END AS billed_amount,
  CASE k % 23 WHEN 0 THEN 'eur' WHEN 1 THEN NULL ELSE ' usd' END AS currency,
  CASE WHEN k % 29 = 0 THEN 'n/a' ELSE CAST(CAST((60 + (k * scan) % 45) / 100.0 AS DECIMAL(4,2)) AS STRING) END
    AS ocr_confidence,
  CASE WHEN k % 19 = 0 THEN '123-45-' || lpad(CAST(k % 10000 AS STRING), 4, '0') END AS extracted_ssn,
  CASE k % 19 WHEN 0 THEN 'SSN 123-45-' || lpad(CAST(k % 10000 AS STRING), 4, '0') || ' call (212) 555-' ||
    lpad(CAST(k % 10000 AS STRING), 4, '0') || ' now' WHEN 1 THEN 'Unreadable blank scan' WHEN 2 THEN NULL
    ELSE 'Clean OCR extraction' END AS extracted_notes,
  'GOOD' AS expected_quality, 'NONE' AS noise_type
FROM scans
"""

POLICY = """
SELECT 'P-' || CAST(c_custkey AS STRING) || '-1' AS policy_id, 'POL-' || CAST(c_custkey AS STRING) AS policy_number,
  'M-' || CAST(c_custkey AS STRING) AS member_id, 'PLAN-' || CAST(c_custkey % 30 AS STRING) AS plan_id,
  DATE '1995-01-01' AS coverage_start_date, DATE '1998-12-31' AS coverage_end_date,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'TERMINATED' WHEN 'MACHINERY' THEN 'inactive ' ELSE 'ACTIVE' END
    AS policy_status, 'G' AS group_number
FROM {customer}
UNION ALL
SELECT 'P-' || CAST(c_custkey AS STRING) || '-2', ' pol-' || CAST(c_custkey AS STRING),
  'M-' || CAST(c_custkey AS STRING), 'PLAN-' || CAST(c_custkey % 30 AS STRING), DATE '1992-01-01', DATE '2000-12-31',
  'Active', 'G' FROM {customer} WHERE c_nationkey = 3
"""

MEMBER = """
SELECT CASE WHEN c_nationkey = 5 THEN 'MX-' ELSE 'M-' END || CAST(c_custkey AS STRING) AS member_id,
  'First' || CAST(c_custkey % 7 AS STRING) AS first_name, c_name AS last_name,
  DATE '1950-01-01' + CAST(c_custkey % 15000 AS INT) AS dob, 'street' AS address, 'NV' AS state
FROM {customer}
"""

PROVIDER = """
SELECT 'PR-' || CAST(s_suppkey AS STRING) AS provider_id,
  CASE WHEN s_nationkey = 2 THEN 'ABCDEFGHIJ'
    ELSE '910-' || substr(CAST(9100000000 + CASE WHEN s_suppkey % 10 = 9 THEN s_suppkey - 1 ELSE s_suppkey END AS STRING), 4)
    END AS npi,
  s_name AS provider_name, 'FACILITY' AS provider_type,
  CASE s_nationkey % 3 WHEN 0 THEN 'in_network' WHEN 1 THEN ' OUT_OF_NETWORK' ELSE 'UNKNOWN' END AS network_status,
  'NV' AS state, s_acctbal > 0 AS active_flag
FROM {supplier}
"""

PLAN_COVERAGE = """
SELECT 'PLAN-' || CAST(p_size % 25 AS STRING) AS plan_id, CAST(70000 + p_partkey % 50 AS STRING) AS procedure_code,
  p_type AS coverage_type, (50 + p_partkey % 50) / CAST(100 AS DOUBLE) AS coverage_percentage,
  CAST(250 AS DECIMAL(18,2)) AS deductible_amount, CAST((p_partkey % 5) * 10 AS DECIMAL(18,2)) AS copay_amount,
  p_partkey % 3 = 0 AS requires_pre_authorization
FROM {part}
"""

CLAIM_HISTORY = f"""
WITH past AS (
  SELECT 'H-' || CAST(o_orderkey AS STRING) AS historical_claim_id, 'M-' || CAST(o_custkey AS STRING) AS member_id,
    'PR-' || CAST(o_orderkey % {_SUPPLIERS} AS STRING) AS provider_id,
    CAST(70000 + o_orderkey % 50 AS STRING) AS procedure_code, CAST(o_orderdate AS DATE) AS service_date,
    CAST(FLOOR(CAST(o_totalprice AS DECIMAL(18,2)) * 50) / 100 AS DECIMAL(18,2)) AS claim_amount,
    CAST(0 AS DECIMAL(18,2)) AS approved_amount, o_orderstatus AS claim_status, o_orderpriority, o_orderkey AS k
  FROM {{orders}}
)
SELECT historical_claim_id, member_id, provider_id, procedure_code, service_date, claim_amount, approved_amount,
  claim_status FROM past
UNION ALL
SELECT historical_claim_id, member_id, provider_id, procedure_code, service_date, claim_amount, approved_amount,
  claim_status FROM past WHERE o_orderpriority = '5-LOW'
UNION ALL -- further lines of a claim: another procedure, another amount, another day
SELECT historical_claim_id, member_id, provider_id, CAST(70000 + (k * 7 + 3) % 60 AS STRING), service_date,
  claim_amount, approved_amount, claim_status FROM past WHERE k % 3 = 0
UNION ALL
SELECT historical_claim_id, member_id, provider_id, procedure_code, service_date,
  CAST(claim_amount * 1.01 AS DECIMAL(18,2)), approved_amount, claim_status FROM past WHERE k % 5 = 0
UNION ALL
SELECT historical_claim_id, member_id, provider_id, procedure_code, service_date + 2,
  claim_amount, approved_amount, claim_status FROM past WHERE k % 7 = 0
UNION ALL -- lines without a claim id
SELECT NULL, member_id, provider_id, procedure_code, service_date, claim_amount, approved_amount, claim_status
FROM past WHERE k % 11 = 0
"""

PRE_AUTHORIZATION = f"""
SELECT 'AUTH-' || CAST(o_orderkey AS STRING) AS authorization_id, 'M-' || CAST(o_custkey AS STRING) AS member_id,
  'PR-' || CAST(o_orderkey % {_SUPPLIERS} AS STRING) AS provider_id,
  CASE WHEN o_orderkey % 8 = 7 THEN '70099' ELSE CAST(70000 + o_orderkey % 50 AS STRING) END AS procedure_code,
  CAST(o_orderdate AS DATE) - CASE WHEN o_orderkey % 5 = 0 THEN 400 ELSE 30 END AS valid_from,
  CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 5 = 0 THEN -100 ELSE 300 END AS valid_to,
  CASE o_orderkey % 7 WHEN 0 THEN 'DENIED' WHEN 1 THEN 'pending' WHEN 2 THEN 'CANCELLED' ELSE 'Approved ' END
    AS authorization_status
FROM {{orders}}
UNION ALL
SELECT 'AUTH-' || CAST(o_orderkey AS STRING) || '-B', 'M-' || CAST(o_custkey AS STRING),
  'PR-' || CAST(o_orderkey % {_SUPPLIERS} AS STRING), CAST(70000 + o_orderkey % 50 AS STRING),
  CAST(o_orderdate AS DATE) + 10, CAST(NULL AS DATE), 'APPROVED'
FROM {{orders}} WHERE o_orderpriority = '2-HIGH'
"""

CLAIM_WORLD = {
    "ocr_documents": OCR_DOCUMENTS,
    "policy": POLICY,
    "member": MEMBER,
    "provider": PROVIDER,
    "plan_coverage": PLAN_COVERAGE,
    "claim_history": CLAIM_HISTORY,
    "pre_authorization": PRE_AUTHORIZATION,
}


def derive(src: Source, text: str, **given: DataFrame) -> DataFrame:
    """Run a derivation in Spark over the tables it names, those ``given`` in place of the source's."""
    return src.spark.sql(text, **{t: given.get(t, getattr(src, t)) for t in set(re.findall(r"{(\w+)}", text))})


def plain(text: str) -> str:
    """The same derivation as DuckDB text."""
    return re.sub(r"{(\w+)}", r"\1", text)


def ctes(*names: str) -> str:
    """``name AS (...)`` for the named world tables."""
    return ",\n".join(f"w_{n} AS ({plain(CLAIM_WORLD[n])})" for n in names)


RAW = f"raw AS ({plain(RAW_ORDERS)})"


def raw_orders(src: Source) -> DataFrame:
    return derive(src, RAW_ORDERS)


def claim_world(src: Source) -> dict[str, DataFrame]:
    """The derived inputs."""
    return {name: derive(src, text) for name, text in CLAIM_WORLD.items()}
