"""Standardisation, validation and row hashes over noisy renderings of orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.catalog import Source, query
from caseloom.catalog.world import RAW, raw_orders
from caseloom.functions import parsing as p
from caseloom.operators import rules, standardize
from caseloom.operators.rules import Rule
from caseloom.sources.tables import row_hash


def joined(name: str):
    return F.array_join(name, "|").alias(name)


# --- SQL of the tolerant parsers: every format is guarded by its exact shape ---------------------
def sql_date(c: str) -> str:
    forms = (
        (r"\d{4}-\d{2}-\d{2}", "%Y-%m-%d"),
        (r"\d{2}/\d{2}/\d{4}", "%m/%d/%Y"),
        (r"\d{4}/\d{2}/\d{2}", "%Y/%m/%d"),
        (r"\d{2}-\d{2}-\d{4}", "%d-%m-%Y"),
    )
    tries = [
        f"CASE WHEN regexp_full_match(trim({c}), '{rx}') THEN CAST(try_strptime(trim({c}), '{f}') AS DATE) END"
        for rx, f in forms
    ]
    return f"coalesce({', '.join(tries)})"


def sql_amount_shape(c: str) -> str:
    bare = f"regexp_replace(trim({c}), '[$€£\\s]', '', 'g')"
    return (
        f"CASE WHEN {c} IS NULL THEN 'NULL_INPUT' WHEN regexp_full_match({bare}, '-?\\d+,\\d{{2}}') THEN 'DECIMAL_COMMA' "
        f"WHEN regexp_full_match({bare}, '-?\\d{{1,3}}(,\\d{{3}})+(\\.\\d+)?') THEN 'THOUSANDS' "
        f"WHEN regexp_full_match({bare}, '-?\\d+(\\.\\d+)?') THEN 'PLAIN' ELSE 'UNPARSED' END"
    )


def sql_amount(c: str) -> str:
    bare = f"regexp_replace(trim({c}), '[$€£\\s]', '', 'g')"
    shape = sql_amount_shape(c)
    return (
        f"TRY_CAST(CASE {shape} WHEN 'DECIMAL_COMMA' THEN replace({bare}, ',', '.') "
        f"WHEN 'THOUSANDS' THEN replace({bare}, ',', '') WHEN 'PLAIN' THEN {bare} END AS DECIMAL(18,2))"
    )


def sql_codes(c: str) -> str:
    text = f"upper(trim(coalesce({c}, '')))"
    text = f"CASE WHEN {text} IN ('N/A', 'NA', 'NULL', 'NONE') THEN '' ELSE {text} END"
    parts = f"string_split(regexp_replace({text}, '[;,\\r\\n]+', '|', 'g'), '|')"
    return f"list_sort(list_distinct([trim(x) FOR x IN {parts} IF trim(x) <> '']))"


def sql_tidy(c: str) -> str:
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


# --- queries -----------------------------------------------------------------------------------------
@query(
    "standardize_text",
    f"""WITH noisy AS (SELECT c_custkey, chr(9) || lower(c_name) || '  x ' || chr(10) || c_mktsegment || ' ' AS label,
      c_name AS npi, c_mktsegment AS segment FROM customer)
    SELECT c_custkey, label, upper({sql_tidy('label')}) AS label_normalized, {sql_tidy('segment')} AS segment_normalized,
      nullif(regexp_replace(npi, '[^0-9]', '', 'g'), '') AS npi_digits,
      nullif(regexp_replace(segment, '[^0-9]', '', 'g'), '') AS segment_digits FROM noisy""",
)
def standardize_text(src: Source) -> DataFrame:
    noisy = src.customer.select(
        "c_custkey",
        F.concat(F.lit("\t"), F.lower("c_name"), F.lit("  x \n"), "c_mktsegment", F.lit(" ")).alias("label"),
        F.col("c_name").alias("npi"),
        F.col("c_mktsegment").alias("segment"),
    )
    out = standardize.standardize_text(noisy, {"label": True, "segment": False})
    return standardize.digits_only(out, ["npi", "segment"], "_digits").drop("npi", "segment")


@query("parse_dates", f"WITH {RAW} SELECT o_orderkey, order_date, {sql_date('order_date')} AS order_date_parsed FROM raw")
def parse_dates(src: Source) -> DataFrame:
    return standardize.parse_dates(raw_orders(src).select("o_orderkey", "order_date"), ["order_date"])


@query("parse_amounts", f"WITH {RAW} SELECT o_orderkey, amount, {sql_amount('amount')} AS amount_parsed FROM raw")
def parse_amounts(src: Source) -> DataFrame:
    return standardize.parse_amounts(raw_orders(src).select("o_orderkey", "amount"), ["amount"])


@query(
    "parse_codes",
    f"""WITH {RAW} SELECT o_orderkey, array_to_string({sql_codes('codes')}, '|') AS codes_array,
      CAST(len({sql_codes('codes')}) AS INT) AS code_count FROM raw""",
)
def parse_codes(src: Source) -> DataFrame:
    parsed = standardize.parse_code_lists(raw_orders(src).select("o_orderkey", "codes"), ["codes"])
    return parsed.select(
        "o_orderkey",
        F.array_join(F.array_sort("codes_array"), "|").alias("codes_array"),
        F.size("codes_array").alias("code_count"),
    )


@query(
    "standardize_enums",
    f"""WITH {RAW} SELECT o_orderkey, upper(trim(currency)) AS currency, TRY_CAST(trim(confidence) AS DOUBLE) AS confidence,
      CASE lower(trim(flag)) WHEN 'true' THEN true WHEN 'false' THEN false END AS flag,
      CASE WHEN regexp_full_match(trim(order_date), '\\d{{4}}-\\d{{2}}-\\d{{2}}')
        THEN TRY_CAST(trim(order_date) AS DATE) END AS order_date FROM raw""",
)
def standardize_enums(src: Source) -> DataFrame:
    raw = raw_orders(src).select("o_orderkey", "currency", "confidence", "flag", "order_date")
    return standardize.standardize_enums(raw, ["currency"], ["confidence"], ["flag"], ["order_date"])


@query(
    "warnings",
    f"""WITH {RAW} SELECT o_orderkey, concat_ws('|',
      CASE WHEN policy_number <> regexp_replace(policy_number, '[^0-9]', '', 'g') THEN 'POLICY_PUNCTUATION_NORMALIZED' END,
      CASE WHEN regexp_matches(codes, '[;,]') THEN 'CODE_DELIMITER_NORMALIZED' END,
      CASE WHEN contains(amount, ',') THEN 'AMOUNT_COMMA_INTERPRETED' END) AS normalization_warnings FROM raw""",
)
def warnings(src: Source) -> DataFrame:
    raw = raw_orders(src)
    fired = {
        "POLICY_PUNCTUATION_NORMALIZED": F.col("policy_number")
        != F.coalesce(p.digits(F.col("policy_number")), F.lit("")),
        "CODE_DELIMITER_NORMALIZED": F.col("codes").rlike("[;,]"),
        "AMOUNT_COMMA_INTERPRETED": F.contains("amount", F.lit(",")),
    }
    return standardize.with_warnings(raw, fired).select("o_orderkey", joined("normalization_warnings"))


def checked_orders(src: Source) -> DataFrame:
    raw = raw_orders(src)
    clean = (
        raw.transform(standardize.standardize_text, {"policy_number": True})
        .transform(standardize.parse_dates, ["order_date"])
        .transform(standardize.parse_amounts, ["amount"])
        .transform(standardize.parse_code_lists, ["codes"])
        .transform(standardize.standardize_enums, ["currency"], ["confidence"], ["flag"])
    )
    c = F.col
    policy, confidence = c("policy_number_normalized"), c("confidence")
    required = {
        "policy_number": p.blank(policy),
        "codes": F.size("codes_array") == 0,
        "currency": p.blank(c("currency")),
        "amount": p.blank(c("amount")),
    }
    order_rules = [
        Rule("MISSING_POLICY_NUMBER", p.blank(policy)),
        Rule("INVALID_POLICY_NUMBER", ~policy.rlike(fv.POLICY_NUMBER_PATTERN)),
        Rule("INVALID_ORDER_DATE", c("order_date").isNotNull() & c("order_date_parsed").isNull()),
        Rule("MISSING_CODES", F.size("codes_array") == 0),
        Rule("INVALID_CODE", F.exists("codes_array", lambda x: ~x.rlike("^[A-Z0-9]+$"))),
        Rule("INVALID_AMOUNT", c("amount").isNotNull() & c("amount_parsed").isNull()),
        Rule("NEGATIVE_AMOUNT", c("amount_parsed") < 0),
        Rule("UNSUPPORTED_CURRENCY", ~c("currency").isin(*fv.SUPPORTED_CURRENCIES)),
        Rule("INVALID_CONFIDENCE", ~F.coalesce(confidence.between(0, 1), F.lit(False))),
        Rule("LOW_CONFIDENCE", confidence < fv.MIN_CONFIDENCE),
        Rule("HEADER_TEXT_EXTRACTED_AS_VALUE", policy.isin(*fv.HEADER_LABELS)),
        Rule("SEVERAL_VALUES", c("policy_number").rlike(fv.SEVERAL_VALUES_PATTERN)),
    ]
    return clean.transform(rules.missing_fields, required).transform(
        rules.validate, order_rules, valid_flag="is_valid_record"
    )


_POLICY = f"upper({sql_tidy('policy_number')})"
_CONF = "TRY_CAST(trim(confidence) AS DOUBLE)"
CHECKED = f"""{RAW}, parsed AS (SELECT *, {_POLICY} AS pol, {sql_date('order_date')} AS dt, {sql_amount('amount')} AS amt,
  {sql_codes('codes')} AS cds, upper(trim(currency)) AS cur, {_CONF} AS conf FROM raw),
checked AS (SELECT *, concat_ws('|', CASE WHEN coalesce(pol, '') = '' THEN 'policy_number' END,
    CASE WHEN len(cds) = 0 THEN 'codes' END, CASE WHEN coalesce(cur, '') = '' THEN 'currency' END,
    CASE WHEN coalesce(trim(amount), '') = '' THEN 'amount' END) AS missing,
  [x FOR x IN [CASE WHEN coalesce(pol, '') = '' THEN 'MISSING_POLICY_NUMBER' END,
    CASE WHEN NOT regexp_full_match(pol, 'POL-\\d+') THEN 'INVALID_POLICY_NUMBER' END,
    CASE WHEN order_date IS NOT NULL AND dt IS NULL THEN 'INVALID_ORDER_DATE' END,
    CASE WHEN len(cds) = 0 THEN 'MISSING_CODES' END,
    CASE WHEN len([c FOR c IN cds IF NOT regexp_full_match(c, '[A-Z0-9]+')]) > 0 THEN 'INVALID_CODE' END,
    CASE WHEN amount IS NOT NULL AND amt IS NULL THEN 'INVALID_AMOUNT' END,
    CASE WHEN amt < 0 THEN 'NEGATIVE_AMOUNT' END, CASE WHEN cur <> 'USD' THEN 'UNSUPPORTED_CURRENCY' END,
    CASE WHEN conf IS NULL OR conf < 0 OR conf > 1 THEN 'INVALID_CONFIDENCE' END,
    CASE WHEN conf < 0.75 THEN 'LOW_CONFIDENCE' END,
    CASE WHEN pol IN ('POLICY_NUMBER', 'PATIENT LAST NAME', 'PATIENT FIRST NAME', 'DATE OF SERVICE')
      THEN 'HEADER_TEXT_EXTRACTED_AS_VALUE' END,
    CASE WHEN regexp_matches(policy_number, '[|;,/]') THEN 'SEVERAL_VALUES' END] IF x IS NOT NULL] AS errors FROM parsed)"""


@query("missing_fields", f"WITH {CHECKED} SELECT o_orderkey, missing AS missing_fields FROM checked")
def missing_fields(src: Source) -> DataFrame:
    return checked_orders(src).select("o_orderkey", joined("missing_fields"))


@query(
    "validate_orders",
    f"""WITH {CHECKED} SELECT o_orderkey, array_to_string(errors, '|') AS validation_errors,
      len(errors) = 0 AS is_valid_record FROM checked""",
)
def validate_orders(src: Source) -> DataFrame:
    return checked_orders(src).select("o_orderkey", joined("validation_errors"), "is_valid_record")


@query(
    "rule_counts",
    f"""WITH {CHECKED} SELECT o_orderstatus, code, count(*) AS row_count
      FROM (SELECT o_orderstatus, unnest(errors) AS code FROM checked) GROUP BY ALL""",
)
def rule_counts(src: Source) -> DataFrame:
    return rules.code_counts(checked_orders(src), "validation_errors", ["o_orderstatus"])


@query(
    "parse_profile",
    f"""WITH {RAW}, seen AS (SELECT 'order_date' AS column_name, CASE WHEN order_date IS NULL THEN 'NULL_INPUT'
      WHEN {sql_date('order_date')} IS NULL THEN 'UNPARSED'
      WHEN regexp_full_match(trim(order_date), '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN 'yyyy-MM-dd'
      WHEN regexp_full_match(trim(order_date), '\\d{{2}}/\\d{{2}}/\\d{{4}}') THEN 'MM/dd/yyyy'
      WHEN regexp_full_match(trim(order_date), '\\d{{4}}/\\d{{2}}/\\d{{2}}') THEN 'yyyy/MM/dd' ELSE 'dd-MM-yyyy' END
      AS outcome FROM raw UNION ALL SELECT 'amount', {sql_amount_shape('amount')} FROM raw)
    SELECT column_name, outcome, count(*) AS row_count, outcome NOT IN ('NULL_INPUT', 'UNPARSED') AS parsed
    FROM seen GROUP BY ALL""",
)
def parse_profile(src: Source) -> DataFrame:
    return standardize.profile_parses(raw_orders(src), ["order_date"], ["amount"])


_HASHED = ("o_orderkey", "o_custkey", "o_orderstatus", "amount", "policy_number")


@query(
    "raw_hash",
    f"""WITH {RAW} SELECT o_orderkey, sha256(concat_ws('||', {', '.join(
        f"coalesce(CAST({c} AS STRING), chr(0))" for c in _HASHED)})) AS record_hash FROM raw""",
)
def raw_hash(src: Source) -> DataFrame:
    return raw_orders(src).select("o_orderkey", row_hash(_HASHED).alias("record_hash"))


@query(
    "pii_hash",
    f"""WITH {RAW} SELECT o_orderkey, ssn IS NOT NULL AS pii_detected, CASE WHEN ssn IS NOT NULL THEN
      sha256('pepper|' || CAST(o_orderkey AS STRING) || '|' || ssn) END AS pii_hash FROM raw""",
)
def pii_hash(src: Source) -> DataFrame:
    from caseloom.operators import pii

    found = pii.detect_pii(raw_orders(src), {"SSN_FIELD": "ssn"}, {})
    hashed = pii.pii_hash(found, ["o_orderkey", "ssn"], salt="pepper")
    return pii.drop_sensitive(hashed, ["ssn"]).select("o_orderkey", "pii_detected", "pii_hash")
