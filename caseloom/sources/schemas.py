"""Explicit schemas: codes are strings, money is decimal, nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

OCR_COLUMNS = (
    "source_document_id",
    "claim_id",
    "policy_number",
    "member_first_name",
    "member_last_name",
    "member_dob",
    "provider_npi",
    "service_date",
    "admission_date",
    "discharge_date",
    "diagnosis_codes",
    "procedure_codes",
    "billed_amount",
    "currency",
    "ocr_confidence",
    "extracted_ssn",
    "extracted_notes",
    "expected_quality",
    "noise_type",
)


def all_strings(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "money": MONEY,
}


def _table(text: str) -> T.StructType:
    """Fields written as ``name type, name type``; needs no session, unlike DDL."""
    pairs = [field.split() for field in text.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


OCR_DOCUMENTS = all_strings(OCR_COLUMNS)
POLICY = _table(
    "policy_id string, policy_number string, member_id string, plan_id string, coverage_start_date date, "
    "coverage_end_date date, policy_status string, group_number string"
)
MEMBER = _table("member_id string, first_name string, last_name string, dob date, address string, state string")
PROVIDER = _table(
    "provider_id string, npi string, provider_name string, provider_type string, network_status string, "
    "state string, active_flag boolean"
)
PLAN_COVERAGE = _table(
    "plan_id string, procedure_code string, coverage_type string, coverage_percentage double, "
    "deductible_amount money, copay_amount money, requires_pre_authorization boolean"
)
CLAIM_HISTORY = _table(
    "historical_claim_id string, member_id string, provider_id string, procedure_code string, service_date date, "
    "claim_amount money, approved_amount money, claim_status string"
)
PRE_AUTHORIZATION = _table(
    "authorization_id string, member_id string, provider_id string, procedure_code string, valid_from date, "
    "valid_to date, authorization_status string"
)

INPUTS = {
    "ocr_documents": OCR_DOCUMENTS,
    "policy": POLICY,
    "member": MEMBER,
    "provider": PROVIDER,
    "plan_coverage": PLAN_COVERAGE,
    "claim_history": CLAIM_HISTORY,
    "pre_authorization": PRE_AUTHORIZATION,
}
