"""Assemble the case record: reasons, evidence, workflow status, final columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions import parsing as p
from caseloom.operators.rules import Rule, code_counts


def claim_reason_rules() -> list[Rule]:
    """Reasons derived from the flags of a claim, in the order they are listed."""
    c = F.col

    def failed(*codes: str) -> Column:
        return F.arrays_overlap("validation_errors", F.array(*[F.lit(x) for x in codes]))

    authorization = ("MISSING", "EXPIRED", "PENDING", "DENIED", "AMBIGUOUS", "CANCELLED")
    return [
        Rule("OCR_REQUIRED_FIELD_MISSING", F.size("missing_fields") > 0),
        Rule("OCR_LOW_CONFIDENCE", failed("LOW_OCR_CONFIDENCE")),
        Rule("OCR_UNREADABLE_DOCUMENT", failed("UNREADABLE_DOCUMENT")),
        Rule("OCR_CROSS_DOCUMENT_CONFLICT", c("cross_document_conflict")),
        Rule("INVALID_BILLED_AMOUNT", failed("INVALID_BILLED_AMOUNT", "NEGATIVE_BILLED_AMOUNT")),
        Rule(
            "INVALID_SERVICE_DATE",
            failed("INVALID_SERVICE_DATE", "SERVICE_DATE_OUTSIDE_STAY", "ADMISSION_AFTER_DISCHARGE"),
        ),
        *[Rule(f"PRE_AUTHORIZATION_{s}", c("pre_authorization_status") == s) for s in authorization],
        Rule("LIKELY_DUPLICATE_CLAIM", c("duplicate_claim_flag")),
    ]


def review_reasons(
    df: DataFrame, derived: Sequence[Rule], error_lists: Sequence[str], out: str = "review_reasons"
) -> DataFrame:
    """Add the distinct union of the derived reasons and the given error arrays."""
    empty = F.array().cast("array<string>")
    parts = [p.codes_when(derived)] + [F.coalesce(F.col(e), empty) for e in error_lists]
    return df.withColumn(out, F.array_distinct(F.flatten(F.array(*parts))))


def workflow_status(df: DataFrame, reasons: str = "review_reasons") -> DataFrame:
    """Add review flag, workflow status (never a decision) and its explanation."""
    due = F.size(reasons) > 0
    text = F.concat(F.lit(fv.REVIEW_PREFIX), F.array_join(reasons, "; "))
    return df.withColumns(
        {
            "review_required": due,
            "workflow_status": F.when(due, fv.STATUS_REVIEW).otherwise(fv.STATUS_COMPLETE),
            "decision_reason": F.when(due, text).otherwise(fv.NO_REVIEW_TEXT),
        }
    )


def evidence_package(df: DataFrame, parts: dict[str, Sequence[str] | str], out: str = "evidence_package") -> DataFrame:
    """Add one nested struct; a part is a list of columns or the name of one column."""
    fields = [
        (F.col(cols) if isinstance(cols, str) else F.struct(*cols)).alias(name) for name, cols in parts.items()
    ]
    return df.withColumn(out, F.struct(*fields))


CLAIM_EVIDENCE: dict[str, Sequence[str] | str] = {
    "data_quality_evidence": (
        "validation_errors",
        "normalization_warnings",
        "missing_fields",
        "pii_detected",
        "pii_types",
        "duplicate_document_flag",
        "cross_document_conflict",
        "cross_document_conflict_fields",
        "document_count",
        "selected_ocr_confidence",
        "max_ocr_confidence",
        "avg_ocr_confidence",
    ),
    "policy_evidence": (
        "policy_exists",
        "policy_ambiguous",
        "policy_match_count",
        "policy_status",
        "coverage_start_date",
        "coverage_end_date",
        "policy_active_on_service_date",
    ),
    "member_evidence": (
        "member_exists",
        "first_name_match",
        "last_name_match",
        "dob_match",
        "entity_match_confidence",
        "member_eligible",
    ),
    "provider_evidence": (
        "provider_exists",
        "provider_ambiguous",
        "provider_active",
        "provider_network_status",
        "provider_match_count",
    ),
    "coverage_evidence": "coverage_evidence",
    "historical_evidence": "historical_evidence",
    "authorization_evidence": "authorization_evidence",
}


def build_case(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Project to the case table: ``columns`` maps each output name to its source.

    Adds the case id, the always-null approved amount and the rule version.
    Run times are added where the table is written, see ``sources.tables``.
    """
    return df.select(
        F.concat(F.lit("CASE-"), F.col(key).cast("string")).alias("case_id"),
        *[F.col(src).alias(name) for name, src in columns.items()],
        F.lit(None).cast(p.MONEY).alias("approved_amount"),
        F.lit(fv.RULE_ENGINE_VERSION).alias("rule_engine_version"),
    )


def reason_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cases per review reason."""
    return code_counts(df, "review_reasons", by, name="reason")
