"""The whole claims flow on the noise corpus, with every invariant."""

import contextlib
import io
import json
import re

import pytest
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.operators import audit
from caseloom.plans import claims
from caseloom.sources import tables
from caseloom.sources.lineage import bucketed, cut
from caseloom.sources.schemas import INPUTS, OCR_COLUMNS
from claim_fixture import NOISE, claim_inputs, document, duplicate_documents, noise_documents


def by_claim(df):
    return {r["claim_id"]: r for r in df.collect()}


@pytest.fixture(scope="module")
def inputs(spark):
    return claim_inputs(spark)


@pytest.fixture(scope="module")
def stages(spark, inputs):
    return {name: cut(table, name) for name, table in claims.claim_stages(inputs, cut)}


@pytest.mark.parametrize("label", list(NOISE))
def test_noise_label_raises_its_errors(stages, label):
    found = by_claim(stages["canonical_claims"].where(F.col("claim_id") == f"CLM-{label}"))
    assert set(found[f"CLM-{label}"]["validation_errors"]) == NOISE[label][1]


def test_standardised_values(stages):
    c = by_claim(stages["canonical_claims"])
    assert c["CLM-WHITESPACE_NOISE"]["policy_number_normalized"] == "POL-100001"
    assert c["CLM-NPI_PUNCTUATION"]["provider_npi_normalized"] == "9100000008"
    assert c["CLM-NPI_WITHOUT_DIGITS"]["provider_npi_normalized"] is None
    assert str(c["CLM-AMOUNT_COMMA_DECIMAL"]["billed_amount_parsed"]) == "373.75"
    assert str(c["CLM-AMOUNT_THOUSANDS"]["billed_amount_parsed"]) == "1373.75"
    assert c["CLM-BROKEN_CODE_DELIMITER"]["procedure_codes"] == ["70002", "70003"]
    assert c["CLM-LINE_BREAK_ARTIFACT"]["procedure_codes"] == ["70002", "70003"]
    assert c["CLM-NPI_SPACES"]["normalization_warnings"] == ["NPI_PUNCTUATION_NORMALIZED"]
    assert c["CLM-BROKEN_CODE_DELIMITER"]["normalization_warnings"] == ["PROCEDURE_DELIMITER_NORMALIZED"]
    assert set(c["CLM-MULTIPLE_MISSING_FIELDS"]["missing_fields"]) == {"policy_number", "member_name", "procedure_codes"}


def test_personal_data_is_found_and_masked(stages):
    row = by_claim(stages["canonical_claims"])["CLM-PII_IN_NOTES"]
    assert row["pii_types"] == ["SSN_FIELD", "SSN_IN_NOTES", "PHONE_IN_NOTES"]
    assert row["notes_redacted"].startswith(f"SSN {fv.SSN_MASK} call")
    assert "123-45" not in row["notes_redacted"] and "555" not in row["notes_redacted"]
    for table in stages.values():
        hits = audit.audit_pattern_absent(table, r"\b\d{3}-\d{2}-\d{4}\b", exempt=["claim_key"])
        assert hits.where("hits > 0").count() == 0


def test_copies_of_a_claim(stages):
    c = by_claim(stages["canonical_claims"])
    dup, conflict, nameless = c["CLM-DUP"], c["CLM-CONFLICT"], c[None]
    assert (dup["document_count"], dup["selected_document_id"]) == (2, "DOC-0901")
    assert dup["source_document_ids"] == ["DOC-0900", "DOC-0901"]
    assert not dup["cross_document_conflict"] and dup["avg_ocr_confidence"] == pytest.approx(0.895)
    assert conflict["cross_document_conflict_fields"] == ["provider_npi_normalized", "billed_amount_parsed"]
    assert conflict["selected_document_id"] == "DOC-0903"
    assert conflict["procedure_codes"] == ["70002", "70003", "70004"]
    assert nameless["document_count"] == 2 and nameless["procedure_codes"] == ["70002", "70003", "70009"]


def test_reference_resolution(stages):
    c = by_claim(stages["reference_enriched_claims"])
    twice = c["CLM-TWICE-POLICY"]
    assert (twice["policy_id"], twice["policy_match_count"], twice["policy_ambiguous"]) == ("P-2", 2, True)
    assert c["CLM-TERMINATED"]["reference_enrichment_errors"] == [
        "POLICY_INACTIVE_ON_SERVICE_DATE",
        "MEMBER_IDENTITY_MISMATCH",
    ]
    npi = c["CLM-TWICE-NPI"]
    assert (npi["provider_id"], npi["provider_match_count"]) == ("PR-3", 3)
    assert c["CLM-NPI_WITHOUT_DIGITS"]["provider_id"] is None
    assert c["CLM-MISSING_POLICY"]["policy_match_count"] == 0
    assert c["CLM-O_AS_ZERO"]["entity_match_confidence"] == 0.75
    assert c["CLM-NONE"]["member_eligible"] and c["CLM-NONE"]["entity_match_confidence"] == 1.0


def test_coverage(stages):
    c = by_claim(stages["coverage_enriched_claims"])
    # 373.75 / 2 lines: 186.875 * 0.5 - 10 + 186.875 * 0.8 - 20
    assert str(c["CLM-NONE"]["estimated_eligible_amount"]) == "212.94"
    assert c["CLM-NONE"]["pre_auth_required_procedure_codes"] == ["70002"]
    assert c["CLM-CONFLICT"]["uncovered_procedure_codes"] == ["70004"]
    assert c["CLM-AMOUNT_O_AS_ZERO"]["estimated_eligible_amount"] is None
    assert c["CLM-MISSING_PROCEDURES"]["coverage_evidence"] == []
    assert c[None]["uncovered_procedure_count"] == 1


def test_history(stages):
    c = by_claim(stages["historical_enriched_claims"])
    row = c["CLM-NONE"]
    # H-1, H-2, H-7, both lines of H-8, both procedures of H-9 and a line without id lie in the window;
    # day 0, day -366 and the future do not
    assert (row["prior_claim_count_365d"], row["same_procedure_claim_count_365d"]) == (8, 5)
    assert [e["historical_claim_id"] for e in row["historical_evidence"]] == ["H-1", "H-8", "H-8", "H-7", "H-9"]
    assert str(row["prior_claim_amount_365d"]) == "894.86"
    # near: H-1, H-4 (5 % of 186.875 is 9.34375), H-5; not H-6 (31 days), H-7 (over 5 %), H-8 (other provider)
    assert row["candidate_duplicate_count"] == 3 and row["fraud_risk_score"] == 80
    assert c["CLM-MISSING_POLICY"]["historical_evidence"] == []
    assert c["CLM-MISSING_POLICY"]["prior_claim_count_365d"] == 0


def test_authorization(stages):
    c = by_claim(stages["authorization_enriched_claims"])
    assert c["CLM-NONE"]["pre_authorization_status"] == "VALID"
    assert c["CLM-CONFLICT"]["pre_authorization_status"] == "DENIED"
    assert c["CLM-TERMINATED"]["pre_authorization_status"] == "MISSING"
    assert c["CLM-INVALID_SERVICE_DATE"]["pre_authorization_status"] == "EXPIRED"
    assert c["CLM-MISSING_PROCEDURES"]["pre_authorization_status"] == "NOT_REQUIRED"


def test_cases(stages):
    c = by_claim(stages["claim_case"])
    assert c["CLM-AMOUNT_THOUSANDS"]["workflow_status"] == fv.STATUS_COMPLETE
    assert c["CLM-AMOUNT_THOUSANDS"]["decision_reason"] == fv.NO_REVIEW_TEXT
    assert c["CLM-NONE"]["review_reasons"] == ["LIKELY_DUPLICATE_CLAIM"]
    assert "OCR_UNREADABLE_DOCUMENT" in c["CLM-EMPTY_DOCUMENT"]["review_reasons"]
    assert c["CLM-NONE"]["evidence_package"]["policy_evidence"]["policy_match_count"] == 1
    assert c["CLM-NONE"]["case_id"] == "CASE-CLM-NONE"


def test_invariants_hold_after_every_stage(stages, inputs):
    docs = inputs["ocr_documents"]
    for name, table in stages.items():
        row = audit.audit_keys(docs, table, ["claim_id"]).first()
        assert (row["keys_lost"], row["keys_invented"], row["keys_repeated"]) == (0, 0, 0), name
    done = stages["claim_case"]
    assert audit.audit_unique(done, ["claim_id"]).count() == 0
    assert audit.audit_null(done, ["approved_amount"]).first()[0] == 0
    assert audit.audit_domain(done, {"workflow_status": [fv.STATUS_REVIEW, fv.STATUS_COMPLETE]}).first()[0] == 0
    assert done.where(F.col("workflow_status").isin(*fv.FORBIDDEN_STATUSES)).count() == 0


def test_a_claim_of_many_documents_keeps_all_ids_and_codes(spark, inputs):
    docs = [document(i, "CLM-BIG", procedure_codes=f"{70000 + i % 1500}|70002") for i in range(3000)]
    row = claims.canonical_claims(claim_inputs(spark, docs)["ocr_documents"].repartition(6)).first()
    assert row["source_document_ids"] == sorted(f"DOC-{i:04d}" for i in range(3000))
    assert row["procedure_codes"] == [str(70000 + i) for i in range(1500)]
    small = {**inputs, "ocr_documents": claim_inputs(spark, docs)["ocr_documents"]}
    case = claims.claim_cases(small).first()
    assert len(case["evidence_package"]["coverage_evidence"]) == 1500
    assert len(case["source_document_ids"]) == 3000


def test_the_wide_claims_are_shuffled_once_per_stage(spark, inputs):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, table in claims.claim_stages(inputs, cut):
            said = io.StringIO()
            with contextlib.redirect_stdout(said):
                table.explain("formatted")
            moved = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", said.getvalue())
            assert sum("notes_redacted" in columns for columns in moved) == (name not in ("canonical_claims", "claim_case")), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_stages_attach_what_they_add_without_a_shuffle(spark, inputs, stages):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, table in claims.claim_stages(inputs, bucketed(claims.KEY, 3)):
            said = io.StringIO()
            with contextlib.redirect_stdout(said):
                table.explain("formatted")
            assert "Exchange" not in said.getvalue(), name
            assert table.columns == stages[name].columns
            if name == "authorization_enriched_claims":
                keep = [c for c in table.columns if c not in ("ingested_at", "created_at", "updated_at")]
                text = lambda df: sorted(r["t"] for r in df.select(F.to_json(F.struct(*keep)).alias("t")).collect())
                assert text(table) == text(stages[name])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_same_cases_from_shuffled_and_repartitioned_documents(spark, inputs):
    docs = noise_documents() + duplicate_documents()
    first = by_claim(claims.canonical_claims(inputs["ocr_documents"].coalesce(1)))
    again = claim_inputs(spark, docs[::-1])["ocr_documents"].repartition(7)
    assert by_claim(claims.canonical_claims(again)) == first


def _write_csv(spark, rows, columns, path):
    spark.createDataFrame(rows, claims.INPUTS["ocr_documents"]).select(*columns).coalesce(1).write.option(
        "header", True
    ).option("escape", '"').option("quoteAll", True).csv(path)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_stage_by_stage_equals_the_whole_chain(spark, inputs, stages, tmp_path, fmt):
    raw, folder = str(tmp_path / "raw"), str(tmp_path / "out")
    rows = [document(1, "CLM-A"), document(2, "CLM-B", policy_number="POL-\n100001"), document(3, "CLM-A")]
    _write_csv(spark, rows, OCR_COLUMNS, raw)
    references = {n: t for n, t in inputs.items() if n != "ocr_documents"}
    for name in claims.STAGES:
        claims.run_stage(spark, name, folder, references, raw, fmt)
    schema = claims.stage_schema(spark, "claim_case") if fmt == "csv" else None
    done = by_claim(tables.read_stage(spark, f"{folder}/claim_case", fmt, schema))
    whole = by_claim(claims.claim_cases({**references, "ocr_documents": spark.createDataFrame(rows, INPUTS["ocr_documents"])}))
    assert done.keys() == whole.keys()
    for claim in whole:
        for c in ("review_reasons", "procedure_codes", "billed_amount", "service_date", "fraud_risk_score"):
            assert done[claim][c] == whole[claim][c], (claim, c)
        assert done[claim]["evidence_package"]["policy_evidence"] == whole[claim]["evidence_package"]["policy_evidence"]


def test_case_sinks_stamp_run_times(spark, stages, tmp_path):
    tables.write_case(stages["claim_case"], str(tmp_path / "claim_case"))
    tables.write_case_json(stages["claim_case"], str(tmp_path / "claim_case_json"))
    kept = spark.read.parquet(str(tmp_path / "claim_case"))
    assert {"created_at", "updated_at"} <= set(kept.columns) and kept.where("created_at is null").count() == 0
    line = spark.read.text(str(tmp_path / "claim_case_json")).first()[0]
    assert "case_id" in json.loads(line) or "document_count" in json.loads(line)
