"""The claims flow: noisy documents in, one case per claim out, in six stages.

The whole chain (``claim_stages``, ``claim_cases``) works out what each stage
adds as narrow facts, one row per claim, and the wide claims take them in with
one shuffle, whatever stage is read; ``between`` may write what later stages
use. A stage may also be run alone from the folder of the one before it
(``run_stage``). Every stage keeps every claim, a null claim id included: stages
join on the one-field struct ``claim_key``, whose equality is null-safe.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions import parsing as p
from caseloom.operators import authorization, canonical, cases, coverage, history, lookup, pii, rules, scoring
from caseloom.operators import standardize as st
from caseloom.operators.rules import Rule
from caseloom.sources import stages, tables
from caseloom.sources.lineage import cut
from caseloom.sources.schemas import INPUTS

KEY = ["claim_key"]


# --- 1. documents -> canonical claims -----------------------------------------
def standardize_documents(docs: DataFrame) -> DataFrame:
    """Normalised columns beside the raw ones."""
    names = {"policy_number": True, "member_first_name": True, "member_last_name": True}
    return (
        docs.transform(st.standardize_text, names)
        .transform(st.digits_only, ["provider_npi"])
        .transform(st.parse_dates, ["member_dob", "service_date", "admission_date", "discharge_date"])
        .transform(st.parse_code_lists, ["diagnosis_codes", "procedure_codes"])
        .transform(st.parse_amounts, ["billed_amount"])
        .withColumns(
            {
                "currency_normalized": p.enum(F.col("currency")),
                "ocr_confidence_parsed": F.trim("ocr_confidence").try_cast("double"),
            }
        )
    )


def document_rules() -> list[Rule]:
    c = F.col

    def unparsed(raw: str):
        return c(raw).isNotNull() & c(f"{raw}_parsed").isNull()

    def any_bad(codes: str, pattern: str):
        return F.exists(codes, lambda x: ~x.rlike(pattern))

    policy, npi = c("policy_number_normalized"), c("provider_npi_normalized")
    day, admitted, left = c("service_date_parsed"), c("admission_date_parsed"), c("discharge_date_parsed")
    confidence = c("ocr_confidence_parsed")
    label_hit = [
        F.coalesce(text, F.lit("")).isin(*fv.HEADER_LABELS)
        for text in (policy, p.enum(c("member_last_name")), p.enum(c("service_date")))
    ]
    return [
        Rule("MISSING_CLAIM_ID", p.blank(c("claim_id"))),
        Rule("MISSING_POLICY_NUMBER", p.blank(policy)),
        Rule("INVALID_POLICY_NUMBER", ~policy.rlike(fv.POLICY_NUMBER_PATTERN)),
        Rule("MISSING_MEMBER_NAME", _no_name()),
        Rule("INVALID_MEMBER_DOB", unparsed("member_dob")),
        Rule("MISSING_PROVIDER_NPI", npi.isNull()),
        Rule("INVALID_PROVIDER_NPI", c("provider_npi").isNotNull() & ~_is_npi(npi)),
        Rule("INVALID_SERVICE_DATE", unparsed("service_date")),
        Rule("ADMISSION_AFTER_DISCHARGE", admitted > left),
        Rule("SERVICE_DATE_OUTSIDE_STAY", admitted.isNotNull() & left.isNotNull() & ~day.between(admitted, left)),
        Rule("MISSING_PROCEDURE_CODES", F.size("procedure_codes_array") == 0),
        Rule("INVALID_PROCEDURE_CODE", any_bad("procedure_codes_array", fv.PROCEDURE_CODE_PATTERN)),
        Rule("INVALID_DIAGNOSIS_CODE", any_bad("diagnosis_codes_array", fv.DIAGNOSIS_CODE_PATTERN)),
        Rule("INVALID_BILLED_AMOUNT", unparsed("billed_amount")),
        Rule("NEGATIVE_BILLED_AMOUNT", c("billed_amount_parsed") < 0),
        Rule("UNSUPPORTED_CURRENCY", ~c("currency_normalized").isin(*fv.SUPPORTED_CURRENCIES)),
        Rule("INVALID_OCR_CONFIDENCE", ~F.coalesce(confidence.between(0, 1), F.lit(False))),
        Rule("LOW_OCR_CONFIDENCE", confidence < fv.MIN_CONFIDENCE),
        Rule("UNREADABLE_DOCUMENT", _says("noise_type", "unreadable") | _says("extracted_notes", "unreadable")),
        Rule("HEADER_TEXT_EXTRACTED_AS_VALUE", label_hit[0] | label_hit[1] | label_hit[2]),
        Rule(
            "MULTIPLE_VALUES_EXTRACTED_IN_SINGLE_FIELD",
            F.coalesce(c("policy_number"), F.lit("")).rlike(fv.SEVERAL_VALUES_PATTERN)
            | F.coalesce(c("provider_npi"), F.lit("")).rlike(fv.SEVERAL_VALUES_PATTERN),
        ),
    ]


def _is_npi(npi):
    return F.coalesce(npi.rlike(fv.NPI_PATTERN), F.lit(False))


def _says(column: str, word: str):
    return F.contains(F.lower(F.coalesce(F.col(column), F.lit(""))), F.lit(word))


def _no_name():
    return p.blank(F.col("member_first_name_normalized")) | p.blank(F.col("member_last_name_normalized"))


def required_fields() -> dict:
    return {
        "claim_id": p.blank(F.col("claim_id")),
        "policy_number": p.blank(F.col("policy_number_normalized")),
        "member_name": _no_name(),
        "provider_npi": F.col("provider_npi_normalized").isNull(),
        "procedure_codes": F.size("procedure_codes_array") == 0,
    }


def document_warnings() -> dict:
    c = F.col
    digits = F.coalesce(c("provider_npi_normalized"), F.lit(""))
    return {
        "NPI_PUNCTUATION_NORMALIZED": c("provider_npi") != digits,
        "DIAGNOSIS_DELIMITER_NORMALIZED": c("diagnosis_codes").rlike("[;,]"),
        "PROCEDURE_DELIMITER_NORMALIZED": c("procedure_codes").rlike("[;,]"),
        "BILLED_AMOUNT_COMMA_INTERPRETED": F.contains(c("billed_amount"), F.lit(",")),
    }


def check_documents(docs: DataFrame) -> DataFrame:
    """Standardised documents with rule arrays and personal-data findings."""
    return (
        standardize_documents(docs)
        .transform(rules.missing_fields, required_fields())
        .transform(rules.validate, document_rules(), valid_flag="is_valid_record")
        .transform(st.with_warnings, document_warnings())
        .transform(
            pii.detect_pii,
            {"SSN_FIELD": "extracted_ssn"},
            {
                "SSN_IN_NOTES": ("extracted_notes", fv.SSN_PATTERN),
                "PHONE_IN_NOTES": ("extracted_notes", fv.PHONE_PATTERN),
            },
        )
        .transform(pii.redact, "extracted_notes", "notes_redacted")
    )


LISTS = ("source_document_ids", "diagnosis_codes", "procedure_codes")
# fixed values: names of the canonical claim, and the column each is taken from
CLAIM_COLUMNS = {
    "claim_id": "claim_id",
    "source_document_ids": "source_document_ids",
    "document_count": "document_count",
    "policy_number_raw": "policy_number",
    "policy_number_normalized": "policy_number_normalized",
    "member_first_name_raw": "member_first_name",
    "member_first_name_normalized": "member_first_name_normalized",
    "member_last_name_raw": "member_last_name",
    "member_last_name_normalized": "member_last_name_normalized",
    "member_dob_raw": "member_dob",
    "member_dob_parsed": "member_dob_parsed",
    "provider_npi_raw": "provider_npi",
    "provider_npi_normalized": "provider_npi_normalized",
    "service_date_raw": "service_date",
    "service_date_parsed": "service_date_parsed",
    "admission_date_parsed": "admission_date_parsed",
    "discharge_date_parsed": "discharge_date_parsed",
    "diagnosis_codes": "diagnosis_codes",
    "procedure_codes": "procedure_codes",
    "billed_amount_raw": "billed_amount",
    "billed_amount_parsed": "billed_amount_parsed",
    "currency_normalized": "currency_normalized",
    "selected_document_id": "source_document_id",
    "selected_ocr_confidence": "ocr_confidence_parsed",
    "max_ocr_confidence": "max_ocr_confidence_parsed",
    "avg_ocr_confidence": "avg_ocr_confidence_parsed",
    "pii_detected": "pii_detected",
    "pii_types": "pii_types",
    "notes_redacted": "notes_redacted",
    "validation_errors": "validation_errors",
    "normalization_warnings": "normalization_warnings",
    "missing_fields": "missing_fields",
    "duplicate_document_flag": "duplicate_document_flag",
    "cross_document_conflict": "cross_document_conflict",
    "cross_document_conflict_fields": "cross_document_conflict_fields",
}


def _ranked_documents(docs: DataFrame) -> DataFrame:
    checked = check_documents(docs)
    needed = [c for c in CLAIM_COLUMNS.values() if c in checked.columns and c not in LISTS]
    return checked.select(
        *KEY,
        *needed,
        "is_valid_record",
        F.col("diagnosis_codes_array").alias("diagnosis_codes"),
        F.col("procedure_codes_array").alias("procedure_codes"),
        F.array("source_document_id").alias("source_document_ids"),
        F.size("validation_errors").alias("error_count"),
        F.coalesce("ocr_confidence_parsed", F.lit(-1.0)).alias("confidence_rank"),
        F.regexp_extract(F.coalesce("source_document_id", F.lit("")), r"(\d+)$", 1)
        .try_cast("decimal(38,0)")
        .alias("document_number"),
    )


BEST_DOCUMENT = [
    ("is_valid_record", "desc"),
    ("confidence_rank", "desc"),
    ("error_count", "asc"),
    ("document_number", "desc"),
    ("source_document_id", "asc"),
]


def canonical_claims(docs: DataFrame) -> DataFrame:
    """One row per claim: best document, copy evidence, unions of codes."""
    return _canonical_by_key(docs).drop(*KEY)


#: a claim of more documents may be folded on the map side, the largest ones only
MANY_DOCUMENTS = 1_000
LARGE_CLAIMS = 1_024


def _canonical_by_key(docs: DataFrame, apart: bool = True) -> DataFrame:
    """The canonical claims with ``claim_key``, which they are dealt out by already.

    Raw documents are dealt out and sorted by claim before they are parsed, as
    they are a third as wide then, and a claim's only document is not folded.
    Those of the largest claims stay where they are: their claims are folded
    before they are shuffled. Not ``apart``, all
    claims are folded so, which suits a plan that holds them many times over.
    """
    raw = _keyed(docs)
    if apart:
        large = F.broadcast(_large_claims(raw))
        dealt = raw.join(large, KEY, "left_anti").repartition(*KEY).sortWithinPartitions(*KEY)
        counted = dealt.withColumn("_documents", F.count(F.lit(1)).over(Window.partitionBy(*KEY)))
        lone = _ranked_documents(counted.where("_documents = 1").drop("_documents"))
        claims = canonical.canonical_alone(lone, KEY, "ocr_confidence_parsed", {name: F.col(name) for name in LISTS})
        claims = claims.unionByName(_folded(counted.where("_documents > 1").drop("_documents"), few=True))
        claims = claims.unionByName(_folded(raw.join(large, KEY, "left_semi"), few=False))
    else:
        claims = _folded(raw, few=False)
    return claims.select(*[F.col(src).alias(name) for name, src in CLAIM_COLUMNS.items()], *KEY)


def _large_claims(docs: DataFrame) -> DataFrame:
    """The claims that have the most documents, ``LARGE_CLAIMS`` of them at most, so any other has less than a share of one in so many."""
    counts = docs.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > MANY_DOCUMENTS)
    return counts.orderBy(F.desc("_n"), *KEY).limit(LARGE_CLAIMS).select(*KEY)


def _folded(docs: DataFrame, few: bool) -> DataFrame:
    return canonical.canonicalize(
        _ranked_documents(docs),
        KEY,
        BEST_DOCUMENT,
        "ocr_confidence_parsed",
        fv.CONFLICT_FIELDS,
        {name: F.col(name) for name in LISTS},
        few,
    )


# --- 2. reference tables --------------------------------------------------------
def reduced_policies(policy: DataFrame) -> DataFrame:
    cleaned = policy.select(
        p.tidy(F.col("policy_number"), upper=True).alias("policy_number"),
        "policy_id",
        "member_id",
        "plan_id",
        p.enum(F.col("policy_status")).alias("policy_status"),
        "coverage_start_date",
        "coverage_end_date",
        (p.enum(F.col("policy_status")) == "ACTIVE").alias("is_active"),
    )
    order = [
        ("is_active", "desc"),
        ("coverage_end_date", "desc"),
        ("coverage_start_date", "desc"),
        ("policy_id", "asc"),
    ]
    return lookup.reduce_dimension(cleaned, ["policy_number"], order, "policy_match_count").drop("is_active")


def reduced_members(member: DataFrame) -> DataFrame:
    cleaned = member.select(
        "member_id",
        F.col("first_name").alias("reference_first_name"),
        F.col("last_name").alias("reference_last_name"),
        F.col("dob").alias("reference_dob"),
        p.tidy(F.col("first_name"), upper=True).alias("_first"),
        p.tidy(F.col("last_name"), upper=True).alias("_last"),
    )
    order = [("reference_last_name", "asc"), ("reference_first_name", "asc"), ("reference_dob", "asc")]
    return lookup.reduce_dimension(cleaned, ["member_id"], order, "member_match_count")


def reduced_providers(provider: DataFrame) -> DataFrame:
    cleaned = provider.select(
        p.digits(F.col("npi")).alias("npi"),
        "provider_id",
        "provider_name",
        "provider_type",
        p.enum(F.col("network_status")).alias("provider_network_status"),
        F.coalesce("active_flag", F.lit(False)).alias("provider_active"),
    )
    order = [("provider_active", "desc"), ("provider_id", "asc")]
    return lookup.reduce_dimension(cleaned, ["npi"], order, "provider_match_count")


# what the lookups and later stages read of a canonical claim
RESOLVED_BY = (
    "policy_number_normalized",
    "member_first_name_normalized",
    "member_last_name_normalized",
    "member_dob_parsed",
    "provider_npi_normalized",
    "service_date_parsed",
)
CARRIED = ("claim_id", "procedure_codes", "billed_amount_parsed")


def reference_facts(claims: DataFrame, policy: DataFrame, member: DataFrame, provider: DataFrame) -> DataFrame:
    """What the reference tables add, one narrow row per claim key; ``claims`` may hold no more than the narrow columns."""
    pairs = [
        ("first_name_match", "member_first_name_normalized", "_first", fv.FIRST_NAME_POINTS),
        ("last_name_match", "member_last_name_normalized", "_last", fv.LAST_NAME_POINTS),
        ("dob_match", "member_dob_parsed", "reference_dob", fv.DOB_POINTS),
    ]
    on_policy = {"policy_number_normalized": "policy_number"}
    return (
        _keyed(claims)
        .select(*KEY, *RESOLVED_BY)
        .transform(lookup.lookup, reduced_policies(policy), on_policy, "policy_match_count", "policy")
        .transform(lookup.flag_policy_active, "service_date_parsed")
        .transform(lookup.lookup, reduced_members(member), {"member_id": "member_id"}, "member_match_count", "member")
        .transform(lookup.match_score, pairs, "member_exists")
        .withColumn(
            "member_eligible",
            F.col("member_exists")
            & F.col("policy_active_on_service_date")
            & (F.col("entity_match_confidence") == 1),
        )
        .transform(
            lookup.lookup, reduced_providers(provider), {"provider_npi_normalized": "npi"}, "provider_match_count",
            "provider",
        )
        .withColumn("provider_active", F.coalesce("provider_active", F.lit(False)))
        .transform(rules.validate, lookup.reference_rules(), "reference_enrichment_errors")
        .drop("_first", "_last", "member_match_count", "member_ambiguous", *RESOLVED_BY)
    )


def enrich_references(claims: DataFrame, policy: DataFrame, member: DataFrame, provider: DataFrame) -> DataFrame:
    return _take_in(claims, reference_facts(claims, policy, member, provider))


def resolved(claims: DataFrame, references: DataFrame) -> DataFrame:
    """The narrow claims that the stages after the lookups work on."""
    narrow = _keyed(claims).select(*KEY, *CARRIED, "service_date_parsed")
    return narrow.join(references.select(*KEY, "plan_id", "member_id", "provider_id"), KEY, "left")


# --- 3. coverage ------------------------------------------------------------------
def _keyed(claims: DataFrame) -> DataFrame:
    if "claim_key" in claims.columns:
        return claims
    return claims.withColumn("claim_key", F.coalesce(F.concat(F.lit("="), "claim_id"), F.lit("")))


def _take_in(claims: DataFrame, *facts: DataFrame) -> DataFrame:
    """Claims with the columns of tables keyed by claim; the joins share one shuffle of the claims, or none if all are bucketed."""
    table = _keyed(claims)
    for per_claim in facts:
        table = table.join(per_claim, KEY, "left")  # a key is never null
    return table.drop(*KEY)


def claim_lines(claims: DataFrame, *columns: str) -> DataFrame:
    """One row per claim and procedure code; a claim without codes keeps one row."""
    narrow = _keyed(claims).select(*KEY, *columns, "procedure_codes")
    return coverage.explode_lines(narrow, "procedure_codes").drop("procedure_index")


def reduced_coverage(plan_coverage: DataFrame) -> DataFrame:
    cleaned = plan_coverage.select(
        "plan_id",
        "procedure_code",
        "coverage_type",
        "coverage_percentage",
        "deductible_amount",
        "copay_amount",
        F.coalesce("requires_pre_authorization", F.lit(False)).alias("requires_pre_authorization"),
    )
    order = [
        ("coverage_type", "asc"),
        ("coverage_percentage", "asc"),
        ("copay_amount", "asc"),
        ("requires_pre_authorization", "desc"),
        ("deductible_amount", "asc"),
    ]
    return lookup.reduce_dimension(cleaned, ["plan_id", "procedure_code"], order, "coverage_match_count")


def priced_lines(claims: DataFrame, plan_coverage: DataFrame, *columns: str) -> DataFrame:
    lines = claim_lines(claims, "plan_id", "billed_amount_parsed", *columns)
    lines = coverage.allocate_evenly(lines, "billed_amount_parsed", "line_count", "procedure_billed_amount")
    on = {"plan_id": "plan_id", "procedure_code": "procedure_code"}
    return coverage.coverage_join(lines, reduced_coverage(plan_coverage), on)


def coverage_facts(priced: DataFrame) -> DataFrame:
    """What coverage adds, one narrow row per claim key."""
    return rules.validate(coverage.rollup_coverage(priced, KEY), coverage.coverage_rules(), "coverage_errors")


def enrich_coverage(claims: DataFrame, plan_coverage: DataFrame) -> DataFrame:
    return _take_in(claims, coverage_facts(priced_lines(claims, plan_coverage)))


# --- 4. history ---------------------------------------------------------------------
LINE_COLUMNS = ("claim_id", "member_id", "provider_id", "service_date_parsed")


def history_facts(
    claims: DataFrame, lines: DataFrame, claim_history: DataFrame, between: Callable[..., DataFrame] = history.as_is
) -> DataFrame:
    """What history adds, one narrow row per claim key; every history line counts, ids where ids are meant.

    ``lines`` is of ``claim_lines``, with ``LINE_COLUMNS`` and each line's share of the amount.
    """
    on = ("member_id", "service_date_parsed")
    used = ("historical_claim_id", "member_id", "provider_id", "procedure_code", "service_date", "claim_amount", "claim_status")
    claim_history = between(claim_history.select(*used), "claim_history")
    asked_lines = lines.where(F.col("procedure_code").isNotNull())
    same = history.distinct_counts(
        asked_lines,
        claim_history,
        ["member_id", "procedure_code"],
        ("claim_key", "service_date_parsed"),
        ("historical_claim_id", "service_date"),
        "same_procedure_claim_count_365d",
        between=between,
    )
    near = history.near_duplicate_counts(
        asked_lines,
        claim_history,
        ["member_id", "provider_id", "procedure_code"],
        ("claim_key", "service_date_parsed", "procedure_billed_amount"),
        ("historical_claim_id", "service_date", "claim_amount"),
        own_id="claim_id",
        between=between,
    )
    metrics = (
        "prior_claim_count_365d",
        "prior_claim_amount_365d",
        "most_recent_prior_service_date",
        "historical_average_claim_amount",
    )
    payload = ["provider_id", "procedure_code", "claim_amount", "claim_status"]
    asked = _keyed(claims).select(*KEY, *on, "billed_amount_parsed")
    asked = history.trailing_metrics(
        asked, claim_history, ["member_id"], "service_date_parsed", "service_date", "claim_amount", metrics
    )
    asked = history.recent_evidence(
        asked, claim_history, ["member_id"], "service_date_parsed", "service_date", "historical_claim_id", payload
    )
    zero = F.lit(0).cast("long")
    same, near = between(same, "same_procedure_counts"), between(near, "near_counts")
    return (
        asked.join(same, KEY, "left")  # a key is never null, so the joins share one shuffle
        .join(near, KEY, "left")
        .withColumns({c: F.coalesce(c, zero) for c in ("same_procedure_claim_count_365d", "candidate_duplicate_count")})
        .withColumn("duplicate_claim_flag", F.col("candidate_duplicate_count") > 0)
        .transform(scoring.score, scoring.risk_rules(), fv.RISK_CAP, "fraud_risk_score")
        .drop(*on, "billed_amount_parsed")
    )


def enrich_history(claims: DataFrame, claim_history: DataFrame) -> DataFrame:
    lines = claim_lines(claims, *LINE_COLUMNS, "billed_amount_parsed")
    lines = coverage.allocate_evenly(lines, "billed_amount_parsed", "line_count", "procedure_billed_amount")
    return _take_in(claims, history_facts(claims, lines, claim_history))


# --- 5. authorization ------------------------------------------------------------------
def cleaned_authorizations(pre_authorization: DataFrame) -> DataFrame:
    return pre_authorization.withColumn("authorization_status", p.enum(F.col("authorization_status")))


GRANT_KEYS = ["member_id", "provider_id", "procedure_code"]


def authorization_facts(
    required: DataFrame, pre_authorization: DataFrame, between: Callable[..., DataFrame] = history.as_is
) -> DataFrame:
    """What authorization adds, one narrow row per claim key that ``required`` holds.

    ``required`` has one row per claim and procedure that needs authorization;
    a row without a procedure asks for none.
    """
    grants = cleaned_authorizations(pre_authorization)
    asked = between(required.where(F.col("procedure_code").isNotNull()), "required_codes")
    matched = authorization.match_authorizations(asked, grants, GRANT_KEYS, "service_date_parsed", between)
    classified = authorization.classify_authorization(matched, "procedure_code")
    found = authorization.rollup_authorization(classified, KEY)
    # most claims ask for none, and a row that does not changes nothing for a claim that does
    lists = {f.name: F.coalesce(f.name, F.array().cast(f.dataType)) for f in found.schema.fields if f.dataType.typeName() == "array"}
    none = {"pre_authorization_status": F.coalesce("pre_authorization_status", F.lit("NOT_REQUIRED"))}
    return required.select(*KEY).distinct().join(found, KEY, "left").withColumns(lists | none)


def enrich_authorization(claims: DataFrame, pre_authorization: DataFrame) -> DataFrame:
    codes = "pre_auth_required_procedure_codes"
    required = coverage.explode_lines(_keyed(claims).select(*KEY, *LINE_COLUMNS[1:], codes), codes)
    return _take_in(claims, authorization_facts(required, pre_authorization))


# --- 6. cases -----------------------------------------------------------------------------
# fixed values: names of the case, and the column each is taken from
CASE_COLUMNS = {
    "claim_id": "claim_id",
    "source_document_ids": "source_document_ids",
    "document_count": "document_count",
    "member_id": "member_id",
    "policy_id": "policy_id",
    "provider_id": "provider_id",
    "plan_id": "plan_id",
    "service_date": "service_date_parsed",
    "admission_date": "admission_date_parsed",
    "discharge_date": "discharge_date_parsed",
    "diagnosis_codes": "diagnosis_codes",
    "procedure_codes": "procedure_codes",
    "billed_amount": "billed_amount_parsed",
    "estimated_eligible_amount": "estimated_eligible_amount",
    "currency": "currency_normalized",
    "policy_status": "policy_status",
    "policy_active_on_service_date": "policy_active_on_service_date",
    "member_eligible": "member_eligible",
    "entity_match_confidence": "entity_match_confidence",
    "provider_active": "provider_active",
    "provider_network_status": "provider_network_status",
    "pre_authorization_status": "pre_authorization_status",
    "duplicate_claim_flag": "duplicate_claim_flag",
    "fraud_risk_score": "fraud_risk_score",
    "workflow_status": "workflow_status",
    "review_required": "review_required",
    "review_reasons": "review_reasons",
    "decision_reason": "decision_reason",
    "selected_ocr_confidence": "selected_ocr_confidence",
    "max_ocr_confidence": "max_ocr_confidence",
    "avg_ocr_confidence": "avg_ocr_confidence",
    "evidence_package": "evidence_package",
}


def assemble_cases(claims: DataFrame) -> DataFrame:
    return (
        claims.transform(
            cases.review_reasons, cases.claim_reason_rules(), ["reference_enrichment_errors", "coverage_errors"]
        )
        .transform(cases.evidence_package, cases.CLAIM_EVIDENCE)
        .transform(cases.workflow_status)
        .transform(cases.build_case, "claim_id", CASE_COLUMNS)
    )


# --- whole flow, and stage by stage -----------------------------------------------------------
Inputs = dict[str, DataFrame]

# stage -> (function of the claims so far, further inputs)
STAGES: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "canonical_claims": (canonical_claims, ()),
    "reference_enriched_claims": (enrich_references, ("policy", "member", "provider")),
    "coverage_enriched_claims": (enrich_coverage, ("plan_coverage",)),
    "historical_enriched_claims": (enrich_history, ("claim_history",)),
    "authorization_enriched_claims": (enrich_authorization, ("pre_authorization",)),
    "claim_case": (assemble_cases, ()),
}


def claim_stages(inputs: Inputs, between: Callable[..., DataFrame] = history.as_is) -> Iterator[tuple[str, DataFrame]]:
    """The table of each stage in turn; ``between`` may write what later stages use, see ``sources.lineage.cut``.

    What stages add is worked out as narrow tables keyed by claim, from the
    narrow columns of the claims and from their lines, priced once. The wide
    claims, raw and redacted text included, are shuffled once per stage read.
    """
    claims = between(_canonical_by_key(inputs["ocr_documents"], between is not history.as_is), "canonical_claims")
    yield "canonical_claims", claims.drop(*KEY)
    references = between(
        reference_facts(claims, inputs["policy"], inputs["member"], inputs["provider"]), "reference_facts"
    )
    yield "reference_enriched_claims", _take_in(claims, references)
    narrow = between(resolved(claims, references), "resolved_claims")
    priced = between(priced_lines(narrow, inputs["plan_coverage"], *LINE_COLUMNS), "priced_lines")
    covered = between(coverage_facts(priced), "coverage_facts")
    yield "coverage_enriched_claims", _take_in(claims, references, covered)
    past = between(history_facts(narrow, priced, inputs["claim_history"], between), "history_facts")
    yield "historical_enriched_claims", _take_in(claims, references, covered, past)
    code = F.when(F.col("requires_pre_authorization"), F.col("procedure_code"))
    required = priced.select(*KEY, *LINE_COLUMNS[1:], code.alias("procedure_code"))
    grants = between(authorization_facts(required, inputs["pre_authorization"], between), "authorization_facts")
    complete = _take_in(claims, references, covered, past, grants)
    yield "authorization_enriched_claims", complete
    yield "claim_case", assemble_cases(complete)


def claim_cases(inputs: Inputs, upto: str = "claim_case", between: Callable[..., DataFrame] = history.as_is) -> DataFrame:
    """The chain from documents to the named stage."""
    for name, table in claim_stages(inputs, between):
        if name == upto:
            return table
    raise KeyError(upto)


def stage_schema(spark: SparkSession, name: str):
    """Schema of a stage's output, from its plan over empty inputs; nothing runs."""
    return claim_cases({n: spark.createDataFrame([], s) for n, s in INPUTS.items()}, name).schema


def _landed_documents(spark: SparkSession, path: str) -> DataFrame:
    """The raw documents, their CSV read once: the first stage goes through them several times."""
    names = INPUTS["ocr_documents"].fieldNames()
    return cut(tables.read_raw(spark, path, names).select(*names), "raw_documents")


def run_stage(
    spark: SparkSession,
    name: str,
    folder: str,
    references: Inputs,
    raw_path: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Run one stage from ``folder/<stage before>`` and replace ``folder/<stage>``; the first reads the raw CSV."""
    order = list(STAGES)
    at = order.index(name)
    if at == 0:
        source = _landed_documents(spark, raw_path)
    else:
        before = order[at - 1]
        schema = stage_schema(spark, before) if fmt == "csv" else None
        source = tables.read_stage(spark, f"{folder}/{before}", fmt, schema)
    stage, needs = STAGES[name]
    result = stage(source, *[references[n] for n in needs])
    if name == "claim_case" and fmt == "parquet":
        tables.write_case(result, f"{folder}/{name}")
    else:
        tables.write_stage(result, f"{folder}/{name}", fmt)


def resume_stages(
    spark: SparkSession, folder: str, paths: dict[str, str], upto: str = "claim_case", fmt: str = "parquet", edition: str = "1"
) -> list[str]:
    """Publish the stages in turn under ``folder``, each from the one before; the names of those that ran.

    ``paths`` has the landed CSV of every input. A stage whose inputs, the stage
    before included, are as they were when it was made is left as it is, and so
    is all that follows it. A change of the code is told by ``edition``.
    """
    ran, before = [], None
    for name, (stage, needs) in STAGES.items():
        inputs = {n: paths[n] for n in needs} | {"before": f"{folder}/{before}" if before else paths["ocr_documents"]}

        def build(stage=stage, needs=needs, before=before, last=name == "claim_case") -> DataFrame:
            if before is None:
                source = _landed_documents(spark, paths["ocr_documents"])
            else:
                source = stages.read_published(spark, f"{folder}/{before}")
            result = stage(source, *[tables.read_reference(spark, paths[n], INPUTS[n]) for n in needs])
            return tables.with_run_times(result) if last else result

        if stages.resume_stage(spark, f"{folder}/{name}", inputs, f"{name} {edition}", build, fmt):
            ran.append(name)
        if name == upto:
            return ran
        before = name
    raise KeyError(upto)
