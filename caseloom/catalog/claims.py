"""The claims flow over the derived claims world, stage by stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.catalog import Source, query
from caseloom.catalog.orders import sql_amount, sql_codes, sql_date, sql_tidy
from caseloom.catalog.world import claim_world, ctes
from caseloom.operators import audit, cases, rules
from caseloom.plans import claims
from caseloom.sources.lineage import bucketed, cut


def stage(src: Source, name: str) -> DataFrame:
    """A stage of the flow; what later stages use is written to the shared folder, as one plan of it all is slower."""
    return stages_of(src, name)[name]


def stages_of(src: Source, *names: str) -> dict[str, DataFrame]:
    """The documents as landed and the named stages, the last one last, from one run of the flow."""
    world = claim_world(src)
    landed = cut(world["ocr_documents"], "ocr_documents")
    found = {"ocr_documents": landed}
    for name, table in claims.claim_stages({**world, "ocr_documents": landed}, bucketed(claims.KEY)):
        found[name] = table
        if name == names[-1]:
            return {n: found[n] for n in ("ocr_documents", *names)}
    raise KeyError(names[-1])


def flat(df: DataFrame, *columns: str) -> DataFrame:
    """The columns, arrays of text joined for comparison."""
    types = dict(df.dtypes)
    return df.select(*[F.array_join(c, "|").alias(c) if types[c] == "array<string>" else F.col(c) for c in columns])


# --- the flow as SQL ------------------------------------------------------------------------------------
_LABELS = ", ".join(f"'{x}'" for x in fv.HEADER_LABELS)
_PARSED = f"""parsed AS (SELECT *, upper({sql_tidy('policy_number')}) AS pol, upper({sql_tidy('member_first_name')}) AS fn,
    upper({sql_tidy('member_last_name')}) AS ln, {sql_date('member_dob')} AS dob,
    nullif(regexp_replace(provider_npi, '[^0-9]', '', 'g'), '') AS npi, {sql_date('service_date')} AS sd,
    {sql_date('admission_date')} AS ad, {sql_date('discharge_date')} AS dd, {sql_codes('diagnosis_codes')} AS dx,
    {sql_codes('procedure_codes')} AS px, {sql_amount('billed_amount')} AS amt, upper(trim(currency)) AS cur,
    TRY_CAST(trim(ocr_confidence) AS DOUBLE) AS conf, coalesce(extracted_notes, '') AS notes
  FROM w_ocr_documents)"""
_CHECKED = f"""checked AS (SELECT *, [x FOR x IN [CASE WHEN coalesce(trim(claim_id), '') = '' THEN 'claim_id' END,
      CASE WHEN coalesce(pol, '') = '' THEN 'policy_number' END,
      CASE WHEN coalesce(fn, '') = '' OR coalesce(ln, '') = '' THEN 'member_name' END,
      CASE WHEN npi IS NULL THEN 'provider_npi' END, CASE WHEN len(px) = 0 THEN 'procedure_codes' END]
      IF x IS NOT NULL] AS missing,
    [x FOR x IN [CASE WHEN coalesce(trim(claim_id), '') = '' THEN 'MISSING_CLAIM_ID' END,
      CASE WHEN coalesce(pol, '') = '' THEN 'MISSING_POLICY_NUMBER' END,
      CASE WHEN NOT regexp_full_match(pol, 'POL-\\d+') THEN 'INVALID_POLICY_NUMBER' END,
      CASE WHEN coalesce(fn, '') = '' OR coalesce(ln, '') = '' THEN 'MISSING_MEMBER_NAME' END,
      CASE WHEN member_dob IS NOT NULL AND dob IS NULL THEN 'INVALID_MEMBER_DOB' END,
      CASE WHEN npi IS NULL THEN 'MISSING_PROVIDER_NPI' END,
      CASE WHEN provider_npi IS NOT NULL AND NOT coalesce(regexp_full_match(npi, '\\d{{10}}'), false)
        THEN 'INVALID_PROVIDER_NPI' END,
      CASE WHEN service_date IS NOT NULL AND sd IS NULL THEN 'INVALID_SERVICE_DATE' END,
      CASE WHEN ad > dd THEN 'ADMISSION_AFTER_DISCHARGE' END,
      CASE WHEN ad IS NOT NULL AND dd IS NOT NULL AND NOT (sd BETWEEN ad AND dd) THEN 'SERVICE_DATE_OUTSIDE_STAY' END,
      CASE WHEN len(px) = 0 THEN 'MISSING_PROCEDURE_CODES' END,
      CASE WHEN len([c FOR c IN px IF NOT regexp_full_match(c, '\\d{{5}}')]) > 0 THEN 'INVALID_PROCEDURE_CODE' END,
      CASE WHEN len([c FOR c IN dx IF NOT regexp_full_match(c, '[A-Z]\\d[0-9A-Z](\\.[0-9A-Z]{{1,4}})?')]) > 0
        THEN 'INVALID_DIAGNOSIS_CODE' END,
      CASE WHEN billed_amount IS NOT NULL AND amt IS NULL THEN 'INVALID_BILLED_AMOUNT' END,
      CASE WHEN amt < 0 THEN 'NEGATIVE_BILLED_AMOUNT' END, CASE WHEN cur <> 'USD' THEN 'UNSUPPORTED_CURRENCY' END,
      CASE WHEN conf IS NULL OR conf < 0 OR conf > 1 THEN 'INVALID_OCR_CONFIDENCE' END,
      CASE WHEN conf < 0.75 THEN 'LOW_OCR_CONFIDENCE' END,
      CASE WHEN contains(lower(noise_type), 'unreadable') OR contains(lower(notes), 'unreadable')
        THEN 'UNREADABLE_DOCUMENT' END,
      CASE WHEN coalesce(pol, '') IN ({_LABELS}) OR coalesce(upper(trim(member_last_name)), '') IN ({_LABELS})
        OR coalesce(upper(trim(service_date)), '') IN ({_LABELS}) THEN 'HEADER_TEXT_EXTRACTED_AS_VALUE' END,
      CASE WHEN regexp_matches(coalesce(policy_number, ''), '[|;,/]') OR regexp_matches(coalesce(provider_npi, ''), '[|;,/]')
        THEN 'MULTIPLE_VALUES_EXTRACTED_IN_SINGLE_FIELD' END] IF x IS NOT NULL] AS errors,
    [x FOR x IN [CASE WHEN provider_npi <> coalesce(npi, '') THEN 'NPI_PUNCTUATION_NORMALIZED' END,
      CASE WHEN regexp_matches(diagnosis_codes, '[;,]') THEN 'DIAGNOSIS_DELIMITER_NORMALIZED' END,
      CASE WHEN regexp_matches(procedure_codes, '[;,]') THEN 'PROCEDURE_DELIMITER_NORMALIZED' END,
      CASE WHEN contains(billed_amount, ',') THEN 'BILLED_AMOUNT_COMMA_INTERPRETED' END] IF x IS NOT NULL] AS warns,
    [x FOR x IN [CASE WHEN coalesce(trim(extracted_ssn), '') <> '' THEN 'SSN_FIELD' END,
      CASE WHEN regexp_matches(notes, '{fv.SSN_PATTERN}') THEN 'SSN_IN_NOTES' END,
      CASE WHEN regexp_matches(notes, '{fv.PHONE_PATTERN}') THEN 'PHONE_IN_NOTES' END] IF x IS NOT NULL] AS pii,
    regexp_replace(regexp_replace(notes, '{fv.SSN_PATTERN}', '{fv.SSN_MASK}', 'g'), '{fv.PHONE_PATTERN}',
      '{fv.PHONE_MASK}', 'g') AS redacted
  FROM parsed)"""
_SQL_FIELDS = ("pol", "fn", "ln", "dob", "npi", "sd", "amt", "cur")
_CONFLICTS = ", ".join(
    f"CASE WHEN count(DISTINCT {c}) > 1 THEN '{name}' END" for c, name in zip(_SQL_FIELDS, fv.CONFLICT_FIELDS)
)
# NULL claim ids form one claim; ck is its key
_CANON = f"""best AS (SELECT * FROM (SELECT *, coalesce(claim_id, '(null)') AS ck, row_number() OVER (PARTITION BY claim_id
      ORDER BY (len(errors) = 0) DESC, coalesce(conf, -1) DESC, len(errors),
        CAST(regexp_extract(source_document_id, '(\\d+)$', 1) AS INT) DESC, source_document_id) AS rn FROM checked)
    WHERE rn = 1),
  facts AS (SELECT coalesce(claim_id, '(null)') AS ck, count(*) AS n, max(conf) AS max_conf,
      CAST(sum(CAST(conf AS DECIMAL(38,15))) AS DOUBLE) / count(conf) AS avg_conf,
      string_agg(DISTINCT source_document_id, '|' ORDER BY source_document_id) AS ids,
      concat_ws('|', {_CONFLICTS}) AS conflicts FROM checked GROUP BY ALL),
  dxs AS (SELECT ck, list_sort(list(DISTINCT c)) AS all_dx FROM (SELECT coalesce(claim_id, '(null)') AS ck, unnest(dx) AS c
    FROM checked) GROUP BY ck),
  pxs AS (SELECT ck, list_sort(list(DISTINCT c)) AS all_px FROM (SELECT coalesce(claim_id, '(null)') AS ck, unnest(px) AS c
    FROM checked) GROUP BY ck),
  canon AS (SELECT b.* EXCLUDE (dx, px), f.n, f.max_conf, f.avg_conf, f.ids, f.conflicts, coalesce(all_dx, []) AS dx,
    coalesce(all_px, []) AS px FROM best b JOIN facts f USING (ck) LEFT JOIN dxs USING (ck) LEFT JOIN pxs USING (ck))"""
_REFS = f"""rp AS (SELECT * FROM (SELECT *, upper({sql_tidy('policy_number')}) AS key, upper(trim(policy_status)) AS pstatus,
      count(*) OVER (PARTITION BY upper({sql_tidy('policy_number')})) AS pn,
      row_number() OVER (PARTITION BY upper({sql_tidy('policy_number')}) ORDER BY (upper(trim(policy_status)) = 'ACTIVE') DESC,
        coverage_end_date DESC, coverage_start_date DESC, policy_id) AS rn FROM w_policy) WHERE rn = 1),
  rv AS (SELECT * FROM (SELECT *, nullif(regexp_replace(npi, '[^0-9]', '', 'g'), '') AS key,
      upper(trim(network_status)) AS network,
      count(*) OVER (PARTITION BY regexp_replace(npi, '[^0-9]', '', 'g')) AS vn,
      row_number() OVER (PARTITION BY regexp_replace(npi, '[^0-9]', '', 'g') ORDER BY active_flag DESC, provider_id) AS rn
      FROM w_provider) WHERE rn = 1 AND key IS NOT NULL),
  joined AS (SELECT c.*, rp.policy_id, rp.member_id, rp.plan_id, rp.pstatus, rp.coverage_start_date, rp.coverage_end_date,
      coalesce(pn, 0) AS pn, coalesce(pstatus = 'ACTIVE' AND sd BETWEEN coverage_start_date AND coverage_end_date, false) AS pact,
      m.member_id IS NOT NULL AS mx, m.first_name AS rfn, m.last_name AS rln, m.dob AS rdob,
      coalesce(fn = upper({sql_tidy('m.first_name')}), false) AS fm, coalesce(ln = upper({sql_tidy('m.last_name')}), false) AS lm,
      coalesce(c.dob = m.dob, false) AS dm, rv.provider_id, rv.provider_name, rv.network, coalesce(vn, 0) AS vn,
      coalesce(rv.active_flag, false) AS vact
    FROM canon c LEFT JOIN rp ON c.pol = rp.key LEFT JOIN w_member m ON rp.member_id = m.member_id
      LEFT JOIN rv ON c.npi = rv.key),
  scored AS (SELECT *, CAST(CAST(fm AS INT) * 25 + CAST(lm AS INT) * 35 + CAST(dm AS INT) * 40 AS DOUBLE) / 100 AS emc
    FROM joined),
  refs AS (SELECT *, mx AND pact AND emc = 1 AS eligible_member, [x FOR x IN [CASE WHEN pn = 0 THEN 'POLICY_NOT_FOUND' END,
      CASE WHEN pn > 1 THEN 'POLICY_AMBIGUOUS' END, CASE WHEN pn > 0 AND NOT pact THEN 'POLICY_INACTIVE_ON_SERVICE_DATE' END,
      CASE WHEN NOT mx THEN 'MEMBER_NOT_FOUND' END, CASE WHEN mx AND emc < 1 THEN 'MEMBER_IDENTITY_MISMATCH' END,
      CASE WHEN vn = 0 THEN 'PROVIDER_NOT_FOUND' END, CASE WHEN vn > 1 THEN 'PROVIDER_AMBIGUOUS' END,
      CASE WHEN vn > 0 AND NOT vact THEN 'PROVIDER_INACTIVE' END] IF x IS NOT NULL] AS ref_errors FROM scored)"""
_COVERAGE = """plans AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY plan_id, procedure_code
      ORDER BY coverage_type, coverage_percentage, copay_amount, requires_pre_authorization DESC, deductible_amount) AS rn
      FROM w_plan_coverage) WHERE rn = 1),
  lines AS (SELECT ck, plan_id, member_id, provider_id, sd, CAST(round(amt / len(px), 4) AS DECIMAL(18,4)) AS share,
    unnest(px) AS code FROM refs),
  priced AS (SELECT l.ck, l.code, p.plan_id IS NOT NULL AS found, coalesce(requires_pre_authorization, false) AS needs,
    l.share, coverage_type, coverage_percentage, deductible_amount, copay_amount,
    CASE WHEN p.plan_id IS NOT NULL AND share IS NOT NULL THEN CAST(greatest(share * CAST(coverage_percentage AS DECIMAL(38,9))
      - copay_amount, 0) AS DECIMAL(18,4)) END AS due
    FROM lines l LEFT JOIN plans p ON l.plan_id = p.plan_id AND l.code = p.procedure_code),
  cov AS (SELECT ck, coalesce(list_sort(list(code) FILTER (found)), []) AS covered,
    coalesce(list_sort(list(code) FILTER (NOT found)), []) AS uncovered,
    coalesce(list_sort(list(code) FILTER (needs)), []) AS needing, CAST(sum(due) AS DECIMAL(18,2)) AS eligible,
    string_agg(concat_ws(':', code, found, coalesce(coverage_type, '-'), coalesce(CAST(CAST(round(coverage_percentage * 100) AS INT)
      AS STRING), '-'), coalesce(CAST(deductible_amount AS STRING), '-'), coalesce(CAST(copay_amount AS STRING), '-'),
      CASE WHEN found THEN CAST(needs AS STRING) ELSE '-' END, coalesce(CAST(share AS STRING), '-'),
      coalesce(CAST(due AS STRING), '-')), '|' ORDER BY code) AS cov_evidence
    FROM priced GROUP BY ck)"""
_HISTORY = """past AS (SELECT * FROM w_claim_history),
  prior AS (SELECT r.ck, h.* FROM refs r JOIN past h ON r.member_id = h.member_id AND h.service_date < r.sd
    AND h.service_date >= r.sd - 365),
  hist AS (SELECT ck, count(*) AS pc, CAST(sum(claim_amount) AS DECIMAL(18,2)) AS ps, max(service_date) AS last_day,
    CAST(sum(claim_amount) AS DOUBLE) / count(claim_amount) AS mean FROM prior GROUP BY ck),
  ev AS (SELECT ck, string_agg(concat_ws(':', coalesce(historical_claim_id, '-'), CAST(service_date AS STRING), provider_id,
      procedure_code, CAST(claim_amount AS STRING), claim_status), '|' ORDER BY rn) AS evidence FROM (SELECT *, row_number() OVER (
      PARTITION BY ck ORDER BY service_date DESC, historical_claim_id NULLS FIRST, provider_id, procedure_code,
      claim_amount, claim_status) AS rn FROM prior) WHERE rn <= 5 GROUP BY ck),
  same AS (SELECT l.ck, count(DISTINCT historical_claim_id) AS sc FROM lines l JOIN past h ON l.member_id = h.member_id
    AND l.code = h.procedure_code AND h.service_date < l.sd AND h.service_date >= l.sd - 365 GROUP BY l.ck),
  near AS (SELECT l.ck, count(DISTINCT historical_claim_id) AS dc FROM lines l JOIN past h ON l.member_id = h.member_id
    AND l.provider_id = h.provider_id AND l.code = h.procedure_code AND abs(h.service_date - l.sd) <= 30
    AND abs(h.claim_amount - l.share) <= l.share * 0.05 GROUP BY l.ck),
  risk AS (SELECT r.ck, coalesce(pc, 0) AS pc, coalesce(ps, 0) AS ps, last_day, mean, coalesce(evidence, '') AS evidence,
      coalesce(sc, 0) AS sc, coalesce(dc, 0) AS dc, least(100, CASE WHEN coalesce(dc, 0) > 0 THEN 50 ELSE 0 END
        + CASE WHEN coalesce(pc, 0) > 10 THEN 20 ELSE 0 END + CASE WHEN coalesce(sc, 0) > 3 THEN 15 ELSE 0 END
        + CASE WHEN CAST(r.amt AS DOUBLE) > mean * 3 THEN 15 ELSE 0 END) AS score
    FROM refs r LEFT JOIN hist USING (ck) LEFT JOIN ev USING (ck) LEFT JOIN same USING (ck) LEFT JOIN near USING (ck))"""
_RANKS = "CASE result " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(fv.AUTHORIZATION_PRIORITY)) + " END"
_AUTHORIZATION = f"""asked AS (SELECT p.ck, p.code, r.member_id, r.provider_id, r.sd FROM priced p JOIN refs r USING (ck) WHERE needs),
  offers AS (SELECT a.ck, a.code, g.authorization_id, upper(trim(g.authorization_status)) AS gstatus, g.valid_from, g.valid_to,
      coalesce(upper(trim(g.authorization_status)) = 'APPROVED' AND a.sd BETWEEN g.valid_from AND g.valid_to, false) AS ok
    FROM asked a LEFT JOIN w_pre_authorization g ON a.member_id = g.member_id AND a.provider_id = g.provider_id
      AND a.code = g.procedure_code),
  picked AS (SELECT *, CASE WHEN an = 0 THEN 'MISSING' WHEN an > 1 THEN 'AMBIGUOUS' WHEN ok THEN 'VALID'
      WHEN gstatus = 'APPROVED' THEN 'EXPIRED' ELSE gstatus END AS result FROM (SELECT *, count(authorization_id) OVER w AS an,
      count(*) FILTER (ok) OVER w AS okn,
      row_number() OVER (PARTITION BY ck, code ORDER BY ok DESC, valid_to DESC NULLS LAST, authorization_id) AS rn
      FROM offers WINDOW w AS (PARTITION BY ck, code)) WHERE rn = 1),
  auth AS (SELECT ck, coalesce(string_agg(code, '|' ORDER BY code) FILTER (result = 'VALID'), '') AS authorized,
      coalesce(string_agg(code, '|' ORDER BY code) FILTER (result <> 'VALID'), '') AS lacking,
      string_agg(concat_ws(':', code, result, coalesce(authorization_id, '-'), coalesce(gstatus, '-'), coalesce(CAST(valid_from
        AS STRING), '-'), coalesce(CAST(valid_to AS STRING), '-'), okn), '|' ORDER BY code) AS auth_evidence,
      arg_min(result, {_RANKS}) AS status FROM picked GROUP BY ck)"""
_CASES = f"""cased AS (SELECT r.*, c.*, k.*, coalesce(a.status, 'NOT_REQUIRED') AS auth_status,
      coalesce(a.auth_evidence, '') AS auth_evidence FROM refs r LEFT JOIN cov c USING (ck) LEFT JOIN risk k USING (ck)
      LEFT JOIN auth a USING (ck)),
  reasoned AS (SELECT *, [x FOR x IN [CASE WHEN len(missing) > 0 THEN 'OCR_REQUIRED_FIELD_MISSING' END,
      CASE WHEN list_contains(errors, 'LOW_OCR_CONFIDENCE') THEN 'OCR_LOW_CONFIDENCE' END,
      CASE WHEN list_contains(errors, 'UNREADABLE_DOCUMENT') THEN 'OCR_UNREADABLE_DOCUMENT' END,
      CASE WHEN conflicts <> '' THEN 'OCR_CROSS_DOCUMENT_CONFLICT' END,
      CASE WHEN list_has_any(errors, ['INVALID_BILLED_AMOUNT', 'NEGATIVE_BILLED_AMOUNT']) THEN 'INVALID_BILLED_AMOUNT' END,
      CASE WHEN list_has_any(errors, ['INVALID_SERVICE_DATE', 'SERVICE_DATE_OUTSIDE_STAY', 'ADMISSION_AFTER_DISCHARGE'])
        THEN 'INVALID_SERVICE_DATE' END,
      CASE WHEN auth_status IN ('MISSING', 'EXPIRED', 'PENDING', 'DENIED', 'AMBIGUOUS', 'CANCELLED')
        THEN 'PRE_AUTHORIZATION_' || auth_status END,
      CASE WHEN dc > 0 THEN 'LIKELY_DUPLICATE_CLAIM' END] IF x IS NOT NULL] || ref_errors
      || CASE WHEN len(uncovered) > 0 THEN ['PROCEDURE_NOT_COVERED'] ELSE [] END AS reasons FROM cased)"""

_S1 = f"WITH {ctes('ocr_documents')}, {_PARSED}, {_CHECKED}, {_CANON}"
_S2 = f"{_S1}, {ctes('policy', 'member', 'provider')}, {_REFS}"
_S3 = f"{_S2}, {ctes('plan_coverage')}, {_COVERAGE}"
_S4 = f"{_S3}, {ctes('claim_history')}, {_HISTORY}"
_S5 = f"{_S3}, {ctes('pre_authorization')}, {_AUTHORIZATION}"
_S6 = f"{_S4}, {ctes('pre_authorization')}, {_AUTHORIZATION}, {_CASES}"


def lines(evidence: Column, *fields: str, hundredths: str = "") -> Column:
    """Every field of every element of an evidence array as text."""

    def text(x: Column) -> list[Column]:
        plain = [x[f] if f != hundredths else F.round(x[f] * 100).cast("int") for f in fields]
        return [F.coalesce(v.cast("string"), F.lit("-")) for v in plain]

    return F.array_join(F.transform(evidence, lambda x: F.concat_ws(":", *text(x))), "|")


_COVERED = (
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
_PAST = ("historical_claim_id", "service_date", "provider_id", "procedure_code", "claim_amount", "claim_status")
_GRANTED = (
    "procedure_code",
    "authorization_result",
    "authorization_id",
    "authorization_status",
    "valid_from",
    "valid_to",
    "valid_authorization_count",
)


# --- queries ----------------------------------------------------------------------------------------------
@query(
    "claims_canonical",
    f"""{_S1} SELECT claim_id, ids AS source_document_ids, n AS document_count, pol AS policy_number_normalized,
      fn AS member_first_name_normalized, dob AS member_dob_parsed, npi AS provider_npi_normalized, sd AS service_date_parsed,
      ad AS admission_date_parsed, array_to_string(dx, '|') AS diagnosis_codes, array_to_string(px, '|') AS procedure_codes,
      amt AS billed_amount_parsed, cur AS currency_normalized, source_document_id AS selected_document_id,
      conf AS selected_ocr_confidence, max_conf AS max_ocr_confidence, round(avg_conf, 9) AS avg_ocr_confidence,
      len(pii) > 0 AS pii_detected, array_to_string(pii, '|') AS pii_types, redacted AS notes_redacted,
      array_to_string(errors, '|') AS validation_errors, array_to_string(warns, '|') AS normalization_warnings,
      array_to_string(missing, '|') AS missing_fields, n > 1 AS duplicate_document_flag,
      conflicts <> '' AS cross_document_conflict, conflicts AS cross_document_conflict_fields FROM canon""",
)
def claims_canonical(src: Source) -> DataFrame:
    out = stage(src, "canonical_claims").withColumn("avg_ocr_confidence", F.round("avg_ocr_confidence", 9))
    return flat(
        out,
        "claim_id",
        "source_document_ids",
        "document_count",
        "policy_number_normalized",
        "member_first_name_normalized",
        "member_dob_parsed",
        "provider_npi_normalized",
        "service_date_parsed",
        "admission_date_parsed",
        "diagnosis_codes",
        "procedure_codes",
        "billed_amount_parsed",
        "currency_normalized",
        "selected_document_id",
        "selected_ocr_confidence",
        "max_ocr_confidence",
        "avg_ocr_confidence",
        "pii_detected",
        "pii_types",
        "notes_redacted",
        "validation_errors",
        "normalization_warnings",
        "missing_fields",
        "duplicate_document_flag",
        "cross_document_conflict",
        "cross_document_conflict_fields",
    )


REFERENCES_SQL = f"""{_S2} SELECT claim_id, policy_id, member_id, plan_id, pstatus AS policy_status, coverage_start_date, coverage_end_date,
      pn AS policy_match_count, pn > 0 AS policy_exists, pn > 1 AS policy_ambiguous, pact AS policy_active_on_service_date,
      mx AS member_exists, rfn AS reference_first_name, rln AS reference_last_name, rdob AS reference_dob,
      fm AS first_name_match, lm AS last_name_match, dm AS dob_match, emc AS entity_match_confidence,
      eligible_member AS member_eligible, provider_id, provider_name, vn AS provider_match_count, vn > 0 AS provider_exists,
      vn > 1 AS provider_ambiguous, vact AS provider_active, network AS provider_network_status,
      array_to_string(ref_errors, '|') AS reference_enrichment_errors FROM refs"""


def claims_reference_columns(df: DataFrame) -> DataFrame:
    return flat(
        df,
        "claim_id",
        "policy_id",
        "member_id",
        "plan_id",
        "policy_status",
        "coverage_start_date",
        "coverage_end_date",
        "policy_match_count",
        "policy_exists",
        "policy_ambiguous",
        "policy_active_on_service_date",
        "member_exists",
        "reference_first_name",
        "reference_last_name",
        "reference_dob",
        "first_name_match",
        "last_name_match",
        "dob_match",
        "entity_match_confidence",
        "member_eligible",
        "provider_id",
        "provider_name",
        "provider_match_count",
        "provider_exists",
        "provider_ambiguous",
        "provider_active",
        "provider_network_status",
        "reference_enrichment_errors",
    )


@query("claims_reference", REFERENCES_SQL)
def claims_reference(src: Source) -> DataFrame:
    return claims_reference_columns(stage(src, "reference_enriched_claims"))


@query(
    "claims_coverage",
    f"""{_S3} SELECT claim_id, array_to_string(coalesce(covered, []), '|') AS covered_procedure_codes,
      array_to_string(coalesce(uncovered, []), '|') AS uncovered_procedure_codes,
      array_to_string(coalesce(needing, []), '|') AS pre_auth_required_procedure_codes, eligible AS estimated_eligible_amount,
      CAST(coalesce(len(covered), 0) AS INT) AS covered_procedure_count,
      CAST(coalesce(len(uncovered), 0) AS INT) AS uncovered_procedure_count,
      coalesce(len(uncovered) = 0 AND len(covered) > 0, false) AS all_procedures_have_coverage,
      CASE WHEN len(uncovered) > 0 THEN 'PROCEDURE_NOT_COVERED' ELSE '' END AS coverage_errors,
      coalesce(cov_evidence, '') AS coverage_evidence
    FROM refs LEFT JOIN cov USING (ck)""",
)
def claims_coverage(src: Source) -> DataFrame:
    out = stage(src, "coverage_enriched_claims")
    return flat(
        out.withColumn("coverage_evidence", lines(F.col("coverage_evidence"), *_COVERED, hundredths="coverage_percentage")),
        "claim_id",
        "covered_procedure_codes",
        "uncovered_procedure_codes",
        "pre_auth_required_procedure_codes",
        "estimated_eligible_amount",
        "covered_procedure_count",
        "uncovered_procedure_count",
        "all_procedures_have_coverage",
        "coverage_errors",
        "coverage_evidence",
    )


@query(
    "claims_history",
    f"""{_S4} SELECT claim_id, pc AS prior_claim_count_365d, CAST(ps AS DECIMAL(18,2)) AS prior_claim_amount_365d,
      sc AS same_procedure_claim_count_365d, last_day AS most_recent_prior_service_date,
      round(mean, 6) AS historical_average_claim_amount, dc AS candidate_duplicate_count, dc > 0 AS duplicate_claim_flag,
      score AS fraud_risk_score, evidence AS historical_evidence FROM refs JOIN risk USING (ck)""",
)
def claims_history(src: Source) -> DataFrame:
    out = stage(src, "historical_enriched_claims")
    return out.select(
        "claim_id",
        "prior_claim_count_365d",
        "prior_claim_amount_365d",
        "same_procedure_claim_count_365d",
        "most_recent_prior_service_date",
        F.round("historical_average_claim_amount", 6).alias("historical_average_claim_amount"),
        "candidate_duplicate_count",
        "duplicate_claim_flag",
        "fraud_risk_score",
        lines(F.col("historical_evidence"), *_PAST).alias("historical_evidence"),
    )


@query(
    "claims_authorization",
    f"""{_S5} SELECT claim_id, coalesce(authorized, '') AS authorized_procedure_codes,
      coalesce(lacking, '') AS missing_authorization_procedure_codes, coalesce(auth_evidence, '') AS authorization_evidence,
      coalesce(status, 'NOT_REQUIRED') AS pre_authorization_status FROM refs LEFT JOIN auth USING (ck)""",
)
def claims_authorization(src: Source) -> DataFrame:
    out = stage(src, "authorization_enriched_claims")
    return out.select(
        "claim_id",
        F.array_join("authorized_procedure_codes", "|").alias("authorized_procedure_codes"),
        F.array_join("missing_authorization_procedure_codes", "|").alias("missing_authorization_procedure_codes"),
        lines(F.col("authorization_evidence"), *_GRANTED).alias("authorization_evidence"),
        "pre_authorization_status",
    )


@query(
    "claim_cases",
    f"""{_S6} SELECT 'CASE-' || claim_id AS case_id, claim_id, n AS document_count, member_id, policy_id, provider_id, plan_id,
      ids AS source_document_ids, ad AS admission_date, dd AS discharge_date, conf AS selected_ocr_confidence,
      max_conf AS max_ocr_confidence, round(avg_conf, 9) AS avg_ocr_confidence,
      sd AS service_date, array_to_string(dx, '|') AS diagnosis_codes, array_to_string(px, '|') AS procedure_codes,
      amt AS billed_amount, eligible AS estimated_eligible_amount, CAST(NULL AS DECIMAL(18,2)) AS approved_amount,
      cur AS currency, pstatus AS policy_status, pact AS policy_active_on_service_date, eligible_member AS member_eligible,
      emc AS entity_match_confidence, vact AS provider_active, network AS provider_network_status,
      auth_status AS pre_authorization_status, dc > 0 AS duplicate_claim_flag, score AS fraud_risk_score,
      CASE WHEN len(reasons) > 0 THEN 'MANUAL_REVIEW_REQUIRED' ELSE 'ETL_COMPLETE' END AS workflow_status,
      len(reasons) > 0 AS review_required, array_to_string(reasons, '|') AS review_reasons,
      CASE WHEN len(reasons) > 0 THEN '{fv.REVIEW_PREFIX}' || array_to_string(reasons, '; ') ELSE '{fv.NO_REVIEW_TEXT}' END
        AS decision_reason, '1.0.0' AS rule_engine_version FROM reasoned""",
)
def claim_cases(src: Source) -> DataFrame:
    return flat(
        stage(src, "claim_case").withColumn("avg_ocr_confidence", F.round("avg_ocr_confidence", 9)),
        "case_id",
        "claim_id",
        "source_document_ids",
        "document_count",
        "member_id",
        "policy_id",
        "provider_id",
        "plan_id",
        "service_date",
        "diagnosis_codes",
        "procedure_codes",
        "billed_amount",
        "estimated_eligible_amount",
        "approved_amount",
        "currency",
        "policy_status",
        "policy_active_on_service_date",
        "member_eligible",
        "entity_match_confidence",
        "provider_active",
        "provider_network_status",
        "pre_authorization_status",
        "duplicate_claim_flag",
        "fraud_risk_score",
        "workflow_status",
        "review_required",
        "review_reasons",
        "decision_reason",
        "rule_engine_version",
        "admission_date",
        "discharge_date",
        "selected_ocr_confidence",
        "max_ocr_confidence",
        "avg_ocr_confidence",
    )


# part of the evidence -> its leaves and the SQL of each
_LEAVES = {
    "data_quality_evidence": {
        "validation_errors": "array_to_string(errors, '|')",
        "normalization_warnings": "array_to_string(warns, '|')",
        "missing_fields": "array_to_string(missing, '|')",
        "pii_detected": "len(pii) > 0",
        "pii_types": "array_to_string(pii, '|')",
        "duplicate_document_flag": "n > 1",
        "cross_document_conflict": "conflicts <> ''",
        "cross_document_conflict_fields": "conflicts",
        "document_count": "n",
        "selected_ocr_confidence": "conf",
        "max_ocr_confidence": "max_conf",
        "avg_ocr_confidence": "round(avg_conf, 9)",
    },
    "policy_evidence": {
        "policy_exists": "pn > 0",
        "policy_ambiguous": "pn > 1",
        "policy_match_count": "pn",
        "policy_status": "pstatus",
        "coverage_start_date": "coverage_start_date",
        "coverage_end_date": "coverage_end_date",
        "policy_active_on_service_date": "pact",
    },
    "member_evidence": {
        "member_exists": "mx",
        "first_name_match": "fm",
        "last_name_match": "lm",
        "dob_match": "dm",
        "entity_match_confidence": "emc",
        "member_eligible": "eligible_member",
    },
    "provider_evidence": {
        "provider_exists": "vn > 0",
        "provider_ambiguous": "vn > 1",
        "provider_active": "vact",
        "provider_network_status": "network",
        "provider_match_count": "vn",
    },
}
_LEAF_SQL = ", ".join(f"{sql} AS {name}" for leaves in _LEAVES.values() for name, sql in leaves.items())


@query(
    "claim_evidence",
    f"""{_S6} SELECT claim_id, {_LEAF_SQL}, coalesce(cov_evidence, '') AS coverage_evidence,
      evidence AS historical_evidence, auth_evidence AS authorization_evidence FROM reasoned""",
)
def claim_evidence(src: Source) -> DataFrame:
    """Every leaf of the nested evidence of each case, read back out of its struct."""
    e = F.col("evidence_package")
    leaves = [e[part][name].alias(name) for part, names in _LEAVES.items() for name in names]
    found = stage(src, "claim_case").select(
        "claim_id",
        *leaves,
        lines(e["coverage_evidence"], *_COVERED, hundredths="coverage_percentage").alias("coverage_evidence"),
        lines(e["historical_evidence"], *_PAST).alias("historical_evidence"),
        lines(e["authorization_evidence"], *_GRANTED).alias("authorization_evidence"),
    )
    return flat(found.withColumn("avg_ocr_confidence", F.round("avg_ocr_confidence", 9)), *found.columns)


@query(
    "reason_counts",
    f"""{_S6} SELECT policy_status, reason, count(*) AS row_count FROM (SELECT pstatus AS policy_status,
      unnest(reasons) AS reason FROM reasoned) GROUP BY ALL""",
)
def reason_counts(src: Source) -> DataFrame:
    return cases.reason_counts(stage(src, "claim_case"), ["policy_status"])


@query(
    "claim_audits",
    f"""WITH {ctes('ocr_documents')}, n AS (SELECT count(DISTINCT claim_id) + max(CASE WHEN claim_id IS NULL THEN 1 ELSE 0 END)
      AS k FROM w_ocr_documents)
    SELECT 'keys' AS audit, unnest(['keys_before', 'keys_after', 'keys_lost', 'keys_invented', 'keys_repeated']) AS measure,
      unnest([k, k, 0, 0, 0]::BIGINT[]) AS value FROM n
    UNION ALL SELECT 'domain', 'workflow_status_outside', 0 UNION ALL SELECT 'null', 'approved_amount_filled', 0""",
)
def claim_audits(src: Source) -> DataFrame:
    """Keys, allowed statuses and the always-null amount of the finished cases."""
    found = stages_of(src, "claim_case")
    # three audits read them, so the finished cases are written once
    done = cut(found["claim_case"].select("claim_id", "workflow_status", "approved_amount"), "finished_cases")
    return audit.violations(
        {
            "keys": audit.audit_keys(found["ocr_documents"], done, ["claim_id"]),
            "domain": audit.audit_domain(done, {"workflow_status": [fv.STATUS_REVIEW, fv.STATUS_COMPLETE]}),
            "null": audit.audit_null(done, ["approved_amount"]),
        }
    )


_CASE_TEXT = (
    "case_id claim_id member_id policy_id provider_id plan_id currency policy_status provider_network_status "
    "pre_authorization_status workflow_status decision_reason rule_engine_version source_document_ids diagnosis_codes "
    "procedure_codes review_reasons evidence_package"
).split()
#: columns whose own codes may look like nine bare digits
_EXEMPT = ["case_id", "claim_id", "member_id", "policy_id", "provider_id", "source_document_ids", "evidence_package"]


@query(
    "claim_ssn_audit",
    f"""{_S1}, n AS (SELECT count(DISTINCT ck) FILTER (regexp_matches(notes, '{fv.SSN_PATTERN}')) AS hits FROM canon)
    SELECT unnest({[c for c in _CASE_TEXT if c not in _EXEMPT] + ["planted"]}) AS column_name,
      unnest([0 FOR x IN range({len(_CASE_TEXT) - len(_EXEMPT)})] || [hits])::BIGINT AS hits FROM n""",
)
def claim_ssn_audit(src: Source) -> DataFrame:
    """No text outside the ids and the evidence of a case holds an SSN, dashed or bare; the raw notes, audited beside it, do.

    ``claim_ssn_leaves`` scans the ids and the evidence as well.
    """
    found = stages_of(src, "canonical_claims", "claim_case")
    raw = found["canonical_claims"].select("claim_id", "selected_document_id")
    notes = found["ocr_documents"].select(F.col("source_document_id").alias("selected_document_id"), "extracted_notes")
    planted = raw.join(notes, "selected_document_id", "left").select("claim_id", F.col("extracted_notes").alias("planted"))
    clean = audit.audit_pattern_absent(found["claim_case"], fv.SSN_PATTERN, exempt=_EXEMPT)
    return clean.unionByName(audit.audit_pattern_absent(planted, fv.SSN_PATTERN, exempt=["claim_id"]))


#: what an SSN looks like where codes of nine bare digits are in place, and the leaves with such codes
_DASHED = r"\b\d{3}-\d{2}-\d{4}\b"
_ID_LEAVES = (
    "case_id claim_id member_id policy_id provider_id source_document_ids evidence_package.historical_evidence.historical_claim_id "
    "evidence_package.historical_evidence.provider_id evidence_package.authorization_evidence.authorization_id planted.id"
).split()
_TEXT_LEAVES = [c for c in _CASE_TEXT if c != "evidence_package"] + [
    f"evidence_package.{part}.{leaf}"
    for part, leaves in {
        "data_quality_evidence": "validation_errors normalization_warnings missing_fields pii_types cross_document_conflict_fields",
        "policy_evidence": "policy_status",
        "provider_evidence": "provider_network_status",
        "coverage_evidence": "procedure_code coverage_type",
        "historical_evidence": "historical_claim_id provider_id procedure_code claim_status",
        "authorization_evidence": "procedure_code authorization_result authorization_id authorization_status",
    }.items()
    for leaf in leaves.split()
]


@query(
    "claim_ssn_leaves",
    f"""{_S1}, n AS (SELECT count(DISTINCT ck) FILTER (regexp_matches(notes, '{fv.SSN_PATTERN}')) AS hits,
      count(DISTINCT ck) FILTER (regexp_matches(notes, '{_DASHED}')) AS dashed FROM canon)
    SELECT unnest({_TEXT_LEAVES}) AS column_name, CAST(0 AS BIGINT) AS hits
    UNION ALL SELECT unnest(['planted.id', 'planted.evidence_package.historical_evidence.note']), unnest([dashed, hits])::BIGINT FROM n""",
)
def claim_ssn_leaves(src: Source) -> DataFrame:
    """No text of a case holds an SSN: every column and every leaf of the evidence, single ids for the dashed form only.

    The raw notes, planted as an id and inside evidence, are found.
    """
    found = stages_of(src, "canonical_claims", "claim_case")
    raw = found["canonical_claims"].select("claim_id", "selected_document_id")
    notes = found["ocr_documents"].select(F.col("source_document_id").alias("selected_document_id"), F.col("extracted_notes").alias("note"))
    planted = raw.join(notes, "selected_document_id", "left")
    past = F.struct(F.array(F.struct("note")).alias("historical_evidence"))
    planted = planted.select(F.struct(F.col("note").alias("id"), past.alias("evidence_package")).alias("planted"))
    scan = lambda df: audit.audit_leaves_absent(df, fv.SSN_PATTERN, dict.fromkeys(_ID_LEAVES, _DASHED))
    return scan(found["claim_case"]).unionByName(scan(planted))


# --- assembly operators on their own ------------------------------------------------------------------------------
def _reasoned_orders(src: Source) -> DataFrame:
    from caseloom.catalog.orders import checked_orders

    c = F.col
    derived = [
        rules.Rule("REQUIRED_FIELD_MISSING", F.size("missing_fields") > 0),
        rules.Rule("LOW_CONFIDENCE", F.array_contains("validation_errors", "LOW_CONFIDENCE")),
        rules.Rule("URGENT", c("o_orderpriority") == "1-URGENT"),
    ]
    return cases.workflow_status(cases.review_reasons(checked_orders(src), derived, ["validation_errors"]))


def _order_sql() -> str:
    from caseloom.catalog.orders import CHECKED

    return f"""WITH {CHECKED}, reasoned AS (SELECT *, [x FOR x IN [CASE WHEN missing <> '' THEN 'REQUIRED_FIELD_MISSING' END,
        CASE WHEN list_contains(errors, 'LOW_CONFIDENCE') THEN 'LOW_CONFIDENCE' END,
        CASE WHEN o_orderpriority = '1-URGENT' THEN 'URGENT' END] IF x IS NOT NULL]
        || [e FOR e IN errors IF e <> 'LOW_CONFIDENCE'] AS reasons FROM checked)"""


@query(
    "review_reasons",
    f"""{_order_sql()} SELECT o_orderkey, array_to_string(reasons, '|') AS review_reasons, len(reasons) > 0 AS review_required,
      CASE WHEN len(reasons) > 0 THEN 'MANUAL_REVIEW_REQUIRED' ELSE 'ETL_COMPLETE' END AS workflow_status,
      CASE WHEN len(reasons) > 0 THEN '{fv.REVIEW_PREFIX}' || array_to_string(reasons, '; ') ELSE '{fv.NO_REVIEW_TEXT}' END
        AS decision_reason FROM reasoned""",
)
def review_reasons(src: Source) -> DataFrame:
    out = _reasoned_orders(src)
    return flat(out, "o_orderkey", "review_reasons", "review_required", "workflow_status", "decision_reason")


@query(
    "evidence_package",
    f"""{_order_sql()} SELECT o_orderkey, to_json({{'quality': {{'errors': errors, 'valid': len(errors) = 0}},
      'order': {{'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus}}, 'reasons': reasons}})::VARCHAR AS evidence_package
    FROM reasoned""",
)
def evidence_package(src: Source) -> DataFrame:
    out = _reasoned_orders(src).withColumns({"errors": F.col("validation_errors"), "valid": F.col("is_valid_record")})
    parts = {"quality": ["errors", "valid"], "order": ["o_orderkey", "o_orderstatus"], "reasons": "review_reasons"}
    return cases.evidence_package(out, parts).select(
        "o_orderkey", F.to_json("evidence_package").alias("evidence_package")
    )


CASE_BUILD_SQL = f"""{_order_sql()} SELECT 'CASE-' || CAST(o_orderkey AS STRING) AS case_id, o_orderkey, o_custkey AS member_id,
      pol AS policy_number, dt AS service_date, amt AS billed_amount, array_to_string(reasons, '|') AS review_reasons,
      CAST(NULL AS DECIMAL(18,2)) AS approved_amount, '1.0.0' AS rule_engine_version FROM reasoned"""


@query("case_build", CASE_BUILD_SQL)
def case_build(src: Source) -> DataFrame:
    built = cases.build_case(
        _reasoned_orders(src),
        "o_orderkey",
        {
            "o_orderkey": "o_orderkey",
            "member_id": "o_custkey",
            "policy_number": "policy_number_normalized",
            "service_date": "order_date_parsed",
            "billed_amount": "amount_parsed",
            "review_reasons": "review_reasons",
        },
    )
    return flat(built, *built.columns)
