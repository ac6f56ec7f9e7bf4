"""Personal data in the whole texts of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.catalog import Source, query
from caseloom.operators import pii

PATTERNS = {
    "SSN_IN_NOTES": ("text", fv.SSN_PATTERN),
    "PHONE_IN_NOTES": ("text", fv.PHONE_PATTERN),
}
_TYPES = f"""[x FOR x IN [CASE WHEN regexp_matches(text, '{fv.SSN_PATTERN}') THEN 'SSN_IN_NOTES' END,
  CASE WHEN regexp_matches(text, '{fv.PHONE_PATTERN}') THEN 'PHONE_IN_NOTES' END] IF x IS NOT NULL]"""
_REDACTED = f"""regexp_replace(regexp_replace(text, '{fv.SSN_PATTERN}', '{fv.SSN_MASK}', 'g'),
  '{fv.PHONE_PATTERN}', '{fv.PHONE_MASK}', 'g')"""


def found(src: Source) -> DataFrame:
    return pii.detect_pii(src.documents, {}, PATTERNS)


@query(
    "pii_detect",
    f"SELECT doc_id, array_to_string({_TYPES}, '|') AS pii_types, len({_TYPES}) > 0 AS pii_detected FROM documents",
)
def pii_detect(src: Source) -> DataFrame:
    return found(src).select("doc_id", F.array_join("pii_types", "|").alias("pii_types"), "pii_detected")


@query(
    "pii_redact",
    f"""SELECT doc_id, sha256({_REDACTED}) AS text_hash, CAST(length({_REDACTED}) AS INT) AS text_length FROM documents""",
)
def pii_redact(src: Source) -> DataFrame:
    masked = pii.redact(src.documents, "text", "masked")
    return masked.select("doc_id", F.sha2("masked", 256).alias("text_hash"), F.length("masked").alias("text_length"))


@query(
    "pii_summary",
    f"""SELECT lang, source, pii_type, count(*) AS row_count
      FROM (SELECT lang, source, unnest({_TYPES}) AS pii_type FROM documents) GROUP BY ALL""",
)
def pii_summary(src: Source) -> DataFrame:
    return pii.pii_summary(found(src), ["lang", "source"])


_SSN = "'123-45-' || lpad(CAST(doc_id % 10000 AS STRING), 4, '0')"
_CALL = "'call 555-201-' || lpad(CAST(doc_id % 10000 AS STRING), 4, '0')"


def _nested(src: Source) -> DataFrame:
    """Documents with their lines, and personal data in a struct, a list of structs, and the keys and values of a map."""
    ssn, call = F.expr(_SSN), F.expr(_CALL)
    return src.documents.select(
        "doc_id",
        F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("no"), x.alias("said"))).alias("lines"),
        F.struct(F.col("source").alias("name"), F.when(F.col("doc_id") % 3 == 0, ssn).alias("ssn"), call.alias("kept")).alias("origin"),
        F.map_from_arrays(F.array(call, F.lit("lang"), F.concat(F.lit("again "), call)), F.array("source", "lang", ssn)).alias("contact"),
    )


def _sql_masked(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '{fv.SSN_PATTERN}', '{fv.SSN_MASK}', 'g'), '{fv.PHONE_PATTERN}', '{fv.PHONE_MASK}', 'g')"


def _sql_hits(text: str) -> str:
    left = f"regexp_replace({text}, '{fv.SSN_PATTERN}', '{fv.SSN_MASK}', 'g')"
    return f"len(regexp_extract_all({text}, '{fv.SSN_PATTERN}')) + len(regexp_extract_all({left}, '{fv.PHONE_PATTERN}'))"


_LINES = "string_split(text, chr(10))"


@query(
    "redact_leaves",
    f"""SELECT doc_id, sha256(array_to_string([{_sql_masked('x')} FOR x IN {_LINES}], chr(10))) AS text_hash, source AS origin_name,
      CASE WHEN doc_id % 3 = 0 THEN '{fv.SSN_MASK}' END AS origin_ssn, {_CALL} AS origin_kept,
      array_to_string(['call {fv.PHONE_MASK} #0', 'lang', 'again call {fv.PHONE_MASK} #2'], '|') AS contact_keys,
      array_to_string([source, lang, '{fv.SSN_MASK}'], '|') AS contact_values,
      array_to_string(['contact.key=2', 'contact.value=1'] || CASE WHEN h > 0 THEN ['lines.said=' || CAST(h AS STRING)] ELSE [] END
        || CASE WHEN doc_id % 3 = 0 THEN ['origin.ssn=1'] ELSE [] END, '|') AS redactions
    FROM (SELECT *, CAST(list_sum([{_sql_hits('x')} FOR x IN {_LINES}]) AS BIGINT) AS h FROM documents)""",
)
def redact_leaves(src: Source) -> DataFrame:
    """Masks in every leaf but one, and how many by path."""
    masked = pii.redact_leaves(_nested(src), exempt=["origin.kept"])
    told = F.transform(F.map_entries("redactions"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return masked.select(
        "doc_id",
        F.sha2(F.array_join("lines.said", "\n").cast("binary"), 256).alias("text_hash"),
        F.col("origin.name").alias("origin_name"),
        F.col("origin.ssn").alias("origin_ssn"),
        F.col("origin.kept").alias("origin_kept"),
        F.array_join(F.map_keys("contact"), "|").alias("contact_keys"),
        F.array_join(F.map_values("contact"), "|").alias("contact_values"),
        F.array_join(F.array_sort(told), "|").alias("redactions"),
    )


@query(
    "redaction_summary",
    f"""WITH h AS (SELECT lang, {_sql_hits('text')} AS text, {_sql_hits('source')} AS source FROM documents)
    SELECT lang, path, count(*) AS row_count, CAST(sum(n) AS BIGINT) AS mask_count FROM
      (SELECT lang, unnest(['text', 'source']) AS path, unnest([text, source]) AS n FROM h) WHERE n > 0 GROUP BY lang, path""",
)
def redaction_summary(src: Source) -> DataFrame:
    masked = pii.redact_leaves(src.documents.select("lang", "source", "text"), exempt=["lang"])
    return pii.redaction_summary(masked, ["lang"])
