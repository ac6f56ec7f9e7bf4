"""Raw documents are dealt out by claim before they are parsed, those of the largest claims folded first."""

import random

import pytest
from pyspark.sql import functions as F

from caseloom.functions.lists import collect_lists, gather_lists
from caseloom.plans import claims
from caseloom.sources.schemas import INPUTS


def documents(spark):
    rng = random.Random(3)
    names = INPUTS["ocr_documents"].fieldNames()
    rows = []
    for i in range(400):
        row = dict.fromkeys(names)
        row |= {
            "source_document_id": f"D-{i}" if i % 41 else None,
            "claim_id": rng.choice([*[None] * 20, *["HOT"] * 20, "", *(f"C-{n}" for n in range(120))]),
            "policy_number": rng.choice(["POL-1", " pol-2", None]),
            "diagnosis_codes": rng.choice(["E11.9|K219", "E11.9; Z00.0", None]),
            "procedure_codes": rng.choice(["70001|70002", "70003", "", "70002,70001"]),
            "billed_amount": rng.choice(["10.00", "$ 12", "n/a"]),
            "ocr_confidence": rng.choice(["0.9", "0.8", "x"]),
            "extracted_notes": rng.choice(["SSN 123-45-6789", None]),
        }
        rows.append(tuple(row[n] for n in names))
    return spark.createDataFrame(rows, INPUTS["ocr_documents"])


@pytest.mark.parametrize(("many", "most"), [(1, 1024), (5, 2), (5, 1024)])
def test_claims_are_the_same_however_many_count_as_large(spark, monkeypatch, many, most):
    docs = documents(spark)
    want = sorted(map(str, claims.canonical_claims(docs).collect()))
    assert len(want) == docs.select("claim_id").distinct().count()
    monkeypatch.setattr(claims, "MANY_DOCUMENTS", many)
    monkeypatch.setattr(claims, "LARGE_CLAIMS", most)
    large = {r[0]: r for r in claims._large_claims(claims._keyed(docs)).collect()}
    assert {"", "=HOT"} <= set(large) and len(large) <= most
    assert sorted(map(str, claims.canonical_claims(docs).collect())) == want


def test_claims_are_those_of_documents_folded_at_once(spark):
    """Claims of one document, of some, of many; the schema as well."""
    docs = documents(spark)
    by_key, at_once = claims._canonical_by_key(docs), claims._canonical_by_key(docs, apart=False)
    assert by_key.dtypes == at_once.dtypes
    assert sorted(map(str, by_key.collect())) == sorted(map(str, at_once.collect()))
    assert {r["document_count"] == 1 for r in by_key.collect()} == {True, False}


def test_documents_are_shuffled_before_they_are_parsed(spark):
    """Parsed documents of claims that are not large travelled before, each with three times the bytes."""
    plan = claims._canonical_by_key(documents(spark))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("partial_min_by") :]
    assert "REPARTITION_BY_COL" in below[below.index("Exchange") :].splitlines()[0]


def test_lists_gathered_at_once_are_those_made_distinct_first(spark):
    df = spark.createDataFrame([("a", ["y", "x", None]), ("a", ["x"]), ("a", None), ("b", []), ("c", [None])], "k string, v array<string>")
    want = {r["k"]: r["v"] for r in collect_lists(df, ["k"], {"v": F.col("v")}).collect()}
    assert {r["k"]: r["v"] for r in gather_lists(df, ["k"], {"v": F.col("v")}).collect()} == {"b": [], "c": []} | want
