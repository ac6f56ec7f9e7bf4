"""What the claims flow writes, shuffles and runs once."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from caseloom.catalog import claims as catalog
from caseloom.plans import claims
from caseloom.sources.schemas import INPUTS


@pytest.fixture
def one_run(spark, monkeypatch):
    """The catalog over three stages of made rows; a list of the runs of the flow and whether each wrote between stages."""
    runs = []
    docs = spark.createDataFrame([("D-1", "C-1", "SSN 123-45-6789"), ("D-2", None, None)], "source_document_id string, claim_id string, extracted_notes string")
    canonical = docs.select("claim_id", F.col("source_document_id").alias("selected_document_id"))
    texts = [F.lit("x").alias(c) for c in catalog._CASE_TEXT if c not in ("claim_id", "workflow_status")]
    case = docs.select("claim_id", *texts, F.lit("ETL_COMPLETE").alias("workflow_status"), F.lit(None).cast("decimal(18,2)").alias("approved_amount"))

    def staged(inputs, between=None):
        runs.append(between is not None)
        yield "canonical_claims", canonical
        yield "claim_case", case

    monkeypatch.setattr(catalog, "claim_world", lambda src: {"ocr_documents": docs})
    monkeypatch.setattr(claims, "claim_stages", staged)
    return runs


@pytest.mark.parametrize("query", ["claim_audits", "claim_ssn_audit", "claim_ssn_leaves"])
def test_an_audit_runs_the_flow_once_and_writes_between_its_stages(spark, one_run, query):
    found = {tuple(r)[:-1]: r[-1] for r in getattr(catalog, query)(SimpleNamespace(spark=spark)).collect()}
    assert one_run == [True]
    if query == "claim_audits":
        assert found["keys", "keys_before"] == found["keys", "keys_after"] == 2 and found["domain", "workflow_status_outside"] == 0
    elif query == "claim_ssn_audit":
        assert found["planted",] == 1 and found["workflow_status",] == 0
    else:
        assert found["planted.id",] == 1 and found["claim_id",] == 0


def test_canonical_claims_are_bucketed_without_another_shuffle(spark):
    docs = spark.createDataFrame([], INPUTS["ocr_documents"])
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def shuffles(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    table = claims._canonical_by_key(docs)
    assert "claim_key" in table.columns
    assert shuffles(table.repartition(n, *claims.KEY)) == shuffles(table)
