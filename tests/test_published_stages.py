"""Stages appear as a whole, and run again only where their inputs have changed."""

import pytest
from pyspark.sql import functions as F

from caseloom.plans import claims
from caseloom.sources import manifests, stages, tables
from caseloom.sources.schemas import INPUTS, OCR_COLUMNS
from claim_fixture import claim_inputs

DATA = [("a", 1, ["x", "y"], (1, "z")), (None, None, None, None), ("a", 1, [], (None, None)), ("a", 1, [], (None, None))]
SCHEMA = "k string, n int, l array<string>, s struct<a:int,b:string>"


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json"])
def test_published_stages_read_back(spark, tmp_path, fmt):
    df, folder = spark.createDataFrame(DATA, SCHEMA), str(tmp_path / "stage")
    assert stages.publish_stage(df.where("false"), folder, fmt) == 0
    assert rows(stages.read_published(spark, folder)) == [] and stages.read_published(spark, folder).dtypes == df.dtypes
    assert stages.publish_stage(df, folder, fmt) == 4
    back = stages.read_published(spark, folder)
    assert back.dtypes == df.dtypes and rows(back) == rows(df)
    with pytest.raises(FileNotFoundError):
        stages.read_published(spark, str(tmp_path / "none"))


def test_a_crash_in_the_middle_leaves_the_stage_as_it_was(spark, tmp_path):
    folder, good = str(tmp_path / "stage"), spark.createDataFrame(DATA, SCHEMA)
    stages.publish_stage(good, folder, fingerprint="one")
    bad = spark.range(100).select(F.col("id").cast("string").alias("k"), F.raise_error(F.lit("lost")).cast("int").alias("n"))
    with pytest.raises(Exception, match="lost"):
        stages.publish_stage(bad, folder, fingerprint="two")
    assert rows(stages.read_published(spark, folder)) == rows(good)
    assert manifests.latest(spark, folder)[1]["fingerprint"] == "one"
    assert len(stages.vacuum_stage(spark, folder)) == 1
    assert rows(stages.read_published(spark, folder)) == rows(good)


def test_a_stage_runs_again_only_if_an_input_or_its_logic_changed(spark, tmp_path):
    landed, first, second = (str(tmp_path / n) for n in ("landed", "first", "second"))
    tables.write_stage(spark.range(10).toDF("k"), landed)
    runs = []

    def once(logic="1"):
        def double():
            runs.append("first")
            return spark.read.parquet(landed).selectExpr("k * 2 AS k")

        def total():
            runs.append("second")
            return stages.read_published(spark, first).selectExpr("sum(k) AS k")

        runs.clear()
        stages.resume_stage(spark, first, {"landed": landed}, f"double {logic}", double)
        stages.resume_stage(spark, second, {"before": first}, "total", total)
        return list(runs), stages.read_published(spark, second).first()["k"]

    assert once() == (["first", "second"], 90)
    assert once() == ([], 90)
    tables.write_stage(spark.range(11).toDF("k"), landed)
    assert once() == (["first", "second"], 110)
    assert once("2") == (["first", "second"], 110)
    stages.publish_stage(spark.range(3).toDF("k"), first, fingerprint="by hand")
    assert once("2") == (["first", "second"], 110)
    assert once("2") == ([], 110)


def test_the_claims_flow_resumes_where_a_reference_changed(spark, tmp_path):
    world = claim_inputs(spark)
    paths = {name: str(tmp_path / "landed" / name) for name in INPUTS}
    for name, path in paths.items():
        tables.write_stage(world[name].select(*OCR_COLUMNS) if name == "ocr_documents" else world[name], path, "csv")
    run = lambda: claims.resume_stages(spark, str(tmp_path / "out"), paths, "coverage_enriched_claims")
    order = ["canonical_claims", "reference_enriched_claims", "coverage_enriched_claims"]
    assert run() == order
    assert run() == []
    got = stages.read_published(spark, f"{tmp_path}/out/coverage_enriched_claims")
    world["ocr_documents"] = tables.read_raw(spark, paths["ocr_documents"], OCR_COLUMNS)  # text knows no empty fields
    whole = claims.claim_cases(world, "coverage_enriched_claims")
    keep = [c for c in whole.columns if c not in ("ingested_at", "source_file", "record_hash")]
    text = lambda df: sorted(df.select(F.to_json(F.struct(*[c for c in keep if c in df.columns])).alias("t")).toPandas()["t"])
    assert text(got) == text(whole)
    tables.write_stage(world["plan_coverage"].limit(1), paths["plan_coverage"], "csv")
    assert run() == ["coverage_enriched_claims"]
    tables.write_stage(world["member"].limit(1), paths["member"], "csv")
    assert run() == order[1:]
