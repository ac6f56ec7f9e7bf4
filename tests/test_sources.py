"""CSV in and out: text survives, types come back, nothing is inferred."""

from datetime import date
from decimal import Decimal

import pytest

from caseloom.sources import lineage, schemas, tables


def test_raw_scan_keeps_bad_values_and_adds_ingest_columns(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('a,b\n"x\ny",007\n,""\n"say ""hi""",1\n')
    df = tables.read_raw(spark, str(path), ["a", "b"])
    got = df.collect()
    assert [(r["a"], r["b"]) for r in got] == [("x\ny", "007"), (None, None), ('say "hi"', "1")]
    assert all(r["source_file"].endswith("raw.csv") and r["ingested_at"] for r in got)
    assert len({r["record_hash"] for r in got}) == 3


def test_shifted_nulls_hash_differently(spark):
    df = spark.createDataFrame([("x", None), (None, "x")], "a string, b string")
    assert df.select(tables.row_hash(["a", "b"])).distinct().count() == 2


def test_reference_scan_uses_the_declared_types(spark, tmp_path):
    path = tmp_path / "plan.csv"
    path.write_text(
        "plan_id,procedure_code,coverage_type,coverage_percentage,deductible_amount,copay_amount,requires_pre_authorization\n"
        "P,00700,LAB,0.5,250.00,oops,true\n"
    )
    row = tables.read_reference(spark, str(path), schemas.PLAN_COVERAGE).first()
    assert (row["procedure_code"], row["deductible_amount"], row["copay_amount"]) == ("00700", Decimal("250.00"), None)
    assert row["requires_pre_authorization"] is True


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json"])
def test_stage_round_trip(spark, tmp_path, fmt):
    schema = "k string, d date, n int, f boolean, m decimal(18,2), l array<string>, s struct<a:int,b:string>, e array<struct<c:string>>"
    data = [
        ('a "q"\n, b', date(2024, 1, 2), 1, True, Decimal("1.50"), ["x", "y"], (1, "z"), [("c1",)]),
        (None, None, None, None, None, [], (None, None), []),
        ("no lists", None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(data, schema)
    path = str(tmp_path / fmt)
    tables.write_stage(df, path, fmt)
    tables.write_stage(df, path, fmt)
    back = tables.read_stage(spark, path, fmt, df.schema if fmt in ("csv", "json") else None)
    assert back.dtypes == df.dtypes
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_csv_stage_needs_its_schema(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.read_stage(spark, str(tmp_path), "csv")


def test_cut_reads_back_the_same_rows(spark):
    back = lineage.cut(spark.range(5), "t")
    folder = lineage.shared_folder(spark)
    assert sorted(r["id"] for r in back.collect()) == [0, 1, 2, 3, 4]
    assert all(f"{folder}/caseloom/" in f for f in back.inputFiles())


def test_the_shared_folder_is_used_and_cleared(spark, tmp_path, monkeypatch):
    named = spark.conf.get(lineage.SETTING, None)
    assert lineage.shared_folder(spark).startswith(named or spark.conf.get("spark.sql.warehouse.dir"))
    monkeypatch.setattr(lineage, "shared_folder", lambda _: str(tmp_path))
    lineage.cut(spark.range(3), "t")
    assert list(tmp_path.rglob("*.parquet"))
    lineage.clear(spark)
    assert not list(tmp_path.rglob("*.parquet"))


def test_bucketed_tables_join_without_a_shuffle_and_can_be_cleared(spark, tmp_path):
    write = lineage.bucketed(["k"], 4)
    rows = spark.createDataFrame([(i % 20 or None, i) for i in range(200)], "k int, v int")
    a, b = write(rows, "a"), write(rows.groupBy("k").count(), "b")
    assert rows.count() == a.count()
    joined = a.join(b, "k", "left")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.where("k = 3").count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert write(rows.select("v"), "c").count() == 200  # no key: written as by ``cut``
    tables_ = list(lineage._tables)
    lineage.clear(spark)
    assert not lineage._tables and not any(spark.catalog.tableExists(t) for t in tables_)


def test_a_cluster_needs_a_shared_folder():
    local = {lineage.SETTING: None, "spark.sql.warehouse.dir": "file:/tmp/warehouse"}
    fake = lambda master, conf: type("S", (), {"conf": type("C", (), {"get": staticmethod(lambda k, d=None: conf.get(k) or d)}), "sparkContext": type("X", (), {"master": master})})
    assert lineage.shared_folder(fake("local[4]", local)) == "file:/tmp/warehouse/_shared"
    assert lineage.shared_folder(fake("yarn", local | {lineage.SETTING: "hdfs://a/b"})) == "hdfs://a/b"
    assert lineage.shared_folder(fake("yarn", local | {"spark.sql.warehouse.dir": "hdfs://a/w"})) == "hdfs://a/w/_shared"
    with pytest.raises(RuntimeError, match=lineage.SETTING):
        lineage.shared_folder(fake("yarn", local))
