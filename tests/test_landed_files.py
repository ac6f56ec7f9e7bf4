"""CSV stages land as many files, so that no task reads or makes most of a feed."""

from caseloom.catalog import Source
from caseloom.catalog import stages as queries
from caseloom.catalog.world import claim_world
from caseloom.sources import tables
from caseloom.sources.schemas import OCR_COLUMNS, all_strings


def _files(folder):
    return [f for f in folder.iterdir() if f.name.endswith(".csv")]


def test_one_partition_lands_as_several_files_with_the_same_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "FILE_ROWS", 10, raising=False)
    rows = [(str(n), None if n % 5 == 0 else f'a "quoted", line\nand {n}') for n in range(35)]
    df = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    tables.write_stage(df, f"{tmp_path}/landed", "csv")
    assert len(_files(tmp_path / "landed")) == 4
    back = tables.read_stage(spark, f"{tmp_path}/landed", "csv", all_strings(["a", "b"]))
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_documents_are_dealt_out_whatever_file_the_orders_are_in(spark, tmp_path, capsys):
    orders = [(k if k % 7 else None, k % 5, "O", 100.0 + k, f"1995-01-{k % 28 + 1:02d}", "1-URGENT" if k % 3 else "5-LOW") for k in range(40)]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string"
    spark.createDataFrame(orders, schema).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    others = {
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double", (1, "s", 2, 3.0)),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_mktsegment string", (1, "c", 2, "BUILDING")),
        "part": ("p_partkey long, p_type string, p_size int", (1, "p", 2)),
    }
    for name, (schema, row) in others.items():
        spark.createDataFrame([row], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    src = Source(spark, str(tmp_path))
    dealt = queries._documents(src)
    dealt.explain(True)
    assert "RebalancePartitions" in capsys.readouterr().out
    world = claim_world(src)["ocr_documents"].select(*OCR_COLUMNS)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, world.collect()))
