"""The pipeline's stages on the smallest tables, each on its own input, and the registered queries."""

import itertools
import os
import shutil
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from caseloom.llm import decontaminate, mixing, near_duplicates, quality, registry, shared, words
from caseloom.sources import lineage

ROOT = Path(__file__).resolve().parents[2]
FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def shingles(text):
    return set(words.shingles(pa.array([text or ""], pa.string()))[1].tolist())


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What goes into each stage, and the last stage's rows."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    folder, out = tmp_path_factory.mktemp("stages"), [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], FOLDER).write.parquet(str(folder / name))
        out.append(spark.read.parquet(str(folder / name)))
    return out


def test_stages_return_the_columns_of_documents(kept):
    assert all(sorted(df.columns) == sorted(kept[0].columns) for df in kept[:-1])
    assert sorted(kept[-1].columns) == ["doc_id", "ids_crc32", "n_tokens", "start"]


def test_quality_keeps_good_documents(spark, kept):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    held = {r["doc_id"] for r in kept[0].where(quality.held_out()).select("doc_id").collect()}
    left = {r["doc_id"] for r in kept[1].select("doc_id").collect()}
    right = [(i in left) == (labels[i] == 1) for i in labels if i in held]
    assert len(right) > 10 and np.mean(right) > 0.95


def test_one_document_of_each_group_of_near_copies_stays(kept):
    before = {r["doc_id"]: shingles(r["text"]) for r in kept[1].collect()}
    left = {r["doc_id"] for r in kept[2].collect()}
    parent = {i: i for i in before}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(before, 2):
        a, b = before[i], before[j]
        if a and b and len(a & b) >= 0.8 * len(a | b):
            parent[max(find(i), find(j))] = min(find(i), find(j))
    assert left == {find(i) for i in before}
    assert len(left) < len(before)


def test_no_document_with_a_benchmark_item_stays(spark, kept):
    items = [q for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect() if (q := shingles(r["text"]))]
    holds = {r["doc_id"]: any(len(q & s) >= 0.8 * len(q) for q in items) for r in kept[2].collect() for s in [shingles(r["text"])]}
    assert {r["doc_id"] for r in kept[3].collect()} == {i for i, bad in holds.items() if not bad}


def test_the_mix_is_carried_out(kept):
    plan = {r["doc_id"]: r["copies"] for r in mixing.mixed(kept[3]).collect()}
    got = {}
    for r in kept[4].collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {i: n for i, n in plan.items() if n}


def test_every_copy_is_encoded(kept):
    assert sorted(r["doc_id"] for r in kept[5].collect()) == sorted(r["doc_id"] for r in kept[4].collect())


def test_run_is_the_stages_in_a_row(spark, kept):
    got = sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).select(*kept[5].columns).collect()))
    assert got == sorted(map(tuple, kept[5].collect()))


def test_reruns_agree(spark):
    for name in ("op2_decontaminate", "op7_near_duplicates", "op10_quality"):
        first, again = (sorted(map(repr, registry.QUERIES[name](spark, FOLDER).collect())) for _ in range(2))
        assert first == again


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0


def test_nulls_and_awkward_texts_go_through(spark, kept):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "word " * 50_000, None, None, 5), (None, "some words", "en", "b", 1)]
    docs = spark.createDataFrame(rows, kept[0].schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() >= 0
    assert near_duplicates.near_duplicates(docs).count() == len(rows)
    assert decontaminate.contaminated(docs, docs.selectExpr("doc_id as item_id", "text")).count() == len(rows)


def test_the_entry_works_without_this_package(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and not [n for n in q if n.startswith('op') or n == 'pipeline']; assert set(e.oracle_sql()) <= set(q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert done.returncode == 0, done.stderr


def files_below(folder):
    return [p for p in Path(folder.removeprefix("file:")).rglob("*") if p.is_file()]


def test_saved_tables_can_be_deleted(spark):
    """Nothing that the pipeline saved on its way is left by its end, and nothing at all after ``clear``."""
    shared.clear(spark)
    saved = shared.saved(spark.range(10))
    root = spark.sparkContext.getCheckpointDir()
    with shared.released(spark):
        assert shared.saved(saved.selectExpr("id * 2 AS id")).count() == 10
        assert len(shared._files) == 2
    assert saved.count() == 10 and len(shared._files) == 1
    before = len(files_below(root))
    rows = corpus_pipeline.run(spark, FOLDER).count()
    assert rows > 100 and len(files_below(shared.shared_uri(spark))) > before
    assert len(shared._files) <= 8  # the saved table above, and those that the last stage reads
    shared.clear(spark)
    assert files_below(root) == []
    assert not Path(lineage._own_folder(spark).removeprefix("file:")).exists()
