"""The snapshot store against a dictionary, and what a push rewrites."""

import random

import pytest

from caseloom.sources import manifests
from caseloom.sources.snapshots import Snapshots

SCHEMA = "k string, n int, v double, tag string"


def rows_of(df):
    return sorted(map(repr, map(tuple, df.select("run_id", "k", "n", "v", "tag").collect())))


@pytest.fixture
def store(spark, tmp_path):
    return Snapshots(spark, str(tmp_path / "store"), spark.createDataFrame([], SCHEMA).schema, ["k", "n"], buckets=8)


def test_pushes_equal_a_dictionary(spark, store):
    """Null keys, keys with many and repeated rows, runs that push twice, an empty push."""
    rng = random.Random(1)
    current, history = {}, {}
    for run in ("a", "b", "c", "b", "d"):
        rows = [
            (rng.choice(["x", "y", None]), rng.choice([1, 2, 3, None]), rng.choice([0.5, None]), rng.choice(["t", ""]))
            for _ in range(0 if run == "d" else rng.randint(3, 9))
        ]
        rows += rows[:2]
        store.push(spark.createDataFrame(rows, SCHEMA).repartition(3), run)
        pushed = {}
        for r in rows:
            pushed.setdefault(r[:2], []).append((run, *r))
        current |= pushed
        history.setdefault(run, {}).update(pushed)
        assert rows_of(store.current()) == sorted(repr(r) for x in current.values() for r in x)
        assert rows_of(store.history()) == sorted(repr(r) for h in history.values() for x in h.values() for r in x)
    assert rows_of(store.history("b")) == sorted(repr(r) for x in history["b"].values() for r in x)
    assert store.history("never").count() == 0


def test_only_buckets_of_pushed_keys_are_rewritten(spark, store):
    store.push(spark.createDataFrame([(f"k{i}", i, 1.0, "old") for i in range(200)], SCHEMA), "one")
    before = manifests.latest(spark, store.folder)[1]["current"]
    assert len(before) == 8
    store.push(spark.createDataFrame([("k7", 7, 2.0, "new")], SCHEMA), "two")
    after = manifests.latest(spark, store.folder)[1]["current"]
    assert sum(before[b] != after[b] for b in before) == 1
    assert store.current().count() == 200 and store.current().where("tag = 'new'").count() == 1
    assert store.history("one").count() == 200


def test_an_unpublished_push_is_not_seen_and_two_at_once_conflict(spark, store, monkeypatch):
    store.push(spark.createDataFrame([("a", 1, 1.0, "t")], SCHEMA), "one")

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(manifests, "publish", crash)
        with pytest.raises(OSError):
            store.push(spark.createDataFrame([("a", 1, 2.0, "t")], SCHEMA), "two")
    assert rows_of(store.current()) == ["('one', 'a', 1, 1.0, 't')"]
    version, state = manifests.latest(spark, store.folder)
    with pytest.raises(manifests.Conflict):
        manifests.publish(spark, store.folder, version, state)
    assert store.vacuum()  # what the crash left
    assert rows_of(store.current()) == rows_of(store.history()) == ["('one', 'a', 1, 1.0, 't')"]


def test_other_layouts_and_clashing_names_are_refused(spark, store):
    store.push(spark.createDataFrame([("a", 1, 1.0, "t")], SCHEMA), "one")
    other = Snapshots(spark, store.folder, spark.createDataFrame([], SCHEMA).schema, ["k"], buckets=8)
    with pytest.raises(ValueError):
        other.current()
    with pytest.raises(ValueError):
        Snapshots(spark, store.folder, spark.createDataFrame([], "run_id string").schema, ["run_id"])


def test_a_heavy_key_is_written_by_several_tasks(spark, tmp_path):
    """Rows of one key alone, more than one partition's worth by AQE's advice."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(60_000).selectExpr("'hot' AS k", "1 AS n", "id * 0.37D AS v", "CAST(id AS STRING) AS tag")
        store = Snapshots(spark, str(tmp_path / "hot"), rows.schema, ["k", "n"])
        store.push(rows, "one")
        assert store.current().count() == 60_000
        assert len(store.current().inputFiles()) > 2
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
