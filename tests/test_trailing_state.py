"""Trailing metrics from merged totals equal those over the whole history."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from caseloom.operators import history
from caseloom.operators.trailing_state import TrailingState
from caseloom.sources import manifests

DAY0 = date(2023, 1, 1)
SCHEMA = "k string, part int, day date, amt decimal(18,2)"


def some(rng, n, start, length):
    return [
        (
            rng.choice(["hot", "hot", "a", "b", None]),
            rng.choice([1, 1, 2, None]),
            DAY0 + timedelta(days=start + rng.randrange(length)) if rng.random() > 0.05 else None,
            Decimal(rng.randrange(-500, 90_000)) / 100 if rng.random() > 0.1 else None,
        )
        for _ in range(n)
    ]


@pytest.fixture
def state(spark, tmp_path):
    keys = spark.createDataFrame([], SCHEMA).select("k", "part").schema
    return TrailingState(spark, str(tmp_path / "state"), keys, period=20)


def wanted(current, past):
    out = history.trailing_metrics(current, past, ["k", "part"], "day", "day", "amt")
    return sorted(map(repr, out.collect()))


def test_merged_batches_equal_the_whole_history(spark, state):
    """Batches in order, one late, one empty, one retried; repeated rows, null keys, days and amounts."""
    rng = random.Random(3)
    batches = [some(rng, 150, 0, 200), some(rng, 100, 200, 100), some(rng, 60, 0, 300), [], some(rng, 200, 290, 250)]
    batches[1] += batches[1][:30]
    current = spark.createDataFrame(some(rng, 80, 0, 900) + [("hot", 1, DAY0, None)] * 2, SCHEMA)
    merged = []
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, SCHEMA)
        assert state.merge(df, f"batch-{i}", "day", "amt")
        assert not state.merge(df, f"batch-{i}", "day", "amt")
        merged += rows
        got = sorted(map(repr, state.metrics(current, "day").collect()))
        assert got == wanted(current, spark.createDataFrame(merged, SCHEMA))
    assert state.metrics(current.where("false"), "day").count() == 0


def test_an_empty_state_knows_no_history(spark, state):
    current = spark.createDataFrame(some(random.Random(1), 10, 0, 50), SCHEMA)
    assert sorted(map(repr, state.metrics(current, "day").collect())) == wanted(current, current.where("false"))


def test_only_touched_periods_are_rewritten_and_only_asked_ones_are_read(spark, state):
    days = spark.range(1000).select(F.lit("hot").alias("k"), F.lit(1).alias("part"), F.date_add(F.lit(DAY0), F.col("id").cast("int")).alias("day"))
    many = days.withColumn("amt", F.lit("1.50").cast("decimal(18,2)")).crossJoin(spark.range(50)).drop("id")
    state.merge(many, "one", "day", "amt")
    before = manifests.latest(spark, state.folder)[1]["periods"]
    assert state._read(sorted(before.values())).count() == 1000  # one row per key and day
    late = spark.createDataFrame([("hot", 1, DAY0 + timedelta(days=500), Decimal(2))], SCHEMA)
    state.merge(late, "two", "day", "amt")
    after = manifests.latest(spark, state.folder)[1]["periods"]
    assert len(before) > 45 and sum(before[p] != after[p] for p in before) == 1
    asked = spark.createDataFrame([("hot", 1, DAY0 + timedelta(days=700), None)], SCHEMA)
    out = state.metrics(asked, "day", days=30)
    assert (out.first()["prior_count"], out.first()["last_prior_date"]) == (30 * 50, DAY0 + timedelta(days=699))
    assert len({f.split("_period=")[1].split("/")[0] for f in out.inputFiles() if "_period=" in f}) <= 3


def test_a_crash_before_publishing_changes_nothing(spark, state, monkeypatch):
    rows = spark.createDataFrame([("a", 1, DAY0, Decimal(3))], SCHEMA)

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(manifests, "publish", crash)
        with pytest.raises(OSError):
            state.merge(rows, "one", "day", "amt")
    asked = spark.createDataFrame([("a", 1, DAY0 + timedelta(days=1), None)], SCHEMA)
    assert state.metrics(asked, "day").first()["prior_count"] == 0
    assert state.merge(rows, "one", "day", "amt")
    assert state.metrics(asked, "day").first()["prior_count"] == 1
    assert len(state.vacuum()) == 1
    assert state.metrics(asked, "day").first()["prior_count"] == 1
