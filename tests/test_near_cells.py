"""Near history by cells of few points and of many."""

import datetime
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from caseloom.operators import history

MANY = history.FEW


@pytest.mark.parametrize("few", [0, 2, MANY])
def test_cells_of_few_points_are_not_swept(spark, monkeypatch, few):
    """By whichever way a cell is counted, the counts are those of all pairs; where cells hold few points nothing is swept."""
    rng = random.Random(5)
    day = datetime.date(2024, 1, 1)
    past = [(f"H{rng.randrange(60)}" if rng.random() > 0.1 else None, rng.choice("abc"), rng.randrange(30), 100 + rng.randrange(8)) for _ in range(150)]
    asked = [(f"H{i}" if i < 40 else f"C{i}", rng.choice("abc"), rng.randrange(30), 100 + rng.randrange(8)) for i in range(80)]
    frames = [
        spark.createDataFrame([(i, k, day + datetime.timedelta(d), float(a)) for i, k, d, a in rows], "id string, k string, day date, amount double")
        .withColumn("amount", F.col("amount").cast("decimal(18,2)"))
        for rows in (asked, past)
    ]
    swept, sweep = [], history._swept

    def seen(probes, points, keys, days):
        swept.append((probes.count(), points.count()))
        return sweep(probes, points, keys, days)

    monkeypatch.setattr(history, "FEW", few)
    monkeypatch.setattr(history, "_swept", seen)
    got = history.near_duplicate_counts(*frames, ["k"], ("id", "day", "amount"), ("id", "day", "amount"), days=2, tolerance="0.01")
    want = defaultdict(set)
    for i, k, d, a in asked:
        for j, key, when, amount in past:
            if j is not None and j != i and key == k and abs(when - d) <= 2 and abs(amount - a) <= a * 0.01:
                want[i].add(j)
    assert {r[0]: r[1] for r in got.collect()} == {i: len(ids) for i, ids in want.items()}
    assert (swept == [(0, 0)]) == (few == MANY)


def test_an_id_of_one_point_counts_for_each_row_asked(spark, monkeypatch):
    """As it did when every cell was swept; an id of several points counts once."""
    rows = "id string, k string, day date, amount decimal(18,2)"
    asked = spark.sql("SELECT 'C' AS id, 'a' AS k, DATE '2024-01-05' AS day, CAST(100 AS DECIMAL(18,2)) AS amount FROM range(2)")
    past = spark.createDataFrame([("one", "a", datetime.date(2024, 1, 4), 100), ("two", "a", datetime.date(2024, 1, 4), 100), ("two", "a", datetime.date(2024, 1, 5), 100)], rows.replace("decimal(18,2)", "int"))
    past = past.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    for few in (0, MANY):
        monkeypatch.setattr(history, "FEW", few)
        got = history.near_duplicate_counts(asked, past, ["k"], ("id", "day", "amount"), ("id", "day", "amount"), days=2)
        assert [tuple(r) for r in got.collect()] == [("C", 3)]
