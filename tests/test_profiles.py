"""Merged profiles against exact numbers over all rows."""

import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from caseloom.operators import profiles

SCHEMA = "k string, n int, v double, d date, t timestamp, b boolean, l array<int>, n_rows int"


def some(rng, n):
    day = date(2024, 1, 1)
    return [
        (
            rng.choice([None, "hot", "hot", f"k{rng.randrange(20_000)}"]),
            rng.choice([None, rng.randrange(-5000, 5000)]),
            rng.choice([None, math.nan, rng.gauss(0, 10), 0.25]),
            day + timedelta(days=rng.randrange(900)),
            datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(10**7)),
            rng.choice([True, False, None]),
            rng.choice([None, [1], []]),
            7,
        )
        for _ in range(n)
    ]


def test_merged_profiles_equal_those_of_all_rows(spark, tmp_path):
    """Runs of different sizes, one empty, one added twice, repeated rows, nulls, NaN, one column of one value."""
    rng = random.Random(5)
    runs = {"a": some(rng, 6000), "b": some(rng, 900), "empty": [], "c": some(rng, 40) * 2}
    store = profiles.Profiles(spark, str(tmp_path / "store"))
    store.add(spark.createDataFrame(some(rng, 30), SCHEMA), "c", "landed")  # replaced below
    for run, rows in runs.items():
        store.add(spark.createDataFrame(rows, SCHEMA).repartition(3), run, "landed")
    store.add(spark.createDataFrame(runs["a"], SCHEMA), "a", "other stage")
    every = [r for rows in runs.values() for r in rows]
    got = {r["column_name"]: r for r in profiles.estimates(profiles.merged(store.read(stage="landed"))).collect()}
    assert list(sorted(got)) == sorted(SCHEMA.replace(",", "").split()[::2])
    for i, (name, number) in enumerate((("k", None), ("n", float), ("v", float), ("d", lambda d: (d - date(1970, 1, 1)).days))):
        values = [r[i] for r in every if r[i] is not None]
        row = got[name]
        assert (row["n_rows"], row["n_null"]) == (len(every), len(every) - len(values))
        distinct = len({str(v) for v in values})
        assert abs(row["n_distinct"] - distinct) <= profiles.distinct_error() * distinct
        if number is None:
            assert (row["least"], row["greatest"], row["q50"]) == (min(values), max(values), None)
            continue
        numbers = sorted(number(v) for v in values if v == v)
        assert (row["least_number"], row["greatest_number"]) == (numbers[0], numbers[-1])
        for q in (0.25, 0.5, 0.75):
            low = sum(x < row[f"q{round(q * 100)}"] for x in numbers) / len(numbers)
            high = sum(x <= row[f"q{round(q * 100)}"] for x in numbers) / len(numbers)
            assert low - 2 * profiles.rank_error() <= q <= high + 2 * profiles.rank_error()
    assert (got["l"]["n_distinct"], got["l"]["least"], got["n_rows"]["n_distinct"]) == (0, None, 1)
    alone = {r["column_name"]: r["n_rows"] for r in profiles.merged(store.read("c")).collect()}
    assert set(alone.values()) == {80}
    assert {r["n_rows"] for r in profiles.merged(store.read("empty")).collect()} == {0}
    assert store.read("never").count() == 0


def test_a_sum_of_profiles_does_not_read_the_rows(spark, tmp_path):
    store = profiles.Profiles(spark, str(tmp_path / "store"))
    for run in range(3):
        store.add(spark.range(run * 50_000, (run + 1) * 50_000).withColumn("s", F.col("id") % 100), str(run), "landed")
    whole = profiles.estimates(profiles.merged(store.read()))
    assert all("profile-" in f for f in whole.inputFiles())
    got = {r["column_name"]: r for r in whole.collect()}
    assert got["id"]["n_rows"] == 150_000 and got["id"]["n_distinct"] == pytest.approx(150_000, rel=profiles.distinct_error())
    assert got["s"]["n_distinct"] == pytest.approx(100, rel=0.05)
    assert got["id"]["q50"] == pytest.approx(75_000, rel=4 * profiles.rank_error())
