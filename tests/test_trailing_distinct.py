"""Distinct ids of the days before, counted by one row per occurrence."""

import datetime as dt
import random

from pyspark.sql import functions as F

from caseloom.operators import history

DAY = dt.date(2020, 1, 1)


def _brute(current, past, days):
    out = []
    for key, day in current:
        near = {i for k, i, d in past if k == key and None not in (k, i, d, day) and day - dt.timedelta(days) <= d < day}
        out.append((key, day, len(near)))
    return sorted(out, key=str)


def test_ids_that_recur_within_at_and_beyond_the_window_count_once(spark):
    rng = random.Random(5)
    days = 7
    past = [(1, "a", 0), (1, "a", 7), (1, "a", 13), (1, "a", 13), (1, "b", 0), (1, "b", 6), (1, None, 3), (None, "a", 3), (1, "a", None)]
    past += [(rng.randrange(1, 4), rng.choice("abcde"), rng.randrange(60)) for _ in range(300)]
    past = [(k, i, None if d is None else DAY + dt.timedelta(d)) for k, i, d in past]
    current = [(k, DAY + dt.timedelta(d)) for k in (1, 2, 3, 9, None) for d in range(-2, 75)] + [(1, None)]
    c = spark.createDataFrame(current, "k int, day date")
    h = spark.createDataFrame(past, "k int, id string, day date")
    got = history.trailing_distinct(c, h, ["k"], "day", "day", "id", "n", days=days)
    assert sorted(((r["k"], r["day"], r["n"]) for r in got.collect()), key=str) == _brute(current, past, days)
    assert got.schema["n"].dataType.simpleString() == "bigint"


def test_an_occurrence_is_one_row_unless_its_id_recurs_in_the_window(spark):
    seen = spark.createDataFrame([(1, "a", 0), (1, "a", 7), (1, "b", 0), (1, "b", 6), (2, "c", 5)], "k int, _id string, _day int")
    rows = history._counted(seen, ["k"], 7)
    assert rows.count() == 5 + 2  # two rows an occurrence before; only b recurs before it leaves
    assert rows.agg(F.sum("_n")).first()[0] == 5
