"""Distinct ids under any key of an id's lines: paired where every key has few occurrences, else counted by day."""

import datetime as dt
import random

import pytest

from caseloom.operators import history

DAY = dt.date(2020, 1, 1)


@pytest.mark.parametrize("few", [0, 3, 1000])
def test_either_way_counts_each_id_once(spark, monkeypatch, few):
    rng = random.Random(9)
    names = ["hot", *(f"k{i}" for i in range(30))]
    past = [(rng.choice([None, *range(60)]), rng.choice(["hot", *names, None]), rng.choice([None, *range(800)])) for _ in range(220)]
    past += past[:20]
    asks = []
    for i in range(120):
        day = rng.choice([None, *range(100, 900)])
        asks += [(i, k, day) for k in rng.sample([*names, None], rng.randrange(1, 5))]
    date = lambda d: None if d is None else DAY + dt.timedelta(d)
    h = spark.createDataFrame([(i, k, date(d)) for i, k, d in past], "id int, k string, day date")
    c = spark.createDataFrame([(i, k, date(d)) for i, k, d in asks], "i int, k string, day date")
    want = {}
    for i, k, d in asks:
        seen = {j for j, key, on in past if None not in (j, key, on, d) and key == k and d - 365 <= on < d}
        want[i] = want.get(i, set()) | seen
    written = {}

    def between(df, name):
        written[name] = df.cache()
        return df

    monkeypatch.setattr(history, "FEW", few)
    got = history.distinct_counts(c, h, ["k"], ("i", "day"), ("id", "day"), "n", between=between)
    assert {r["i"]: r["n"] for r in got.collect()} == {i: len(x) for i, x in want.items()}
    assert got.schema["n"].dataType.simpleString() == "bigint"
    swept = written["past_days"].count()
    assert swept == 0 if few == 1000 else swept > 0 and written["busy_ids"].count() > 0
