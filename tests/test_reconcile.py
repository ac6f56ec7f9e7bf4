"""Differing keys against counters, tables that must grow, and what is shuffled."""

import random
from collections import Counter

import numpy as np
import pytest

from caseloom.operators import reconcile

SCHEMA = "k string, n int, extra int"


def compared(spark, a, b, **options):
    dfs = [spark.createDataFrame([(*r, 1) for r in x], SCHEMA).repartition(3) for x in (a, b)]
    got = reconcile.differing_keys(*dfs, ["k", "n"], **options).collect()
    return {(r["k"], r["n"]): (r["n_before"], r["n_after"]) for r in got}


def wanted(a, b):
    x, y = Counter(a), Counter(b)
    return {k: (x[k], y[k]) for k in x.keys() | y.keys() if x[k] != y[k]}


@pytest.mark.parametrize("cells, most", [(reconcile.CELLS, reconcile.MOST), (6, 6), (6, 10**6)])
def test_differences_equal_those_of_counters(spark, cells, most):
    """Nulls in each place, repeated rows, a heavy key; by a table of cells, one that grows, and the shuffle beyond."""
    rng = random.Random(cells)
    a = [(rng.choice([None, *"abcdefgh"]), rng.choice([None, *range(60)])) for _ in range(900)] + [("hot", 1)] * 700
    b = [r for r in a if rng.random() > 0.05] + [(None, 7), ("new", None), ("", 7), ("7", None)]
    rng.shuffle(b)
    assert compared(spark, a, b, cells=cells, most=most) == wanted(a, b)
    assert compared(spark, a, a[::-1], cells=cells, most=most) == {}


def test_empty_sides(spark):
    a = [("x", i) for i in range(50)]
    assert compared(spark, [], a) == wanted([], a)
    assert compared(spark, a, []) == wanted(a, [])
    assert compared(spark, [], []) == {}


def test_a_pass_shuffles_a_row_per_cell_at_most(spark, monkeypatch):
    sizes = []
    peel = reconcile._peeled

    def seen(table):
        sizes.append(int((table["_n"] != 0).sum()))
        return peel(table)

    monkeypatch.setattr(reconcile, "_peeled", seen)
    before = spark.range(300_000).selectExpr("id AS k", "id % 7 AS n")
    got = reconcile.differing_keys(before, before.where("k % 30000 <> 1"), ["k", "n"])
    assert got.count() == 10 and sizes == [30]


@pytest.mark.parametrize("differ", [9_000, 15_000, 36_000])
def test_peeling_ends_and_tells_no_key_that_is_not_there(differ):
    """Cells that hold several keys may look like those of one: taken off, such a key came and went for ever."""
    rng = np.random.default_rng(differ)
    parts, signs = rng.integers(0, 1 << 30, (4, differ)), rng.choice([1, -1], differ)
    told = [*parts, reconcile._check_of(parts)]
    table = {n: np.zeros(reconcile.CELLS, np.int64) for n in ("_n", "_a", "_b", "_c", "_d", "_e")}
    for at in reconcile._cells_of(parts[:3], reconcile.CELLS // 3):
        np.add.at(table["_n"], at, signs)
        for n, part in zip(("_a", "_b", "_c", "_d", "_e"), told, strict=True):
            np.add.at(table[n], at, part * signs)
    found = reconcile._peeled(table)
    if differ > 10_000:
        assert found is None
    else:
        assert {tuple(k) for k in found.tolist()} == set(zip(*parts.tolist()))
