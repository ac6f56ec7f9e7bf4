"""Keys that two tables hold in different numbers, without a shuffle of all their keys.

Both sides are folded, on the map side, into one invertible Bloom lookup table:
each key is added to three cells by one side and taken away by the other, so
what both hold alike is gone. What is left is peeled off cells that hold one key
only, which a check number beside the parts of the key tells. A table too small
for the differences does not peel, and is made larger.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: cells of the first try and of the last; each later try has sixteen times as many
CELLS, MOST = 3 << 12, 3 << 20
GROWTH = 16
_BITS = 30
_PRIME = (1 << 31) - 1
#: multipliers of a key's first three parts, for each of its cells
_SPREAD = ((1299709, 15485863, 32452843), (179424673, 86028121, 49979687), (122949823, 141650939, 160481183))


def _parts(keys: Sequence[str]) -> list[Column]:
    """Four numbers of 30 bits that stand for a key; which of its columns are null counts as well."""
    nulls = F.concat(*[F.col(k).isNull().cast("int").cast("string") for k in keys])
    out = []
    for seed in (1, 2):
        h = F.xxhash64(F.lit(seed), nulls, *keys)
        out += [h.bitwiseAND(F.lit((1 << _BITS) - 1)), F.shiftrightunsigned(h, _BITS).bitwiseAND(F.lit((1 << _BITS) - 1))]
    return out


def _check_of(parts):
    """A number that parts of several keys, added up, do not have, as a column or as an array alike."""
    a, b, c, d = parts
    return ((a * d) % _PRIME + (b * c) % _PRIME) % _PRIME


def _cells_of(parts, third: int):
    """The three cells of a key, from its first three parts, as columns or as arrays alike."""
    a, b, c = parts[:3]
    return [((a * x + b * y + c * z) % _PRIME) % third + j * third for j, (x, y, z) in enumerate(_SPREAD)]


def _folded(before: DataFrame, after: DataFrame, keys: Sequence[str], cells: int) -> dict[str, np.ndarray]:
    """Per cell the rows before less those after, and the parts of their keys added up: as many numbers as cells have."""
    names = ["_a", "_b", "_c", "_d"]
    sides = [df.select(*[p.alias(n) for n, p in zip(names, _parts(keys), strict=True)], F.lit(sign).cast("long").alias("_n")) for df, sign in ((before, 1), (after, -1))]
    both = sides[0].unionByName(sides[1]).withColumn("_e", _check_of([F.col(n) for n in names]))
    names.append("_e")
    at = F.explode(F.array(*_cells_of([F.col(n) for n in names[:3]], cells // 3)))
    added = [F.sum("_n").alias("_n"), *[F.sum(F.col(n) * F.col("_n")).alias(n) for n in names]]
    found = both.select(at.alias("_cell"), "_n", *names).groupBy("_cell").agg(*added).where(" or ".join(f"{n} <> 0" for n in ("_n", *names)))
    rows = found.toPandas()
    out = {n: np.zeros(cells, np.int64) for n in ("_n", *names)}
    for n in out:
        out[n][rows["_cell"].to_numpy(np.int64)] = rows[n].to_numpy(np.int64)
    return out


def _peeled(table: dict[str, np.ndarray]) -> np.ndarray | None:
    """The parts of all keys left in the table, a row each; None where it does not come apart."""
    names, cells = ["_a", "_b", "_c", "_d", "_e"], len(table["_n"])
    count, sums = table["_n"], np.stack([table[n] for n in names], axis=1)
    found = []
    while sum(map(len, found)) <= cells:  # cells hold no more keys; one told wrongly could come and go for ever
        some = np.flatnonzero(count)
        parts, rest = np.divmod(sums[some], count[some, None])
        pure = (rest == 0).all(axis=1) & (parts >= 0).all(axis=1) & (parts[:, :4] < 1 << _BITS).all(axis=1)
        some, parts = some[pure], parts[pure]
        pure = parts[:, 4] == _check_of(parts[:, :4].T)
        where = np.stack(_cells_of([parts[:, k] for k in range(3)], cells // 3), axis=1)
        pure &= (where == some[:, None]).any(axis=1)
        if not pure.any():
            break
        keys, first = np.unique(parts[pure], axis=0, return_index=True)
        times, where = count[some[pure][first]], where[pure][first]
        found.append(keys)
        for j in range(3):
            np.subtract.at(count, where[:, j], times)
            np.subtract.at(sums, where[:, j], keys * times[:, None])
    if count.any() or sums.any():
        return None
    return np.unique(np.concatenate(found)[:, :4], axis=0) if found else np.zeros((0, 4), np.int64)


def differing_keys(before: DataFrame, after: DataFrame, keys: Sequence[str], cells: int = CELLS, most: int = MOST) -> DataFrame:
    """(keys, n_before, n_after): every key that the two tables hold in different numbers of rows; nulls are values.

    Each try is one pass over the keys of both tables that shuffles, and brings
    to the driver, a row per cell at most. The rows of the keys that a table of
    cells has told are then counted exactly. Where even ``most`` cells do not
    come apart, some 800,000 differences, all keys are shuffled and compared.
    """
    spark, parts = before.sparkSession, None
    while parts is None and cells <= most:
        parts = _peeled(_folded(before, after, keys, cells))
        cells *= GROWTH
    names = [f"_p{i}" for i in range(4)]
    sides = []
    for df, side in ((before, "n_before"), (after, "n_after")):
        told = df.select(*keys, *[p.alias(n) for n, p in zip(names, _parts(keys), strict=True)])
        if parts is not None:
            wanted = spark.createDataFrame(parts.tolist(), ", ".join(f"{n} long" for n in names))
            told = told.join(F.broadcast(wanted), names, "left_semi")  # no more rows than cells
        sides.append(told.select(*keys, *[F.lit(int(side == n)).alias(n) for n in ("n_before", "n_after")]))
    counted = sides[0].unionByName(sides[1]).groupBy(*keys)
    return counted.agg(F.sum("n_before").alias("n_before"), F.sum("n_after").alias("n_after")).where("n_before <> n_after")
