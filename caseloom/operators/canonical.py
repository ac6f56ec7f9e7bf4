"""Deduplicate: one canonical record per key, with evidence about its copies.

A heavy key is folded on the map side (partial aggregates) before the shuffle;
its value lists are whole, see ``functions.lists``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.lists import collect_lists, gather_lists
from caseloom.functions.ordering import sort_key

# keys travel as one struct, whose equality is null-safe, so a null key keeps its lists
KEY = "_key"
#: holds the digits of a double in the range of scores, so that a sum of them is exact
EXACT = "decimal(38,15)"


def _summary(score: str | None) -> list[Column]:
    out = [F.count(F.lit(1)).alias("document_count")]
    if score:
        # summed as decimal: the average must not depend on the order of addition
        total = F.sum(F.col(score).cast(EXACT)).cast("double")
        out += [F.max(score).alias(f"max_{score}"), (total / F.count(score)).alias(f"avg_{score}")]
    return out


def duplicate_summary(
    df: DataFrame,
    keys: list[str],
    score: str,
    id_col: str | None = None,
) -> DataFrame:
    """Copies per key: count, best and mean score, duplicate flag, and all their ids."""
    out = df.groupBy(*keys).agg(*_summary(score)).withColumn("duplicate_flag", F.col("document_count") > 1)
    if id_col is None:
        return out
    return _attach_lists(out, df, keys, {f"{id_col}s": F.array(id_col)})


def _conflict(fields: Sequence[str]) -> list[Column]:
    # a field conflicts when two distinct non-null values exist; min <> max says so without a distinct count
    return [F.coalesce(F.min(c) != F.max(c), F.lit(False)).alias(f"_differs_{c}") for c in fields]


def _conflict_list(fields: Sequence[str]) -> Column:
    return F.array_compact(F.array(*[F.when(F.col(f"_differs_{c}"), F.lit(c)) for c in fields]))


def conflict_fields(df: DataFrame, keys: list[str], fields: Sequence[str]) -> DataFrame:
    """Fields that hold more than one value among the copies of a key."""
    return (
        df.groupBy(*keys)
        .agg(*_conflict(fields))
        .select(*keys, _conflict_list(fields).alias("conflict_fields"))
        .withColumn("conflict_flag", F.size("conflict_fields") > 0)
    )


def _best(df: DataFrame, kept: Sequence[str], order: list[tuple[str, str]]) -> Column:
    return F.min_by(F.struct(*kept), sort_key(df, order))


def pick_best(df: DataFrame, keys: list[str], order: list[tuple[str, str]]) -> DataFrame:
    """First row per key under ``order``, in one aggregate and one shuffle."""
    kept = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(_best(df, kept, order).alias("_best")).select(*keys, "_best.*")


def union_arrays(df: DataFrame, keys: list[str], lists: dict[str, Column]) -> DataFrame:
    """Sorted distinct union of array columns over the rows of each key."""
    return _attach_lists(df.select(*keys).distinct(), df, keys, lists)


def _attach_lists(out: DataFrame, df: DataFrame, keys: list[str], lists: dict[str, Column]) -> DataFrame:
    """Add the lists to a one-row-per-key table."""
    found = collect_lists(df.withColumn(KEY, F.struct(*keys)), [KEY], lists)
    joined = out.withColumn(KEY, F.struct(*keys)).join(found, KEY, "left").drop(KEY)
    return joined.withColumns(_filled(joined, lists))


def _filled(joined: DataFrame, lists: Iterable[str]) -> dict[str, Column]:
    """A list without members is []."""
    return {n: F.coalesce(n, F.array().cast(joined.schema[n].dataType)) for n in lists}


def canonicalize(
    df: DataFrame,
    keys: list[str],
    order: list[tuple[str, str]],
    score: str,
    conflicts: Sequence[str],
    lists: dict[str, Column],
    few: bool = False,
) -> DataFrame:
    """Best row, copy summary, conflicting fields and list unions, one row per key.

    ``few`` says that no key has many rows, so that its lists can be gathered at once.
    """
    kept = [c for c in df.columns if c not in keys and c not in lists]
    # keys that cannot be null group as they are, so that what they are already dealt out by still holds afterwards
    by = [KEY] if any(df.schema[k].nullable for k in keys) else keys
    keyed = df.withColumn(KEY, F.struct(*keys)) if by == [KEY] else df
    folded = (
        keyed.groupBy(*by)
        .agg(_best(df, kept, order).alias("_best"), *_summary(score), *_conflict(conflicts))
        .withColumn("_conflicts", _conflict_list(conflicts))
    )
    joined = folded.join((gather_lists if few else collect_lists)(keyed, by, lists), by, "left")
    return joined.select(
        *([f"{KEY}.*"] if by == [KEY] else keys),
        *[F.col(f"_best.{c}").alias(c) for c in kept],
        "document_count",
        (F.col("document_count") > 1).alias("duplicate_document_flag"),
        f"max_{score}",
        f"avg_{score}",
        F.col("_conflicts").alias("cross_document_conflict_fields"),
        (F.size("_conflicts") > 0).alias("cross_document_conflict"),
        *[c.alias(n) for n, c in _filled(joined, lists).items()],
    )


def canonical_alone(df: DataFrame, keys: list[str], score: str, lists: dict[str, Column]) -> DataFrame:
    """What ``canonicalize`` makes of rows whose keys are all different, without an aggregate."""
    kept = [c for c in df.columns if c not in keys and c not in lists]
    own = {n: F.sort_array(F.array_distinct(F.array_compact(c))) for n, c in lists.items()}
    return df.select(
        *keys,
        *kept,
        F.lit(1).cast("long").alias("document_count"),
        F.lit(False).alias("duplicate_document_flag"),
        F.col(score).alias(f"max_{score}"),
        F.col(score).cast(EXACT).cast("double").alias(f"avg_{score}"),
        F.array().cast("array<string>").alias("cross_document_conflict_fields"),
        F.lit(False).alias("cross_document_conflict"),
        *[F.coalesce(c, F.array().cast(df.select(c).schema[0].dataType)).alias(n) for n, c in own.items()],
    )
