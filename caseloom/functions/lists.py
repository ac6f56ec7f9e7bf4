"""Distinct value lists per key, as rows and as arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def members(df: DataFrame, keys: list[str], lists: dict[str, Column]) -> DataFrame:
    """Every distinct (keys, list_name, value), whole, however large a key is.

    A value of ``lists`` is an array column.
    """

    def tagged(name: str, c: Column) -> Column:
        return F.transform(c, lambda v: F.struct(F.lit(name).alias("list_name"), v.alias("value")))

    # a null array contributes nothing, but must not null the others
    arrays = F.array_compact(F.array(*[tagged(name, c) for name, c in lists.items()]))
    # outer, as explode would evaluate the lists a second time in a filter for non-empty ones
    return (
        df.select(*keys, F.explode_outer(F.flatten(arrays)).alias("_m"))
        .select(*keys, "_m.list_name", "_m.value")
        .where(F.col("value").isNotNull())
        .distinct()
    )


def collect_lists(df: DataFrame, keys: list[str], lists: dict[str, Column]) -> DataFrame:
    """One row per key: the sorted distinct values of each array column over the key's rows, whole.

    The values of a key are made distinct first, spread over all tasks by value,
    and collected where they are; so only the answer itself meets in one row,
    whatever the number of rows of the key. A key without any value has no row.
    """
    links = members(df, keys, lists)

    def values(name: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("list_name") == name, F.col("value")))).alias(name)

    return links.groupBy(*keys).agg(*[values(n) for n in lists])


def gather_lists(df: DataFrame, keys: list[str], lists: dict[str, Column]) -> DataFrame:
    """The same for keys of few rows, in one aggregate; a key without any value has empty lists."""
    whole = {n: F.array_distinct(F.array_compact(F.flatten(F.collect_list(c)))) for n, c in lists.items()}
    return df.groupBy(*keys).agg(*[F.sort_array(v).alias(n) for n, v in whole.items()])
