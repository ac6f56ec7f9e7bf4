"""Helpers that keep one heavy key from landing in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_BUCKETS = 256
SALTS = 16


def tune(spark: SparkSession) -> SparkSession:
    """Settings for the owner of a session: AQE splits the heavy partitions of a join, also where that costs a shuffle."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def none_null(keys: list[str]) -> Column:
    return ~any_null(keys)


def spread_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on ``keys`` where ``right`` has at most one row per key.

    Rows of ``left`` with a null key match nothing, yet a plain join would hash
    them all to one task; here they are dealt out over ``NULL_BUCKETS``. The
    bucket is a hash of the row, so a retried task deals them out alike.
    Heavy non-null keys are split by AQE, see ``tune``. Keys that cannot be null
    are joined plainly, so that joins in a row share one shuffle of ``left``.
    """
    if not any(left.schema[k].nullable for k in keys):
        return left.join(right, keys, "left")
    hashable = [f.name for f in left.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    # hash % 1 is always 0, but not a literal, so it stays a join key
    nowhere = F.pmod(F.xxhash64(*keys), F.lit(1))
    dealt = F.pmod(F.xxhash64(*hashable), F.lit(NULL_BUCKETS)) + 1
    bucketed = left.withColumn("_bucket", F.when(any_null(keys), dealt).otherwise(nowhere))
    return bucketed.join(right.withColumn("_bucket", nowhere), [*keys, "_bucket"], "left").drop("_bucket")


def salted_join(df: DataFrame, per_key: DataFrame, keys: list[str], how: str, by: list[str]) -> DataFrame:
    """Join on non-null ``keys`` to a narrow table of one row per key, each key dealt out over ``SALTS``.

    The salt is a hash of the columns ``by``, so a retried task deals rows out
    alike. It also ends the rows' partitioning by key alone: a grouping by the
    key and more would otherwise find its rows already together, skip its
    shuffle, and leave a heavy key in the one task that joined it.
    """
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)))
    return salted.join(per_key.withColumn("_salt", every), [*keys, "_salt"], how).drop("_salt")
