"""Profiles of tables that merge: what each run landed is sketched once, any set of runs is summed up without rereading."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.sources import manifests

#: 2 ** LG_DISTINCT registers, 4 KB to 16 KB a column
LG_DISTINCT = 12
#: size of a quantile sketch, some KB a column
K_QUANTILES = 400
SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("n_null", T.LongType()),
        T.StructField("least", T.StringType()),
        T.StructField("greatest", T.StringType()),
        T.StructField("least_number", T.DoubleType()),
        T.StructField("greatest_number", T.DoubleType()),
        T.StructField("distinct_sketch", T.BinaryType()),
        T.StructField("quantile_sketch", T.BinaryType()),
    ]
)


def distinct_error(deviations: float = 3.0) -> float:
    """The relative error that an estimate of distinct values keeps within so many standard deviations."""
    return deviations * 1.04 / math.sqrt(1 << LG_DISTINCT)


def rank_error() -> float:
    """The error of a quantile's rank, as a share of all values, that is kept with 99 % confidence."""
    return 2.446 / K_QUANTILES**0.9433


def _number(c: Column, kind: T.DataType) -> Column | None:
    """A column's value as a double where quantiles make sense: numbers, and days or seconds since 1970."""
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c) / F.lit(1e6)
    return None


def _flat(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def profile(df: DataFrame, run_id: str, stage: str) -> DataFrame:
    """One row per column of ``df`` under ``SCHEMA``, in one pass and one partly aggregated group.

    ``least`` and ``greatest`` are of the values as text, the numbers of numeric
    and time columns as doubles, without NaN. Nested columns count rows and
    nulls alone; an empty table has sketches of nothing.
    """
    fields, aggregates = df.schema.fields, [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(fields):
        c = df[f"`{f.name}`"]
        text = c.cast("string") if _flat(f.dataType) else F.lit(None).cast("string")
        number = _number(c, f.dataType)
        number = F.lit(None).cast("double") if number is None else F.when(~F.isnan(number), number)
        aggregates += [
            F.count(c).alias(f"known{i}"),
            F.min(text).alias(f"least{i}"),
            F.max(text).alias(f"greatest{i}"),
            F.min(number).alias(f"low{i}"),
            F.max(number).alias(f"high{i}"),
            F.hll_sketch_agg(text, F.lit(LG_DISTINCT)).alias(f"distinct{i}"),
            F.kll_sketch_agg_double(number, F.lit(K_QUANTILES)).alias(f"quantile{i}"),
        ]
    one = df.agg(*aggregates)
    rows = [
        F.struct(
            F.lit(run_id),
            F.lit(stage),
            F.lit(f.name),
            F.col("n"),
            F.col("n") - F.col(f"known{i}"),
            *[F.col(f"{name}{i}") for name in ("least", "greatest", "low", "high", "distinct", "quantile")],
        ).cast(SCHEMA)
        for i, f in enumerate(fields)
    ]
    return one.select(F.inline(F.array(*rows)))


def merged(profiles: DataFrame, by: tuple[str, ...] = ("stage", "column_name")) -> DataFrame:
    """``profiles`` summed up per group: exact counts and ends, sketches of all values."""
    return profiles.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_null").alias("n_null"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        F.min("least_number").alias("least_number"),
        F.max("greatest_number").alias("greatest_number"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )


def estimates(profiles: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The sketches of ``profiles`` read: n_distinct within ``distinct_error``, quantiles within ``rank_error``; null where there is no number."""
    numbers = F.kll_sketch_get_n_double("quantile_sketch") > 0
    return profiles.withColumns(
        {"n_distinct": F.hll_sketch_estimate("distinct_sketch")}
        | {
            f"q{round(q * 100):02d}": F.when(numbers, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(q))))
            for q in quantiles
        }
    ).drop("distinct_sketch", "quantile_sketch")


class Profiles:
    """The profiles of runs under ``folder``, a few KB per run, stage and column.

    A run that is added again replaces its rows of that stage, so retries are
    safe; an addition appears as a whole.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def add(self, df: DataFrame, run_id: str, stage: str) -> None:
        version, state = manifests.latest(self.spark, self.folder)
        name = manifests.new_folder(self.folder, "profile")
        profile(df, run_id, stage).coalesce(1).write.parquet(f"{self.folder}/{name}")
        parts = dict(state.get("parts", {}))
        parts[json.dumps([run_id, stage])] = name
        manifests.publish(self.spark, self.folder, version + 1, {"parts": parts})

    def read(self, *run_ids: str, stage: str | None = None) -> DataFrame:
        """The profiles of the named runs, or of all, of one stage or of all."""
        parts = {tuple(json.loads(k)): v for k, v in manifests.latest(self.spark, self.folder)[1].get("parts", {}).items()}
        paths = [v for (r, s), v in sorted(parts.items()) if (not run_ids or r in run_ids) and stage in (None, s)]
        if not paths:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*[f"{self.folder}/{p}" for p in paths])
