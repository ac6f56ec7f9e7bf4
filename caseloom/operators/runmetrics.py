"""Measures of a run, from an event log or any measured table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.functions.skew import salted_join

def _digits(v: Column, kind: T.DataType) -> list[Column]:
    """Numbers that order like ``v`` from left to right, few enough of each that a histogram of one is small.

    A whole number is four digits of 16 bits of its offset from the least long.
    Any other is read as a double: sign and power of two, at most 4,200 of them,
    then the 52 bits after the leading one in digits of 17, 17 and 18 bits.
    Infinities and NaN, the greatest, have powers of their own.
    """
    if isinstance(kind, T.IntegralType):
        whole = v.cast("long")
        top = F.shiftright(whole, 48)
        return [top, *[F.shiftright(whole, s).bitwiseAND(F.lit(0xFFFF)) for s in (32, 16, 0)]]
    x = v.cast("double")
    size = F.abs(x)
    odd = x.isNull() | F.isnan(x) | (size == float("inf")) | (size == 0)
    about = F.floor(F.log2(size))  # off by one near a power of two
    base = lambda e: F.pow(F.lit(2.0), e.cast("double"))
    power = about + F.when(base(about) > size, -1).when(base(about + 1) <= size, 1).otherwise(0)
    first = F.when(F.isnan(x), 2100).when(size == float("inf"), 2099).when(size == 0, 0).otherwise(power + 1075)
    # halved twice where 2 ** power alone is out of range on one side
    half = F.floor(power / 2)
    after = ((size / base(half) / base(power - half) - 1) * F.lit(float(1 << 52))).cast("long")
    bits = F.when(odd, F.lit(0).cast("long")).when(x < 0, F.lit((1 << 52) - 1) - after).otherwise(after)
    sign = F.when(x < 0, -1).otherwise(1)
    return [
        (sign * first).cast("long"),
        F.shiftright(bits, 35),
        F.shiftright(bits, 18).bitwiseAND(F.lit((1 << 17) - 1)),
        bits.bitwiseAND(F.lit((1 << 18) - 1)),
    ]


def exact_median(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Exact median per group plus count and maximum, however large a group is.

    ``percentile`` would keep every distinct value of a group in one task. Here
    values are folded to (value, count), and a histogram of their leading digit,
    see ``_digits``, tells for all groups at once which bucket holds the middle
    rank or ranks. Only that bucket is counted by the next digit, and so on; four
    digits are a value. No window sees more rows of a group than a digit has
    values. Decimals are ordered as doubles; NaN is the greatest, nulls do not count.
    """
    digits = ["_d0", "_d1", "_d2", "_d3"]
    known = df.select(F.struct(*by).alias("_g"), F.col(value).alias("_v")).where(F.col("_v").isNotNull())
    folded = known.groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_c"))
    kind = df.schema[value].dataType
    folded = folded.select("_g", "_v", "_c", *[d.alias(n) for d, n in zip(_digits(F.col("_v"), kind), digits, strict=True)])
    path: list[str] = []
    targets = None
    for digit in digits:
        carried = ["_g", *path, *(["_n", "_max", "_ranks"] if path else [])]
        within = folded if targets is None else salted_join(folded, targets, ["_g", *path], "inner", ["_v"])
        counts = within.groupBy(*carried, digit).agg(F.sum("_c").alias("_c"), F.max("_v").alias("_v"))
        group = Window.partitionBy("_g", *path)
        counts = counts.withColumn("_upto", F.sum("_c").over(group.orderBy(digit).rowsBetween(Window.unboundedPreceding, 0)))
        if targets is None:
            counts = counts.withColumns({"_n": F.sum("_c").over(group), "_max": F.max("_v").over(group)})
            ranks = F.array_distinct(F.array(F.floor((F.col("_n") + 1) / 2), F.floor((F.col("_n") + 2) / 2)))
            counts = counts.withColumn("_ranks", ranks)
        before = F.col("_upto") - F.col("_c")
        held = F.filter("_ranks", lambda r: (r > before) & (r <= F.col("_upto")))
        path.append(digit)
        targets = counts.withColumn("_ranks", F.transform(held, lambda r: r - before)).where(F.size("_ranks") > 0)
        targets = targets.select("_g", *path, "_n", "_max", "_ranks", *(["_v"] if digit == digits[-1] else []))
    middle = targets.groupBy("_g", "_n", "_max").agg(F.min("_v").alias("_a"), F.max("_v").alias("_b"))
    return middle.select(
        "_g.*",
        F.col("_n").alias("value_count"),
        F.col("_max").alias("max_value"),
        ((F.col("_a") + F.col("_b")) / 2).alias("median_value"),
    )


def skew_ratio(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Largest value over the median per group; null unless the median is positive."""
    ratio = F.when(F.col("median_value") > 0, F.col("max_value") / F.col("median_value"))
    return exact_median(df, by, value).withColumn("skew_ratio", ratio)


def latest_per_key(df: DataFrame, keys: list[str], time: str, tie: Sequence[str] = ()) -> DataFrame:
    """The newest row per key; ``tie`` decides between equal times (largest wins)."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(time, *tie))
    return df.groupBy(*keys).agg(newest.alias("_r")).select(*keys, "_r.*")


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Spark event log rows with the log they are of; the schema names only what the totals below use.

    A log is one file, or a folder of rolled files (``eventlog_v2_...``), which
    all belong to one application.
    """
    schema = """
        Event string, Timestamp long, `App Name` string, `App ID` string,
        `Stage ID` long, `Stage Attempt ID` long, `Executor ID` string, `Job ID` long,
        `Submission Time` long, `Completion Time` long, `Maximum Memory` long,
        `Task Info` struct<`Executor ID`: string, `Launch Time`: long, `Finish Time`: long>,
        `Task Metrics` struct<
            `Executor Run Time`: long, `JVM GC Time`: long,
            `Memory Bytes Spilled`: long, `Disk Bytes Spilled`: long,
            `Shuffle Read Metrics`: struct<`Remote Bytes Read`: long, `Local Bytes Read`: long>,
            `Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: long>>,
        `Task Executor Metrics` struct<`JVMHeapMemory`: long>,
        `Block Manager ID` struct<`Executor ID`: string>
    """
    log = spark.read.schema(schema).option("recursiveFileLookup", True).json(path)
    file = F.col("_metadata.file_path")
    rolled = F.regexp_extract(file, r"^(.*/eventlog_v2_[^/]*)/events_[^/]*$", 1)
    return log.select("*", F.when(rolled != "", rolled).otherwise(file).alias("log"))


def applications(log: DataFrame) -> DataFrame:
    """(log, app_id, app_name): one row per log, null names where the start is not logged."""
    start = log.where(F.col("App ID").isNotNull())
    return start.groupBy("log").agg(F.min("App ID").alias("app_id"), F.min("App Name").alias("app_name"))


def _of_application(df: DataFrame, log: DataFrame) -> DataFrame:
    """``df``, which has the column log, with the application's id in its place; the log's name stands in for a missing id."""
    named = df.join(applications(log).select("log", "app_id"), "log", "left")
    return named.withColumn("app_id", F.coalesce("app_id", "log")).drop("log")


def _tasks(log: DataFrame) -> DataFrame:
    m = F.col("Task Metrics")
    reads = m["Shuffle Read Metrics"]
    tasks = log.where(F.col("Event") == "SparkListenerTaskEnd").select(
        "log",
        F.col("Stage ID").alias("stage_id"),
        F.col("Stage Attempt ID").alias("attempt_id"),
        F.col("Task Info")["Executor ID"].alias("executor_id"),
        m["Executor Run Time"].alias("run_ms"),
        m["JVM GC Time"].alias("gc_ms"),
        m["Memory Bytes Spilled"].alias("memory_spill_bytes"),
        m["Disk Bytes Spilled"].alias("disk_spill_bytes"),
        (F.coalesce(reads["Remote Bytes Read"], F.lit(0)) + F.coalesce(reads["Local Bytes Read"], F.lit(0))).alias(
            "shuffle_read_bytes"
        ),
        m["Shuffle Write Metrics"]["Shuffle Bytes Written"].alias("shuffle_write_bytes"),
        F.col("Task Executor Metrics")["JVMHeapMemory"].alias("heap_bytes"),
    )
    return _of_application(tasks, log)


def stage_totals(log: DataFrame) -> DataFrame:
    """Tasks, shuffle and spill bytes per application and stage, and its task-time skew."""
    tasks = _tasks(log)
    keys = ["app_id", "stage_id", "attempt_id"]
    measures = ["shuffle_read_bytes", "shuffle_write_bytes", "memory_spill_bytes", "disk_spill_bytes"]
    totals = tasks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("task_count"), *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures]
    )
    skew = skew_ratio(tasks, keys, "run_ms").select(*keys, F.col("skew_ratio").alias("task_duration_skew_ratio"))
    return totals.join(skew, keys, "left")


def executor_totals(log: DataFrame) -> DataFrame:
    """Peak heap, memory limit and collection time per application and executor."""
    keys = ["app_id", "executor_id"]
    used = _tasks(log).groupBy(*keys).agg(
        F.max("heap_bytes").alias("heap_used_bytes"), F.sum("gc_ms").alias("gc_ms")
    )
    added = log.where(F.col("Event") == "SparkListenerBlockManagerAdded").select(
        "log", F.col("Block Manager ID")["Executor ID"].alias("executor_id"), "Maximum Memory"
    )
    limits = _of_application(added, log).groupBy(*keys).agg(F.max("Maximum Memory").alias("heap_max_bytes"))
    return used.join(limits, keys, "full")


def durations(df: DataFrame, keys: list[str], start: Column, end: Column, out: str = "duration") -> DataFrame:
    """The last end minus the first start per key, in the unit of the two columns."""
    return df.groupBy(*keys).agg((F.max(end) - F.min(start)).alias(out))


def application_durations(log: DataFrame) -> DataFrame:
    """Wall-clock seconds per application, from its first to its last logged moment."""
    moments = F.array_compact(
        F.array("Timestamp", "Submission Time", "Completion Time", F.col("Task Info")["Finish Time"])
    )
    timed = log.select("log", F.explode(moments).alias("_ms"))
    seconds = F.col("_ms") / 1000.0
    spans = durations(timed, ["log"], seconds, seconds, "duration_seconds")
    return spans.join(applications(log), "log", "left").drop("log")
