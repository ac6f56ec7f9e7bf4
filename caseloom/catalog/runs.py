"""Measures of a run, here over events and lines as the measured tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.catalog import Source, query
from caseloom.operators import profiles, runmetrics
from caseloom.sources.lineage import new_path
from caseloom.sources.snapshots import Snapshots


@query(
    "skew_ratio",
    """SELECT event_type, count(value) AS value_count, max(value) AS max_value,
      round(quantile_cont(value, 0.5), 9) AS median_value,
      CASE WHEN quantile_cont(value, 0.5) > 0 THEN round(max(value) / quantile_cont(value, 0.5), 6) END AS skew_ratio
    FROM events GROUP BY event_type""",
)
def skew_ratio(src: Source) -> DataFrame:
    out = runmetrics.skew_ratio(src.events, ["event_type"], "value")
    return out.withColumns({"median_value": F.round("median_value", 9), "skew_ratio": F.round("skew_ratio", 6)})


@query(
    "latest_per_key",
    """SELECT user_id, event_type, event_id, ts, value, props FROM (SELECT *, row_number() OVER (
      PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def latest_per_key(src: Source) -> DataFrame:
    return runmetrics.latest_per_key(src.events, ["user_id", "event_type"], "ts", ["event_id"])


@query(
    "run_durations",
    """SELECT user_id, CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS BIGINT) AS duration_us FROM events GROUP BY user_id""",
)
def run_durations(src: Source) -> DataFrame:
    ts = F.unix_micros(F.col("ts").cast("timestamp"))
    return runmetrics.durations(src.events, ["user_id"], ts, ts, "duration_us")


_RUN = "event_id % 3"
_PUSHED = "event_type, user_id, event_id, value"


@query(
    "snapshot_runs",
    f"""WITH pushed AS (SELECT 'run-' || CAST({_RUN} AS STRING) AS run_id, user_id % 500 AS user_id, event_type, event_id, value FROM events
        WHERE (user_id + event_id % 3) % 4 <> 0)
    SELECT 'history' AS state, run_id, {_PUSHED} FROM pushed UNION ALL SELECT 'current', run_id, {_PUSHED} FROM
      (SELECT *, max(run_id) OVER (PARTITION BY event_type, user_id) AS last FROM pushed) WHERE run_id = last""",
)
def snapshot_runs(src: Source) -> DataFrame:
    """Three runs push events by (type, user); each lacks some users, whose rows of an earlier run stay current."""
    events = src.events.where("(user_id + event_id % 3) % 4 <> 0").withColumn("run", F.expr(_RUN))
    rows = events.select("event_type", (F.col("user_id") % 500).alias("user_id"), "event_id", "value", "run")
    store = Snapshots(src.spark, new_path(src.spark, "snapshots"), rows.drop("run").schema, ["event_type", "user_id"], buckets=16)
    for run in (0, 1, 2, 1, 2):  # runs that push again leave the store as it was
        store.push(rows.where(F.col("run") == run).drop("run"), f"run-{run}")
    both = [store.history().withColumn("state", F.lit("history")), store.current().withColumn("state", F.lit("current"))]
    return both[0].unionByName(both[1])


_MS = "CAST(floor(abs(value) * 1000) AS BIGINT)"
_TASKS = f"""SELECT user_id % 16 AS app, user_id % 5 AS stage_id, event_id % 2 AS attempt_id, CAST(user_id % 3 AS STRING) AS executor_id,
    {_MS} AS run_ms, event_id % 50 AS gc_ms, (event_id % 1000) * 4096 AS memory_spill_bytes, (event_id % 1000) * 512 AS disk_spill_bytes,
    user_id * 10 AS remote, event_id % 7 AS local, event_id * 3 AS shuffle_write_bytes, (event_id * 7919) % 1000003 AS heap_bytes FROM {{events}}"""


def _landed_log(src: Source) -> DataFrame:
    """Events as the ends of tasks of 16 applications, landed as one event log each and read back."""
    tasks = src.spark.sql(_TASKS, events=src.events)
    ended = F.struct(
        F.lit("SparkListenerTaskEnd").alias("Event"),
        F.col("stage_id").alias("Stage ID"),
        F.col("attempt_id").alias("Stage Attempt ID"),
        F.struct(F.col("executor_id").alias("Executor ID")).alias("Task Info"),
        F.struct(
            F.col("run_ms").alias("Executor Run Time"),
            F.col("gc_ms").alias("JVM GC Time"),
            F.col("memory_spill_bytes").alias("Memory Bytes Spilled"),
            F.col("disk_spill_bytes").alias("Disk Bytes Spilled"),
            F.struct(F.col("remote").alias("Remote Bytes Read"), F.col("local").alias("Local Bytes Read")).alias("Shuffle Read Metrics"),
            F.struct(F.col("shuffle_write_bytes").alias("Shuffle Bytes Written")).alias("Shuffle Write Metrics"),
        ).alias("Task Metrics"),
        F.struct(F.col("heap_bytes").alias("JVMHeapMemory")).alias("Task Executor Metrics"),
    )
    name = F.concat(F.lit("app-"), F.col("app").cast("string"))
    started = F.struct(F.lit("SparkListenerApplicationStart").alias("Event"), F.lit("job").alias("App Name"), name.alias("App ID"))
    added = F.struct(
        F.lit("SparkListenerBlockManagerAdded").alias("Event"),
        F.struct(F.col("executor_id").alias("Executor ID")).alias("Block Manager ID"),
        F.lit(1 << 30).alias("Maximum Memory"),
    )
    lines = tasks.select("app", F.to_json(ended).alias("value"))
    lines = lines.unionByName(tasks.select("app").distinct().select("app", F.to_json(started).alias("value")))
    known = tasks.select("app", "executor_id").distinct().where("executor_id <> '2'")
    lines = lines.unionByName(known.select("app", F.to_json(added).alias("value")))
    path = new_path(src.spark, "event_logs")
    lines.repartition("app").write.partitionBy("app").text(path)  # a log is one file
    return runmetrics.read_event_log(src.spark, path)


_T = f"t AS ({_TASKS.format(events='events')})"
_SPILL = "memory_spill_bytes", "disk_spill_bytes"


@query(
    "stage_totals",
    f"""WITH {_T} SELECT 'app-' || CAST(app AS STRING) AS app_id, stage_id, attempt_id, count(*) AS task_count,
      CAST(sum(remote + local) AS BIGINT) AS shuffle_read_bytes, CAST(sum(shuffle_write_bytes) AS BIGINT) AS shuffle_write_bytes,
      {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _SPILL)},
      CASE WHEN quantile_cont(run_ms, 0.5) > 0 THEN round(max(run_ms) / quantile_cont(run_ms, 0.5), 6) END AS task_duration_skew_ratio
    FROM t GROUP BY app, stage_id, attempt_id""",
)
def stage_totals(src: Source) -> DataFrame:
    ratio = F.round("task_duration_skew_ratio", 6)
    return runmetrics.stage_totals(_landed_log(src)).withColumn("task_duration_skew_ratio", ratio)


@query(
    "executor_totals",
    f"""WITH {_T} SELECT 'app-' || CAST(app AS STRING) AS app_id, executor_id, max(heap_bytes) AS heap_used_bytes,
      CAST(sum(gc_ms) AS BIGINT) AS gc_ms, CASE WHEN executor_id <> '2' THEN CAST(1073741824 AS BIGINT) END AS heap_max_bytes
    FROM t GROUP BY app, executor_id""",
)
def executor_totals(src: Source) -> DataFrame:
    return runmetrics.executor_totals(_landed_log(src))


_MEASURED = ("event_id", "user_id", "value")
_OF_COLUMN = " UNION ALL ".join(
    f"""SELECT 'part-' || CAST(event_id % 4 AS STRING) AS run_id, '{c}' AS column_name, CAST({c} AS DOUBLE) AS v FROM events"""
    for c in _MEASURED
)


@query(
    "merged_profiles",
    f"""WITH t AS ({_OF_COLUMN}) SELECT column_name, count(*) AS n_rows, count(*) - count(v) AS n_null, min(v) AS least_number,
      max(v) AS greatest_number, true AS distinct_holds, true AS median_holds FROM t WHERE run_id <> 'part-3' GROUP BY column_name""",
)
def merged_profiles(src: Source) -> DataFrame:
    """Four landings sketched one by one, three summed up, held against exact numbers over their rows."""
    store = profiles.Profiles(src.spark, new_path(src.spark, "profiles"))
    events = src.events.select(*_MEASURED)
    for part in range(4):
        store.add(events.where(F.col("event_id") % 4 == part), f"part-{part}", "landed")
    told = profiles.estimates(profiles.merged(store.read("part-0", "part-1", "part-2")))
    landed = events.where(F.col("event_id") % 4 != 3)
    long = landed.unpivot([], [F.col(c).cast("double").alias(c) for c in _MEASURED], "column_name", "v")
    rank = (F.count_if(F.col("v") < F.col("q50")) / F.count("v"), F.count_if(F.col("v") <= F.col("q50")) / F.count("v"))
    exact = long.join(F.broadcast(told.select("column_name", "q50")), "column_name").groupBy("column_name")
    exact = exact.agg(F.count_distinct("v").alias("_n"), rank[0].alias("_below"), rank[1].alias("_upto"))
    half = profiles.rank_error()
    return told.join(exact, "column_name").select(
        "column_name",
        "n_rows",
        "n_null",
        "least_number",
        "greatest_number",
        (F.abs(F.col("n_distinct") - F.col("_n")) <= profiles.distinct_error() * F.col("_n")).alias("distinct_holds"),
        ((F.col("_below") <= 0.5 + half) & (F.col("_upto") >= 0.5 - half)).alias("median_holds"),
    )
