"""Run measures from a small hand-made event log."""

import json

from caseloom.operators import runmetrics


def task(stage, executor, ms, gc=0, heap=0, read=0, written=0, spill=0, end=0):
    return {
        "Event": "SparkListenerTaskEnd",
        "Stage ID": stage,
        "Stage Attempt ID": 0,
        "Task Info": {"Executor ID": executor, "Launch Time": end - ms, "Finish Time": end},
        "Task Executor Metrics": {"JVMHeapMemory": heap},
        "Task Metrics": {
            "Executor Run Time": ms,
            "JVM GC Time": gc,
            "Memory Bytes Spilled": spill,
            "Disk Bytes Spilled": spill // 2,
            "Shuffle Read Metrics": {"Remote Bytes Read": read, "Local Bytes Read": 1},
            "Shuffle Write Metrics": {"Shuffle Bytes Written": written},
        },
    }


def test_totals(spark, tmp_path):
    events = [
        {"Event": "SparkListenerApplicationStart", "App Name": "job", "App ID": "app-1", "Timestamp": 1000},
        {"Event": "SparkListenerBlockManagerAdded", "Block Manager ID": {"Executor ID": "1"}, "Maximum Memory": 500, "Timestamp": 1001},
        task(0, "1", 10, gc=2, heap=100, read=5, written=7, end=2000),
        task(0, "1", 20, gc=3, heap=300, end=2100),
        task(0, "2", 90, heap=50, spill=8, end=2200),
        {"Event": "SparkListenerApplicationEnd", "Timestamp": 5000},
    ]
    path = tmp_path / "events_1"
    path.write_text("\n".join(json.dumps(e) for e in events))
    log = runmetrics.read_event_log(spark, str(path))
    stage = runmetrics.stage_totals(log).first()
    assert (stage["task_count"], stage["shuffle_read_bytes"], stage["shuffle_write_bytes"]) == (3, 8, 7)
    assert (stage["memory_spill_bytes"], stage["disk_spill_bytes"], stage["task_duration_skew_ratio"]) == (8, 4, 4.5)
    by = {r["executor_id"]: r for r in runmetrics.executor_totals(log).collect()}
    assert (by["1"]["heap_used_bytes"], by["1"]["gc_ms"], by["1"]["heap_max_bytes"]) == (300, 5, 500)
    assert by["2"]["heap_max_bytes"] is None
    run = runmetrics.application_durations(log).first()
    assert (run["app_id"], run["duration_seconds"]) == ("app-1", 4.0)


def write(path, events):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(e) for e in events))


def start(app, at):
    return {"Event": "SparkListenerApplicationStart", "App Name": app, "App ID": app, "Timestamp": at}


def test_two_applications_and_a_rolled_log(spark, tmp_path):
    write(tmp_path / "logs" / "app-1", [start("app-1", 1000), task(0, "1", 10, read=4, heap=5, end=2000)])
    rolled = tmp_path / "logs" / "eventlog_v2_app-2"
    write(rolled / "events_1_app-2", [start("app-2", 1000), task(0, "1", 30, read=9, heap=7, end=2000)])
    write(rolled / "events_2_app-2", [task(0, "1", 50, read=9, heap=8, end=9000), {"Event": "SparkListenerApplicationEnd", "Timestamp": 10_000}])
    log = runmetrics.read_event_log(spark, str(tmp_path / "logs"))
    stages = {r["app_id"]: r for r in runmetrics.stage_totals(log).collect()}
    assert {a: (r["task_count"], r["shuffle_read_bytes"]) for a, r in stages.items()} == {"app-1": (1, 5), "app-2": (2, 20)}
    heaps = {(r["app_id"], r["executor_id"]): r["heap_used_bytes"] for r in runmetrics.executor_totals(log).collect()}
    assert heaps == {("app-1", "1"): 5, ("app-2", "1"): 8}
    seconds = {r["app_id"]: r["duration_seconds"] for r in runmetrics.application_durations(log).collect()}
    assert seconds == {"app-1": 1.0, "app-2": 9.0}
