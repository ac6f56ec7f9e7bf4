"""Tables made of folders that a numbered manifest names, so that a new state appears as a whole or not at all.

A writer puts data under a new name, then publishes a manifest of the next
number by one rename that fails where that number is taken. A reader takes the
highest number. What a lost or crashed writer left behind is named by no
manifest, and the state before it stays readable.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession

_NAMES = "_manifests"


class Conflict(RuntimeError):
    """Another writer has published this number; read the new state and try again."""


def _hadoop(spark: SparkSession, folder: str):
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = fs.Path(folder)
    return fs, path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_folder(folder: str, kind: str) -> str:
    """A name under ``folder`` that nothing has been written to."""
    return f"{kind}-{uuid.uuid4().hex}"


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The numbers published in ``folder``, ascending."""
    fs, path, system = _hadoop(spark, f"{folder}/{_NAMES}")
    if not system.exists(path):
        return []
    names = [s.getPath().getName() for s in system.listStatus(path)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def read(spark: SparkSession, folder: str, version: int) -> dict[str, Any]:
    _, path, system = _hadoop(spark, f"{folder}/{_NAMES}/{version:012d}.json")
    stream = system.open(path)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def latest(spark: SparkSession, folder: str) -> tuple[int, dict[str, Any]]:
    """The highest number and what it says; (0, {}) where nothing is published."""
    found = versions(spark, folder)
    return (found[-1], read(spark, folder, found[-1])) if found else (0, {})


def publish(spark: SparkSession, folder: str, version: int, content: dict[str, Any]) -> None:
    """Make ``content`` the state of ``folder`` under ``version``, which must be new."""
    fs, path, system = _hadoop(spark, f"{folder}/{_NAMES}/{version:012d}.json")
    attempt = fs.Path(f"{folder}/{_NAMES}/.attempt-{uuid.uuid4().hex}")
    system.mkdirs(path.getParent())
    out = system.create(attempt, False)
    try:
        out.write(json.dumps(content, sort_keys=True).encode())
    finally:
        out.close()
    context = fs.FileContext.getFileContext(path.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        context.rename(system.makeQualified(attempt), system.makeQualified(path), options)
    except Exception as e:
        system.delete(attempt, False)
        if system.exists(path):
            raise Conflict(f"{folder} has a version {version} already") from e
        raise


def vacuum(spark: SparkSession, folder: str, named: set[str], keep: int = 1) -> list[str]:
    """Delete all but the last ``keep`` manifests, and the folders that ``named`` does not hold; no writer may be at work.

    ``named`` are the names, relative to ``folder``, that the manifests kept speak of.
    """
    fs, path, system = _hadoop(spark, folder)
    for version in versions(spark, folder)[:-keep]:
        system.delete(fs.Path(f"{folder}/{_NAMES}/{version:012d}.json"), False)
    gone = [s.getPath().getName() for s in system.listStatus(path) if s.getPath().getName() not in {_NAMES, *named}]
    for name in gone:
        system.delete(fs.Path(f"{folder}/{name}"), True)
    return sorted(gone)
