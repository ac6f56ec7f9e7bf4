"""Stages that are published as a whole, and run again only where what they read has changed."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.sources import manifests, tables


def publish_stage(df: DataFrame, folder: str, fmt: str = "parquet", fingerprint: str = "") -> int:
    """Write ``df`` as a new attempt under ``folder`` and make it the stage; the number of its rows.

    Until the manifest is published, and for ever if the writer is lost before,
    readers get the stage as it was.
    """
    spark = df.sparkSession
    version, _ = manifests.latest(spark, folder)
    attempt = manifests.new_folder(folder, "attempt")
    seen = Observation(attempt)
    tables.write_stage(df.observe(seen, F.count(F.lit(1)).alias("rows")), f"{folder}/{attempt}", fmt)
    rows = seen.get["rows"]
    state = {"attempt": attempt, "format": fmt, "schema": json.loads(df.schema.json()), "rows": rows, "fingerprint": fingerprint}
    manifests.publish(spark, folder, version + 1, state)
    return rows


def read_published(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the stage as last published, under the schema it was written with."""
    version, state = manifests.latest(spark, folder)
    if not version:
        raise FileNotFoundError(f"no stage is published in {folder}")
    schema = T.StructType.fromJson(state["schema"])
    path = f"{folder}/{state['attempt']}"
    return tables.read_stage(spark, path, state["format"], schema) if state["format"] != "parquet" else spark.read.schema(schema).parquet(path)


def identity(spark: SparkSession, path: str) -> list:
    """What tells one content of ``path`` from another: the attempt of a published stage, else its files by name, size and time."""
    version, state = manifests.latest(spark, path)
    if version:
        return [version, state["attempt"]]
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = fs.Path(path)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, files = [], system.listFiles(root, True)
    while files.hasNext():
        f = files.next()
        if not f.getPath().getName().startswith((".", "_")):
            found.append([f.getPath().toString(), f.getLen(), f.getModificationTime()])
    return sorted(found)


def fingerprint(spark: SparkSession, inputs: Mapping[str, str], logic: str) -> str:
    """A digest of the content of each named input and of ``logic``, which names the stage, its settings and edition."""
    told = {name: identity(spark, path) for name, path in inputs.items()}
    return hashlib.sha256(json.dumps([logic, told], sort_keys=True).encode()).hexdigest()


def resume_stage(
    spark: SparkSession, folder: str, inputs: Mapping[str, str], logic: str, build: Callable[[], DataFrame], fmt: str = "parquet"
) -> bool:
    """Publish ``build()`` in ``folder`` unless it was made by this ``logic`` from these inputs as they are now; whether it ran.

    The fingerprint is taken before the inputs are read, so one that changes
    meanwhile makes the next call run again.
    """
    now = fingerprint(spark, inputs, f"{logic} {fmt}")
    version, state = manifests.latest(spark, folder)
    if version and state["fingerprint"] == now:
        return False
    publish_stage(build(), folder, fmt, now)
    return True


def vacuum_stage(spark: SparkSession, folder: str, keep: int = 1) -> list[str]:
    """Delete attempts that none of the last ``keep`` manifests names; nobody may be writing."""
    kept = [manifests.read(spark, folder, v)["attempt"] for v in manifests.versions(spark, folder)[-keep:]]
    return manifests.vacuum(spark, folder, set(kept), keep)
