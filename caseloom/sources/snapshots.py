"""Measures by key: a push replaces what its keys had, and every run's rows stay under its id."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.sources import manifests

BUCKETS = 64
_BUCKET = "snapshot_bucket"


class Snapshots:
    """A stored table of rows of ``schema`` under ``keys``, dealt into buckets by a hash of the key.

    ``push`` makes the rows of a run the current ones of every key they have;
    other keys stay as they are, and only buckets that hold a pushed key are
    rewritten. The rows that a key had stay in the history under their run. A
    key may have many rows, null keys are keys like others, repeated rows stay.
    A push appears as a whole, or not at all; of two at once, the second fails
    with ``manifests.Conflict`` and may be repeated.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, keys: list[str], buckets: int = BUCKETS, run: str = "run_id"):
        names = [f.name for f in schema.fields]
        if clash := {run, _BUCKET} & set(names):
            raise ValueError(f"columns {sorted(clash)} are the store's own")
        self.spark, self.folder, self.keys, self.buckets, self.run = spark, folder, keys, buckets, run
        self.columns = [run, *names]
        # a stored column may hold nulls, whatever the pushed one says
        self.schema = T.StructType([T.StructField(run, T.StringType()), *[T.StructField(f.name, f.dataType) for f in schema.fields]])
        self._layout = {"keys": keys, "buckets": buckets, "schema": json.loads(self.schema.json())}

    def _state(self) -> tuple[int, dict]:
        version, state = manifests.latest(self.spark, self.folder)
        if state and state["layout"] != self._layout:
            raise ValueError(f"{self.folder} was made with other keys, buckets or columns")
        return version, state or {"layout": self._layout, "current": {}, "runs": {}}

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.schema).option("recursiveFileLookup", True)  # a bucket is no column
        return reader.parquet(*[f"{self.folder}/{p}" for p in paths])

    def _write(self, df: DataFrame, kind: str) -> str:
        """A new folder of ``df`` by bucket; AQE splits a bucket that is heavy and joins light ones."""
        name = manifests.new_folder(self.folder, kind)
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        df.select(*self.columns, bucket.alias(_BUCKET)).hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.folder}/{name}")
        return name

    def _without(self, old: DataFrame, keys: DataFrame) -> DataFrame:
        """The rows of ``old`` whose key ``keys`` does not have, nulls being equal."""
        same = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in self.keys]
        return old.alias("o").join(keys.alias("n"), same, "left_anti").select(*self.columns)

    def push(self, df: DataFrame, run_id: str) -> None:
        """Make ``df`` the current rows of its keys, and those of ``run_id`` in the history.

        A run that pushes again replaces its earlier rows of the keys it pushes,
        so a retried push leaves the store as one push does.
        """
        version, state = self._state()
        pushed = self._write(df.select(F.lit(run_id).alias(self.run), *self.columns[1:]), "run")
        new = self._read([pushed])
        placed = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(_BUCKET, T.IntegerType())])).parquet(f"{self.folder}/{pushed}")
        touched = sorted(str(r[0]) for r in placed.select(_BUCKET).distinct().collect())  # as many as buckets at most
        keys = new.select(*self.keys).distinct()
        current, runs = dict(state["current"]), dict(state["runs"])
        if stale := sorted({current[b] for b in touched if b in current}):
            kept = self._without(self._read(stale), keys)
            folder = self._write(kept.unionByName(new), "current")
        else:
            folder = pushed
        current |= {b: f"{folder}/{_BUCKET}={b}" for b in touched}
        if earlier := runs.get(run_id):
            again = self._write(self._without(self._read(earlier), keys).unionByName(new), "run")
            runs[run_id] = [again]
        else:
            runs[run_id] = [pushed]
        manifests.publish(self.spark, self.folder, version + 1, state | {"current": current, "runs": runs})

    def current(self) -> DataFrame:
        """The rows that each key has now, with the run they are of."""
        return self._read(sorted(self._state()[1]["current"].values()))

    def history(self, *run_ids: str) -> DataFrame:
        """The rows of the named runs, or of all, as they were pushed."""
        runs = self._state()[1]["runs"]
        return self._read([p for r in (run_ids or sorted(runs)) for p in runs.get(r, [])])

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete what none of the last ``keep`` states names; no push may be under way."""
        kept = [manifests.read(self.spark, self.folder, v) for v in manifests.versions(self.spark, self.folder)[-keep:]]
        paths = [p for state in kept for p in [*state["current"].values(), *[x for r in state["runs"].values() for x in r]]]
        return manifests.vacuum(self.spark, self.folder, {p.split("/")[0] for p in paths}, keep)
