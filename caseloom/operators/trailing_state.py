"""Trailing metrics kept up to date: new history is merged into totals by key and day, old history is not read again."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom import fixed_values as fv
from caseloom.operators.history import daily_facts, metrics_of_days
from caseloom.sources import manifests

#: days of one folder; a batch rewrites the folders of the days it has
PERIOD = 32
_PERIOD = "_period"
_TOTALS = ("_n", "_sum", "_known")


class TrailingState:
    """Totals by (keys, day) under ``folder``, stored by periods of days.

    ``merge`` adds a batch of history, late days included, and rewrites only the
    periods that it has rows of; a batch that was merged before changes nothing,
    so a retry is safe. ``metrics`` equals ``trailing_metrics`` over all merged
    history, reading only the periods that the asked days reach back to. Stored
    are as many rows per key as it has days, however many rows its history has.
    """

    def __init__(self, spark: SparkSession, folder: str, key_schema: T.StructType, period: int = PERIOD):
        self.spark, self.folder, self.period = spark, folder, period
        self.keys = key_schema.fieldNames()
        totals = [T.StructField(n, T.LongType()) for n in ("_day", *_TOTALS)]
        self.schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in key_schema.fields], *totals])
        self._layout = {"schema": json.loads(self.schema.json()), "period": period}

    def _state(self) -> tuple[int, dict]:
        version, state = manifests.latest(self.spark, self.folder)
        if state and state["layout"] != self._layout:
            raise ValueError(f"{self.folder} was made with other keys or periods")
        return version, state or {"layout": self._layout, "periods": {}, "batches": []}

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.schema).option("recursiveFileLookup", True)
        return reader.parquet(*[f"{self.folder}/{p}" for p in paths])

    def _of_period(self):
        return F.floor(F.col("_day") / self.period).cast("long")

    def _write(self, totals: DataFrame) -> tuple[str, list[int]]:
        """A new folder of ``totals`` added up by key and day, and the periods in it."""
        added = totals.groupBy(*self.keys, "_day").agg(*[F.sum(n).alias(n) for n in _TOTALS])
        name = manifests.new_folder(self.folder, "days")
        placed = added.withColumn(_PERIOD, self._of_period()).hint("rebalance", _PERIOD)
        placed.write.partitionBy(_PERIOD).parquet(f"{self.folder}/{name}")
        found = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(_PERIOD, T.LongType())])).parquet(f"{self.folder}/{name}")
        return name, sorted(r[0] for r in found.select(_PERIOD).distinct().collect())  # as many as periods

    def merge(self, history: DataFrame, batch: str, day: str, amount: str) -> bool:
        """Add ``history`` under the name ``batch``; false if that was merged before."""
        version, state = self._state()
        if batch in state["batches"]:
            return False
        new, touched = self._write(daily_facts(history, self.keys, day, amount))
        periods = dict(state["periods"])
        if old := [periods[str(p)] for p in touched if str(p) in periods]:
            new, touched = self._write(self._read(old).unionByName(self._read([new])))
        periods |= {str(p): f"{new}/{_PERIOD}={p}" for p in touched}
        manifests.publish(self.spark, self.folder, version + 1, state | {"periods": periods, "batches": [*state["batches"], batch]})
        return True

    def metrics(
        self,
        current: DataFrame,
        current_day: str,
        names: tuple[str, str, str, str] = ("prior_count", "prior_amount", "last_prior_date", "mean_prior_amount"),
        days: int = fv.HISTORY_DAYS,
    ) -> DataFrame:
        """``current`` with count, sum, latest day and mean amount of the merged history in [day - days, day)."""
        asked = F.unix_date(F.col(current_day))
        first, last = current.agg(F.min(asked), F.max(asked)).first()
        periods = self._state()[1]["periods"] if first is not None else {}
        reach = [path for p, path in sorted(periods.items()) if (first - days) // self.period <= int(p) <= (last - 1) // self.period]
        facts = self._read(reach).where(F.col("_day").between(F.lit((first or 0) - days), F.lit((last or 0) - 1)))
        return metrics_of_days(current, facts.withColumn("_day", F.col("_day").cast("int")), self.keys, current_day, names, days)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete what none of the last ``keep`` states names; no merge may be under way."""
        kept = [manifests.read(self.spark, self.folder, v) for v in manifests.versions(self.spark, self.folder)[-keep:]]
        return manifests.vacuum(self.spark, self.folder, {p.split("/")[0] for s in kept for p in s["periods"].values()}, keep)
