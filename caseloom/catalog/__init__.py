"""Every operator as a query over the given tables, with equivalent SQL where it can be said in SQL."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Source:
    """The given tables of one folder: ``Source(spark, dir).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


class Entry(NamedTuple):
    build: Callable[[Source], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated function under ``name`` with its SQL."""

    def keep(build: Callable[[Source], DataFrame]):
        REGISTRY[name] = Entry(build, sql)
        return build

    return keep


def load() -> dict[str, Entry]:
    from caseloom.catalog import (  # noqa: F401
        audits,
        authorizations,
        canonical,
        claims,
        coverage,
        documents,
        histories,
        lookups,
        orders,
        runs,
        stages,
    )

    return REGISTRY
