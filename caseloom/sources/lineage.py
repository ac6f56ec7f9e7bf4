"""Cut a plan by writing it to the shared folder the cluster names."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
FREEING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, one in the warehouse, which is shared as well."""
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.sparkContext.master.startswith("local") and (warehouse.startswith("file:") or "://" not in warehouse):
        raise RuntimeError(f"set {SETTING} to a folder that driver and executors share; the warehouse {warehouse} is local")
    return f"{warehouse}/_shared"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each table written within as soon as it is written: nothing reads them any more.

    Else they stay until the driver happens to collect garbage, and those of all stages lie on disk at once.
    """
    before = spark.conf.get(FREEING, None)
    spark.conf.set(FREEING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREEING)
        else:
            spark.conf.set(FREEING, before)


def cut(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from Parquet under the shared folder.

    A later stage that uses the table several times then scans just the columns
    it needs each time instead of planning and running all of the past again,
    and a lost executor costs a rescan, not a recomputation. The folder is
    unique per call; ``clear`` removes all of this application.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_tables: list[str] = []


def bucketed(keys: list[str], buckets: int | None = None) -> Callable[[DataFrame, str], DataFrame]:
    """Like ``cut``, but a table that has ``keys`` is written in buckets of them, sorted, one file each.

    Tables of one number of buckets, by default that of the shuffle's partitions,
    join and group by the keys without a shuffle: it is paid once, when a table
    is written. They are tables of the session's catalog until ``clear``.
    """

    def write(df: DataFrame, name: str) -> DataFrame:
        if not set(keys) <= set(df.columns):
            return cut(df, name)
        spark = df.sparkSession
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        table = f"caseloom_{name}_{uuid.uuid4().hex}"
        writer = df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys)
        with shuffles_freed(spark):
            writer.option("path", new_path(spark, name)).saveAsTable(table)
        _tables.append(table)
        return spark.table(table)

    return write


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has been written to."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/caseloom/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Delete every table that ``cut`` or ``bucketed`` wrote in this application; their DataFrames can no longer be read."""
    while _tables:
        spark.sql(f"DROP TABLE IF EXISTS {_tables.pop()}")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
