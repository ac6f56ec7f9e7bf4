"""What the operators of this package share: cutting lineage, reading tables, bounded Arrow pieces."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.sources import lineage

#: bytes of one column that a Python helper turns into arrays at a time
PIECE_BYTES = 2 << 20


def shared_uri(spark: SparkSession) -> str:
    """The folder that driver and executors share, see ``lineage.shared_folder``."""
    return lineage.shared_folder(spark)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library's modules to the executors, once per application, as their Python helpers import it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="modules-")) / f"{root.name}.zip"  # Spark copies it to every executor
        with zipfile.ZipFile(archive, "w") as out:
            for module in sorted(root.rglob("*.py")):
                out.write(module, module.relative_to(root.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)


#: rows of a narrow table that a task can well go through
NARROW_ROWS = 100_000


def packed(df: DataFrame) -> DataFrame:
    """A saved narrow table, read in no more partitions than its rows need, so that what is small stays cheap to shuffle."""
    out = saved(df)
    return out.coalesce(max(1, -(-out.count() // NARROW_ROWS)))


_files: list[str] = []


def saved(df: DataFrame) -> DataFrame:
    """The same rows out of a reliable checkpoint, so that a lost executor costs a read.

    The files stay until ``released`` or ``clear`` deletes them, or until Spark
    does where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    spark = df.sparkSession
    ship(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_uri(spark))
    out = df.checkpoint()
    file = out._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        _files.append(file.get())
    return out


def cleaned(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of tables that are no longer held, as it does by itself twice an hour.

    After a table is ``saved`` the shuffles that made it are read no more.
    """
    gc.collect()  # what Python holds of them is let go first
    spark.sparkContext._jvm.System.gc()


def delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what was ``saved`` within; tables made within that are read later must have been written."""
    before = len(_files)
    yield
    for file in _files[before:]:
        delete(spark, file)
    del _files[before:]


def clear(spark: SparkSession) -> None:
    """Delete all that this application has saved or written in the shared folder; its DataFrames can no longer be read."""
    for file in _files:
        delete(spark, file)
    _files.clear()
    lineage.clear(spark)


def tune(spark: SparkSession) -> SparkSession:
    """What the queries count on: AQE splits heavy partitions of a join, also below a grouping."""
    for key in ("enabled", "skewJoin.enabled", "forceOptimizeSkewedJoin"):
        spark.conf.set(f"spark.sql.adaptive.{key}", "true")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return tune(spark).read.parquet(f"{folder}/{name}.parquet")


def beside(docs: DataFrame, **columns: Column) -> DataFrame:
    """``docs`` as one column, row, with ``columns`` beside it, so that no name of ``docs`` can clash with theirs."""
    return docs.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in columns.items()])


def text_key(text: str = "text") -> Column:
    """128 bits that stand for a whole text; a null text counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in order, in slices of about ``most`` bytes of ``column``; one row is never split."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
        pa.default_memory_pool().release_unused()


#: rows of a narrow table that may be sent to every executor; beyond them it is joined by a shuffle
BROADCAST_ROWS = 200_000


def small_side(df: DataFrame, most: int | None = None) -> DataFrame:
    """A narrow, saved table with a broadcast hint if it was counted to have at most ``most`` rows, else as it is."""
    most = BROADCAST_ROWS if most is None else min(most, BROADCAST_ROWS)
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def bitmap(df: DataFrame, hash: str, bits: int = 24) -> np.ndarray:
    """A Bloom filter of one bit per hash, 2**bits bits however many rows: 2 MB to the driver, unless ``bits`` says otherwise.

    It only spares rows a shuffle: what passes is still joined exactly, and a
    full filter lets everything pass.
    """
    at = F.expr(f"cast({hash} & {(1 << bits) - 1} as bigint)")
    words = df.select((at / 64).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast({hash} & 63 as int))").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bit")).toPandas()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found["word"].to_numpy(dtype=np.int64)] = found["bit"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def in_bitmap(found: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes.view(np.uint64) & np.uint64(len(found) * 64 - 1)
    return (found[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
