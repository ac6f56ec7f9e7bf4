"""CSV feeds whose fields hold line breaks, read by as many tasks as the files have splits."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.sources.schemas import all_strings
from caseloom.sources.tables import row_hash

#: what a row of ``_pieces`` is: a whole record, what ends one begun in an earlier split, what begins one, or neither end
WHOLE, HEAD, TAIL, MIDDLE = "whole", "head", "tail", "middle"
_PIECES = "source_file string, start long, at long, kind string, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, start, value): every line under the split that it begins in, in order within a split."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _splits_within_quotes(lines: DataFrame) -> set[tuple[str, int]]:
    """The splits that begin inside a quoted field: an odd number of quotes stands before them in their file.

    A doubled quote counts twice, so it changes nothing. To the driver go only
    such splits, one pair for many megabytes of input at the most.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    sums = lines.groupBy("source_file", "start").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("source_file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = sums.withColumn("inside", F.coalesce(F.sum("odd").over(before) % 2, F.lit(0))).where("inside = 1")
    return {(r["source_file"], r["start"]) for r in inside.select("source_file", "start").collect()}


def _pieces(lines: DataFrame, inside: set[tuple[str, int]]) -> DataFrame:
    """The records of each split in order, and the pieces of those that lie in several splits."""

    def parts(file: str, start: int, at: int, values: pa.Array, held: list[str], odd: int) -> tuple[pa.RecordBatch, list[str], int]:
        """The records that end in ``values``; ``held`` are the lines of one not ended, ``odd`` whether a quote is open."""
        quotes = np.asarray(pc.count_substring(values, '"'), dtype=np.int64)
        ends = (np.cumsum(quotes) + odd) % 2 == 0
        stops = np.flatnonzero(ends)
        rest = values.slice(int(stops[-1]) + 1 if len(stops) else 0).to_pylist()
        if not len(stops):
            return None, held + rest, 1
        first = np.concatenate([[0], stops[:-1] + 1])
        if (first == stops).all() and not held:
            records = values.take(pa.array(stops))
        else:
            texts = values.to_pylist()
            joined = ["\n".join(texts[a : b + 1]) for a, b in zip(first.tolist(), stops.tolist(), strict=True)]
            joined[0] = "\n".join([*held, joined[0]])
            records = pa.array(joined, pa.string())
        n = len(stops)
        columns = [pa.array([file] * n), pa.array([start] * n, pa.int64()), pa.array(np.arange(at, at + n)), pa.array([WHOLE] * n), records]
        return pa.RecordBatch.from_arrays(columns, ["source_file", "start", "at", "kind", "record"]), rest, int(len(rest) > 0)

    def one(file: str, start: int, at: int, kind: str, record: str) -> pa.RecordBatch:
        columns = [[file], [start], [at], [kind], [record]]
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["source_file", "start", "at", "kind", "record"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, held, odd, at, begun = None, [], 0, 0, False

        def close() -> Iterator[pa.RecordBatch]:
            """What is left of the last split's lines begins a record, or goes through the whole split."""
            if split is not None and held:
                yield one(*split, at, TAIL if begun else MIDDLE, "\n".join(held))

        for batch in batches:
            file, start = batch.column("source_file"), np.asarray(batch.column("start"), dtype=np.int64)
            codes = np.asarray(pc.dictionary_encode(file).indices, dtype=np.int64)
            bounds = np.flatnonzero((np.diff(codes) != 0) | (np.diff(start) != 0)) + 1
            for a, b in zip([0, *bounds.tolist()], [*bounds.tolist(), batch.num_rows], strict=True):
                if a == b:
                    continue
                if split != (here := (file[a].as_py(), int(start[a]))):
                    yield from close()
                    split, held, at = here, [], 0
                    odd = int(here in inside)
                    begun = not odd
                out, held, odd = parts(*split, at, batch.column("value").slice(a, b - a), held, odd)
                if out is not None:
                    if not begun:  # the first of them began in an earlier split
                        yield one(*split, at, HEAD, out.column("record")[0].as_py())
                        out, begun, at = out.slice(1), True, at + 1
                    at += out.num_rows
                    yield out
        yield from close()

    return lines.mapInArrow(scan, _PIECES)


def _stitched(pieces: DataFrame) -> DataFrame:
    """(source_file, start, at, record) of the records that lie in several splits; a window sees three pieces a split at most."""
    parts = pieces.where(F.col("kind") != WHOLE)
    line = Window.partitionBy("source_file").orderBy("start", "at")
    begun = parts.withColumn("_n", F.sum((F.col("kind") == TAIL).cast("int")).over(line.rowsBetween(Window.unboundedPreceding, 0)))
    in_order = F.array_sort(F.collect_list(F.struct("start", "at", "record")))
    whole = begun.groupBy("source_file", "_n").agg(in_order.alias("_parts"))
    return whole.select("source_file", F.col("_parts")[0]["start"].alias("start"), F.col("_parts")[0]["at"].alias("at"), F.array_join("_parts.record", "\n").alias("record"))


def read_feed(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """As ``tables.read_raw``: header CSV with every field as text, and ingest columns; but one file is many tasks' work.

    Lines are read by split. The number of quotes before a split tells whether
    it begins inside a quoted field; then each task puts its lines together to
    records, and only pieces of records that lie over the end of a split are
    shuffled. The files are read twice and must not change meanwhile. The first
    record of each file is its header; blank lines are left out, a quote is
    doubled inside a quoted field, an unclosed one runs to the end of the file.
    In a record that CR LF ends, CR LF inside a field is read as LF.
    """
    lines = _lines(spark, path)
    pieces = _pieces(lines, _splits_within_quotes(lines))
    records = pieces.where(F.col("kind") == WHOLE).drop("kind").unionByName(_stitched(pieces))
    ended = F.col("record").endswith("\r")  # the break that ends a record is the kind that its fields hold
    text = F.when(ended, F.replace(F.expr("left(record, length(record) - 1)"), F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record"))
    kept = records.where(~((F.col("start") == 0) & (F.col("at") == 0))).withColumn("record", text).where(F.trim("record") != "")
    schema = all_strings(columns)
    parsed = F.from_csv("record", F.lit(", ".join(f"`{f.name}` STRING" for f in schema.fields)), {"escape": '"', "multiLine": "true"})
    return kept.select("source_file", parsed.alias("_r")).select(
        *[F.col(f"_r.`{f.name}`").alias(f.name) for f in schema.fields],
        F.current_timestamp().alias("ingested_at"),
        "source_file",
    ).select(*columns, "ingested_at", "source_file", row_hash(columns).alias("record_hash"))
