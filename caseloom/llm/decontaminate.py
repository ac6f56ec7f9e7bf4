"""Benchmark decontamination: which short test items stand, nearly whole, inside which documents.

Containment of an item in a document is the share of the item's distinct
five-word shingles that the document has. The search is by MinHash sketches,
partitioned by size. An item of n shingles may miss n - ceil(t n) of them at a
containment of t, so its sketch is its n - ceil(t n) + 1 lowest shingle hashes:
a document that contains the item must share one of them, whatever the length
of the document. Items fall in size partitions by powers of two. A partition has
a cut-off, its highest sketch hash, and a filter of its sketch hashes; a
document sends a hash only if some partition whose items could fit in it takes
it by both. Candidates are then verified by counting shingles exactly, those of
one text together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm import words
from caseloom.llm.shared import beside, bitmap, in_bitmap, pieces, saved, small_side, table, text_key

THRESHOLD = 0.8
#: candidates that are verified with one copy of a text
LISTED = 1000


def _lists(row: np.ndarray, values: np.ndarray, rows: int) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, values.view(np.int64))


def item_sketches(items: DataFrame, id: str, text: str, threshold: float, shingle: int) -> DataFrame:
    """Per distinct item text with words: key, n, size_class, all its hashes and its sketch (lowest first)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            rows = piece.num_rows
            row, hashes, _ = words.weighted(*words.shingles(piece.column("text"), shingle), rows)
            n = np.bincount(row, minlength=rows)
            least = np.ceil(threshold * n - 1e-9).astype(np.int64)
            rank = np.arange(len(row)) - (np.cumsum(n) - n)[row]
            low = rank < (n - least + 1)[row]
            size = np.floor(np.log2(np.maximum(n, 1))).astype(np.int32)
            columns = [piece.column("key"), pa.array(n), pa.array(size), pa.array(least)]
            columns += [_lists(row, hashes, rows), _lists(row[low], hashes[low], rows)]
            out = pa.RecordBatch.from_arrays(columns, ["key", "n", "size_class", "least", "hashes", "sketch"])
            yield out.filter(pa.array(n > 0))

    texts = items.select(text_key(text).alias("key"), F.col(text).alias("text")).dropDuplicates(["key"])
    return texts.mapInArrow(sketch, "key binary, n long, size_class int, least long, hashes array<long>, sketch array<long>")


def size_partitions(sketches: DataFrame, threshold: float) -> list[tuple[int, np.uint64, np.ndarray]]:
    """For each size partition: shingles that a document must have to hold an item of it, its cut-off, and its filter.

    A filter has some sixteen bits a sketch hash, 16 MB at most; beyond that it
    lets more pass, which is still joined exactly. There are as many partitions
    as an item's size has bits.
    """
    # hashes are unsigned, so their order as signed numbers is shifted by 2**63
    cuts = sketches.groupBy("size_class").agg(F.max(F.expr("h ^ (-9223372036854775807L - 1L)")).alias("cut"), F.count(F.lit(1)).alias("n"))
    out = []
    for r in sorted(cuts.collect(), key=lambda r: r["size_class"]):
        bits = min(max(math.ceil(math.log2(16 * r["n"])), 10), 27)
        found = bitmap(sketches.where(F.col("size_class") == r["size_class"]), "h", bits)
        out.append((math.ceil(threshold * 2 ** r["size_class"] - 1e-9), np.uint64(r["cut"] + 2**63), found))
    return out


def taken(takes: list[tuple[int, np.uint64, np.ndarray]], sizes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes, of documents of ``sizes`` shingles, some partition takes."""
    sent = np.zeros(len(hashes), bool)
    for least, cut, found in takes:
        here = np.flatnonzero((sizes >= least) & (hashes <= cut) & ~sent)
        sent[here] = in_bitmap(found, hashes[here])
    return sent


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    shingle: int = words.SHINGLE,
) -> DataFrame:
    """(text_key, item_id, n_shared, n_item) for each distinct document text and each item it contains.

    Items and texts without words are contained in nothing and contain nothing;
    an item of fewer words than a shingle matches only a text of those very
    words. Null ids are values like others. Repeated rows give one result row.
    """
    sketched = saved(item_sketches(items, item_id, item_text, threshold, shingle))
    sketches = sketched.select(F.col("key").alias("item"), "size_class", F.explode("sketch").alias("h"))
    takes = size_partitions(sketches, threshold)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            row, hashes = words.shingles(piece.column("text"), shingle)
            n = np.bincount(row, minlength=piece.num_rows)  # at least the number of distinct ones
            sent = taken(takes, n[row], hashes)
            keys = piece.column("key").take(pa.array(row[sent]))
            yield pa.RecordBatch.from_arrays([keys, pa.array(hashes[sent].view(np.int64))], ["key", "h"])

    keyed = docs.select(text_key(text).alias("key"), F.col(text).alias("text"))
    sent = keyed.mapInArrow(probe, "key binary, h long")
    pairs = saved(sent.join(small_side(saved(sketches.select("h", "item"))), "h").select("key", "item").distinct())
    wanted = saved(pairs.select("key").distinct())
    texts = keyed.join(small_side(wanted), "key").dropDuplicates(["key"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, content, items_ in zip(*(batch.column(c) for c in ("key", "text", "items")), strict=True):
                have = np.unique(words.shingles(pa.array([content.as_py()], pa.string()), shingle)[1])
                some = items_.values
                lists = some.field("hashes")
                hashes, ends = lists.flatten().to_numpy().view(np.uint64), np.cumsum(np.asarray(pc.list_value_length(lists), dtype=np.int64))
                upto = np.concatenate([[0], np.cumsum(np.isin(hashes, have))])
                shared = np.diff(upto[np.concatenate([[0], ends])])
                columns = [pa.array([key.as_py()] * len(some), pa.binary()), some.field("item"), some.field("n"), some.field("least"), pa.array(shared, pa.int64())]
                out = pa.RecordBatch.from_arrays(columns, ["key", "item", "n", "least", "n_shared"])
                yield out.filter(pc.greater_equal(out["n_shared"], out["least"]))

    full = sketched.select(F.col("key").alias("item"), "n", "least", "hashes")
    # a text comes once with up to some LISTED of its candidates, however many it has
    parts = pairs.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / LISTED).alias("_parts"))
    listed = pairs.join(parts, "key").join(small_side(full, 10_000), "item")
    listed = listed.groupBy("key", F.pmod(F.xxhash64("item"), F.col("_parts")).alias("_part"))
    listed = listed.agg(F.collect_list(F.struct("item", "n", "least", "hashes")).alias("items"))
    checked = (
        texts.join(listed, "key")
        .select("key", "text", "items")
        .mapInArrow(verify, "key binary, item binary, n long, least long, n_shared long")
    )
    ids = items.select(text_key(item_text).alias("item"), F.col(item_id).alias("item_id")).distinct()
    return checked.join(ids, "item").select(F.col("key").alias("text_key"), "item_id", "n_shared", F.col("n").alias("n_item"))


def contaminated(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: id, contaminated, n_items and items, the sorted ids of the items it contains.

    No items, no words or a null text: not contaminated, an empty list. Null
    item ids count in n_items but are not listed.
    """
    found = contained_items(docs, items, id=id, text=text, **options)
    per_text = found.groupBy("text_key").agg(
        F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_set("item_id")).alias("items")
    )
    rows = docs.select(F.col(id).alias(id), text_key(text).alias("text_key"))
    return rows.join(small_side(saved(per_text), 20_000), "text_key", "left").select(
        id,
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all columns."""
    bad = saved(contained_items(docs, items, text=text, **options).select(F.col("text_key").alias("_key")).distinct())
    return beside(docs, _key=text_key(text)).join(small_side(bad), "_key", "left_anti").select("row.*")


def op2_decontaminate(spark, folder: str) -> DataFrame:
    """Every document with the benchmark items it contains."""
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
