"""Near-duplicate documents by ProbMinHash signatures over weighted word shingles.

The weight of a shingle is how often it occurs in the text. The similarity of
two texts is their probability Jaccard: the chance that both signatures keep the
same shingle in a register. It does not change with the scale of the weights and
equals the Jaccard of the shingle sets where all weights are equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm import words
from caseloom.llm.links import components
from caseloom.llm.shared import beside, packed, pieces, saved, small_side, table, text_key

THRESHOLD = 0.8
#: 32 bands of 8 registers miss a pair of similarity 0.8 with chance 0.0028, one of 0.85 with 0.00002; one of 0.5 shares a band with chance 0.12
BANDS, ROWS = 32, 8
#: registers that are kept to estimate a candidate's similarity
COMPARED = 64
#: members of a bucket, chosen by hash, that all others of it are compared with first
HUBS = 4
#: members of a bucket that one task compares with as many others
BLOCK = 1024
#: bytes of shingle lists on each of the two sides that one task compares; a longer list is a side of its own
BLOCK_BYTES = 64 << 20
_STEP = np.uint64(0xD1342543DE82EF95)


def signatures(row: np.ndarray, hashes: np.ndarray, weights: np.ndarray, rows: int, registers: int) -> np.ndarray:
    """ProbMinHash: rows x registers of the low 32 bits of the shingle that arrived first there.

    Each shingle sends arrivals, a Poisson process with its weight as rate, each
    to a register drawn at random; a register keeps the earliest. Both come from
    the shingle's hash alone, so equal shingles of different texts send alike.
    A shingle stops as soon as its next arrival is later than the latest
    register of its text, so a text costs about its shingles plus
    registers x ln(registers) arrivals. Rows without shingles stay at the top value.
    """
    kept = np.full(rows * registers, np.iinfo(np.uint64).max, np.uint64)
    state, time = words.mix(hashes), np.zeros(len(hashes))
    low, rate, of = state & np.uint64(0xFFFFFFFF), weights.astype(float), row
    while len(of):
        state = words.mix(state + _STEP)
        time = time - np.log(((state >> np.uint64(11)).astype(float) + 0.5) / 2.0**53) / rate
        slot = (words.mix(state ^ _STEP) % np.uint64(registers)).astype(np.int64)
        packed = (time.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | low
        np.minimum.at(kept, of * registers + slot, packed)
        active, place = np.unique(of, return_inverse=True)
        latest = kept.reshape(rows, registers)[active].max(axis=1) >> np.uint64(32)
        more = (packed >> np.uint64(32)) <= latest[place]
        state, time, low, rate, of = state[more], time[more], low[more], rate[more], of[more]
    return (kept & np.uint64(0xFFFFFFFF)).reshape(rows, registers)


def signed(texts: pa.Array, bands: int = BANDS, rows: int = ROWS, shingle: int = words.SHINGLE):
    """For each text its registers, the hash of each band of them, and whether it has words at all."""
    row, hashes = words.shingles(texts, shingle)
    kept = signatures(*words.weighted(row, hashes, len(texts)), len(texts), bands * rows)
    total = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(texts), bands))
    for j in range(rows):
        total = words.mix(total * _STEP + kept.reshape(len(texts), bands, rows)[:, :, j])
    return kept.astype(np.uint32), total.view(np.int64), np.bincount(row, minlength=len(texts)) > 0


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard of two (sorted hashes, weights).

    The sum over common shingles d of 1 / sum over all e of max(a_e / a_d, b_e / b_d).
    Shingles in order of a_e / b_e make the inner sum a suffix of a and a prefix of b.
    """
    if not len(a[0]) or not len(b[0]):
        return 0.0
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    wa, wb = a[1][i].astype(float), b[1][j].astype(float)
    order = np.argsort(wa / wb, kind="stable")
    wa, wb = wa[order], wb[order]
    only_a, only_b = a[1].sum() - wa.sum(), b[1].sum() - wb.sum()
    after = only_a + np.cumsum(wa[::-1])[::-1]
    before = only_b + np.cumsum(wb) - wb
    return float((1.0 / (after / wa + before / wb)).sum())


def features(texts: DataFrame, shingle: int) -> DataFrame:
    """(key, hashes, weights) of (key, text): the distinct shingle hashes, sorted, and their weights; none if all are 1."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            row, h, w = words.weighted(*words.shingles(piece.column("text"), shingle), piece.num_rows)
            ends = np.cumsum(np.bincount(row, minlength=piece.num_rows)).tolist()
            cut = [slice(a, b) for a, b in zip([0, *ends], ends, strict=False)]
            hashes = [h[c].tobytes() for c in cut]
            weights = [b"" if (w[c] == 1).all() else w[c].astype(np.uint32).tobytes() for c in cut]
            columns = [piece.column("key"), pa.array(hashes, pa.binary()), pa.array(weights, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "hashes", "weights"])

    return texts.mapInArrow(extract, "key binary, hashes binary, weights binary")


def unpacked(hashes: bytes, weights: bytes) -> tuple[np.ndarray, np.ndarray]:
    h = np.frombuffer(hashes, np.uint64)
    return h, np.frombuffer(weights, np.uint32) if weights else np.ones(len(h), np.uint32)


def estimated(pairs: DataFrame, registers: DataFrame, threshold: float, count: int) -> DataFrame:
    """The pairs whose registers agree often enough that they may reach the threshold.

    The share of equal registers estimates the similarity. The bar lies five
    standard deviations below the threshold, a chance of 3e-7 to miss a pair.
    """
    least = threshold * count - 5 * (count * threshold * (1 - threshold)) ** 0.5

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(-1, count) for i in (2, 3))
            yield batch.select([0, 1]).filter(pa.array((a == b).sum(axis=1) >= least))

    left, right = registers.toDF("a", "of_a"), registers.toDF("b", "of_b")
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "of_a", "of_b")
    return joined.mapInArrow(check, "a binary, b binary")


def verified(pairs: DataFrame, shingled: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of class keys that reach the threshold exactly; ``shingled`` is of ``features``."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True)
            found = [probability_jaccard(unpacked(ha, wa), unpacked(hb, wb)) for ha, wa, hb, wb in sides]
            yield batch.select([0, 1]).filter(pa.array(np.array(found) >= threshold - 1e-12))

    left, right = shingled.toDF("a", "ha", "wa"), shingled.toDF("b", "hb", "wb")
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "ha", "wa", "hb", "wb")
    return joined.mapInArrow(check, "a binary, b binary")


def crossing(
    members: DataFrame, shingled: DataFrame, bands: DataFrame, threshold: float, block: int = BLOCK, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The pairs (a, b) of different components that share a bucket and reach the threshold.

    ``members`` has h, key, root and n, the bucket's size. A bucket is dealt out
    by hash in blocks of some ``block`` rows or ``block_bytes`` of shingle lists,
    whichever is less, and each two blocks are compared in one task, which
    returns only the links it finds. A pair is compared in the first bucket that
    it shares and not once it is connected.
    """

    def compare(rows: pa.Table) -> pa.Table:
        keys, roots = rows["key"].to_pylist(), rows["root"].to_pylist()
        values = rows["bands"].combine_chunks()
        values = values.values.to_numpy().reshape(len(rows), -1)
        found = [unpacked(h, w) for h, w in zip(rows["hashes"].to_pylist(), rows["weights"].to_pylist(), strict=True)]
        side, (h, low, high) = np.asarray(rows["part"]), (rows[c][0].as_py() for c in ("h", "low", "high"))
        parent: dict[bytes, bytes] = {}

        def find(r: bytes) -> bytes:
            while (up := parent.get(r, r)) != r:
                parent[r] = parent.get(up, up)
                r = up
            return r

        a, b = [], []
        others = np.flatnonzero(side == high)
        for i in np.flatnonzero(side == low).tolist():
            rest = others[others > i] if low == high else others
            shared = values[rest] == values[i]
            for j in rest[values[i][shared.argmax(axis=1)] == h].tolist():
                x, y = find(roots[i]), find(roots[j])
                if x != y and probability_jaccard(found[i], found[j]) >= threshold - 1e-12:
                    parent[x] = y
                    a.append(keys[i])
                    b.append(keys[j])
        return pa.table([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    sizes = shingled.select("key", (F.octet_length("hashes") + F.octet_length("weights")).alias("bytes"))
    members = members.join(small_side(sizes), "key")
    whole_bytes = members.groupBy("h").agg(F.sum("bytes").alias("bytes"))
    members = members.drop("bytes").join(whole_bytes, "h")
    parts = F.ceil(F.greatest(F.col("n") / block, F.col("bytes") / block_bytes)).cast("int")
    mine = F.pmod(F.xxhash64("key"), parts).cast("int")
    others = F.explode(F.sequence(F.lit(0), parts - 1))
    placed = members.select("h", "key", "root", mine.alias("part"), others.alias("other"))
    placed = placed.select("h", "key", "root", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))
    whole = shingled.join(bands, "key")
    return placed.join(whole, "key").groupBy("h", "low", "high").applyInArrow(compare, "a binary, b binary")


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    shingle: int = words.SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``docs``: id, text_key, class_id, group_key, group_id, kept.

    class_id is the smallest id among rows of the very same text, group_id the
    smallest among all rows linked, directly or through others, by a similarity
    of ``threshold`` or more; kept marks rows whose id is group_id and whose
    text is the group's (rows that repeat both, id and text, are all marked).

    Candidates share a band. Texts are first folded to classes of equal texts.
    In each bucket every class is compared with a few hubs, which settles a
    group of copies in a few pairs per member. Then ``crossing`` compares all
    members of a bucket that are not yet in one component. So no bucket is
    capped and no link between different texts is lost; a bucket's pairs are
    never built as rows.

    Null and empty texts and texts without words link with nothing but the very
    same text. Null ids take part; a null is id of a class only if all its ids
    are null. Extra columns are ignored; an empty table gives an empty result.
    """
    keyed = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), text_key(text).alias("key"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            kept, values, worded = signed(piece.column("text"), bands, rows, shingle)
            lists = pa.ListArray.from_arrays(np.arange(len(values) + 1, dtype=np.int32) * bands, values.ravel())
            registers = pa.array([r[:COMPARED].tobytes() for r in kept], pa.binary())
            columns = [piece.column("id").cast(pa.int64()), piece.column("key"), pa.array(worded), registers, lists]
            yield pa.RecordBatch.from_arrays(columns, ["id", "key", "worded", "registers", "bands"])

    rows_signed = keyed.mapInArrow(sign, "id long, key binary, worded boolean, registers binary, bands array<long>")
    classes = saved(
        rows_signed.groupBy("key").agg(
            F.min("id").alias("class_id"), *[F.first(c).alias(c) for c in ("worded", "registers", "bands")]
        )
    )

    def shingled(keys: DataFrame) -> DataFrame:
        owner = saved(keys.join(classes.select("key", F.col("class_id").alias("_id")), "key"))
        texts = keyed.join(small_side(owner), "key").where(F.col("id").eqNullSafe(F.col("_id"))).dropDuplicates(["key"])
        return saved(features(texts.select("key", "text"), shingle))

    entries = classes.where("worded").select("key", F.explode("bands").alias("h"))
    shared = entries.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    members = packed(entries.join(shared, "h"))

    ordered = lambda c: F.struct(F.least(*c).alias("a"), F.greatest(*c).alias("b"))
    hubs = members.groupBy("h").agg(*[F.min_by("key", F.xxhash64("key", F.lit(i))).alias(f"hub{i}") for i in range(HUBS)])
    hubs = hubs.select("h", F.explode(F.array_distinct(F.array(*[f"hub{i}" for i in range(HUBS)]))).alias("hub"))
    stars = members.join(hubs, "h").where("key <> hub").select(ordered(["key", "hub"]).alias("p")).select("p.*")
    likely = packed(estimated(stars.distinct(), classes.select("key", "registers"), threshold, min(COMPARED, bands * rows)))
    ends = likely.select(F.col("a").alias("key")).union(likely.select("b")).distinct()
    first = packed(verified(likely, shingled(ends), threshold))
    roots = components(first).withColumnsRenamed({"node": "key"})

    placed = members.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    mixed = placed.groupBy("h").agg(F.count(F.lit(1)).alias("n"), (F.min("root") != F.max("root")).alias("open")).where("open")
    open_ = packed(placed.join(mixed.drop("open"), "h"))
    second = packed(crossing(open_, shingled(open_.select("key").distinct()), classes.select("key", "bands"), threshold))
    groups = components(first.unionByName(second)).withColumnsRenamed({"node": "key", "root": "group_key"})

    grouped = saved(
        classes.select("key", "class_id").join(groups, "key", "left").withColumn("group_key", F.coalesce("group_key", "key"))
    )
    heads = grouped.groupBy("group_key").agg(
        F.min("class_id").alias("group_id"),
        F.min_by("key", F.struct(F.col("class_id").isNull(), "class_id", "key")).alias("head"),
    )
    of_class = grouped.join(heads, "group_key")
    return (
        keyed.select("id", "key")
        .join(of_class, "key")
        .select(
            F.col("id").alias(id),
            F.col("key").alias("text_key"),
            "class_id",
            "group_key",
            "group_id",
            (F.col("id").eqNullSafe(F.col("group_id")) & (F.col("key") == F.col("head"))).alias("kept"),
        )
    )


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, one of each group, with all columns."""
    id = options.get("id", "doc_id")
    on = {"_id": F.coalesce(F.col(id), F.lit(0)), "_no_id": F.col(id).isNull()}
    kept = near_duplicates(docs, **options).where("kept")
    kept = kept.select(*[c.alias(n) for n, c in on.items()], F.col("text_key").alias("_key")).distinct()
    marked = beside(docs, **on, _key=text_key(options.get("text", "text")))
    return marked.join(kept, [*on, "_key"]).dropDuplicates([*on, "_key"]).select("row.*")


def op7_near_duplicates(spark, folder: str) -> DataFrame:
    """Every document with its class of equal texts and its group of near copies."""
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "class_id", F.col("group_id").alias("component_id"), "kept")
