"""Periodic run detection: Lyndon arrays by Baier's grouping, Lyndon roots extended through LCE into runs.

A run is a stretch of words with smallest period q that no neighbouring word
extends. Each run of two or more periods holds, under one of the two orders of
the alphabet, a position whose longest Lyndon word has length q. Both Lyndon
arrays come directly out of the first phase of Baier's suffix sorter; each
root (i, q) is extended to both sides by longest common extensions at i and
i + q, which are looked up in names of blocks of 1, 2, 4 ... words.

Words that are too rare to lie in a run part a text; only what is left between
them, where runs can be, goes through the grouping.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.llm.shared import pieces, table

#: a run has at least so many words, and so many times its period
SHORTEST, PERIODS = 6, 4
#: bytes of text that a worker holds as words at a time
BATCH_BYTES = 2 << 20
#: how often rare words are looked for anew in what is left; what then stays is only more work
ROUNDS = 12


def stretches(of: np.ndarray, codes: np.ndarray, shortest: int = SHORTEST, periods: int = PERIODS) -> np.ndarray:
    """Positions, ascending, that may lie in a run of words of one text; ``of`` is the text of each word, ascending.

    A run holds each of its words at least ``periods`` times, so a word that is
    rarer between two parting words parts the text as well. No run is lost or
    cut, for all of its words stay.
    """
    at, part = np.arange(len(codes)), of
    for _ in range(ROUNDS):
        _, word, count = np.unique(part * (codes.max(initial=0) + 1) + codes[at], return_inverse=True, return_counts=True)
        keep = count[word] >= periods
        at, part = at[keep], part[keep]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (np.diff(part) != 0)
        part = np.cumsum(new) - 1
        long = np.bincount(part, minlength=1)[part] >= shortest if len(at) else np.zeros(0, bool)
        if keep.all() and long.all():
            break
        at, part = at[long], part[long]
    return at


def lyndon_lengths(codes: np.ndarray) -> np.ndarray:
    """The length of the longest Lyndon word that starts at each position; 0 in ``codes`` parts texts and starts none.

    Phase one of Baier's suffix sorter. Groups, at first one per letter, are
    taken from the greatest down. The positions of a group leave the list of
    those that remain; the nearest that remains to the left of one is its
    previous smaller one. Positions that are so for the same number of a group's
    members, and come from one group, form a new group just above it whose
    common prefix is longer by so many times the prefix of the group taken.
    When a group is taken, its prefix is the longest Lyndon word of its members.
    The first and the last code must be 0.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    order = order[np.searchsorted(codes[order], 1) :]
    bounds = np.flatnonzero(np.diff(codes[order], prepend=0))
    members: list[list[int]] = [x.tolist() for x in np.split(order, bounds[1:])] if len(order) else []
    group_of = np.full(n, -1)
    group_of[order] = np.repeat(np.arange(len(members)), [len(x) for x in members])
    group: list[int] = group_of.tolist()
    length = [1] * len(members)
    below, above = list(range(-1, len(members) - 1)), [*range(1, len(members)), -1]
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    out = [0] * n
    g = len(members) - 1
    while g >= 0:
        size = length[g]
        smaller: dict[int, int] = {}
        for i in members[g]:
            if group[i] == g:
                out[i] = size
                p, r = left[i], right[i]
                right[p], left[r] = r, p
                if group[p] >= 0:
                    smaller[p] = smaller.get(p, 0) + 1
        members[g] = []
        if len(smaller) == 1:
            moved = {(m, group[p]): [p] for p, m in smaller.items()}
        else:
            moved = {}
            for p, m in smaller.items():
                moved.setdefault((m, group[p]), []).append(p)
        for (m, old), some in sorted(moved.items(), reverse=True) if len(moved) > 1 else moved.items():
            new, up = len(members), above[old]
            members.append(some)
            length.append(length[old] + m * size)
            below.append(old)
            above.append(up)
            above[old] = new
            below[up] = new  # ``old`` is lower than the group taken, so there is one above it
            for p in some:
                group[p] = new
        g = below[g]
    return np.array(out, np.int64)


class Extensions:
    """Longest common extensions of two positions of ``codes``, never over a 0, by exact names of blocks."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        walls = np.flatnonzero(codes == 0)
        room = walls[np.searchsorted(walls, np.arange(n))] - np.arange(n)
        self.names = [np.where(codes > 0, codes, -1).astype(np.int32)]
        while (step := 1 << len(self.names)) <= room.max(initial=0):
            fits, last = np.flatnonzero(room >= step), self.names[-1].astype(np.int64)
            _, name = np.unique(last[fits] * n + last[fits + step // 2], return_inverse=True)
            level = np.full(n, -1, np.int32)
            level[fits] = name
            self.names.append(level)

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i and from j on are the same."""
        at = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            name = np.append(self.names[k], -1)
            a = name[np.minimum(i + at, len(name) - 1)]
            at += ((a >= 0) & (a == name[np.minimum(j + at, len(name) - 1)])).astype(np.int64) << k
        return at

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i and before j are the same."""
        at = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            a, b = i - at - (1 << k), j - at - (1 << k)
            name = self.names[k][np.maximum(a, 0)]
            at += ((a >= 0) & (b >= 0) & (name >= 0) & (name == self.names[k][np.maximum(b, 0)])).astype(np.int64) << k
        return at


def runs_between(codes: np.ndarray, shortest: int = SHORTEST, periods: int = PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run of ``codes``, by start and period; 0 parts texts and stands at both ends."""
    roots = []
    for key in (codes, np.where(codes > 0, codes.max(initial=0) + 1 - codes, 0)):
        lengths = lyndon_lengths(key)
        i = np.flatnonzero(lengths)
        j = i + lengths[i]
        i, j = i[codes[i] == codes[j]], j[codes[i] == codes[j]]
        roots.append(i * len(codes) + j)
    i, j = np.divmod(np.unique(np.concatenate(roots)), max(1, len(codes)))
    both = Extensions(codes)
    start = i - both.left(i, j)
    length, period = j + both.right(i, j) - start, j - i
    run = (length >= shortest) & (length >= periods * period)
    _, first = np.unique(start[run] * len(codes) + period[run], return_index=True)
    return start[run][first], length[run][first], period[run][first]


def runs_of_texts(of: np.ndarray, codes: np.ndarray, shortest: int = SHORTEST, periods: int = PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run within a text, start being a place in ``codes``; codes are from 0 on."""
    at = stretches(of, codes, shortest, periods)
    if not len(at):
        return at, at, at
    apart = np.flatnonzero((np.diff(at) != 1) | (np.diff(of[at]) != 0)) + 1
    where = np.insert(at, apart, -1)
    walled = np.concatenate([[0], np.where(where >= 0, codes[np.maximum(where, 0)] + 1, 0), [0]])
    start, length, period = runs_between(walled, shortest, periods)
    return where[start - 1], length, period


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The words of all texts in order, and the text that each is of; a null text has none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, of = pc.list_flatten(lists), pc.list_parent_indices(lists)
    some = pc.greater(pc.binary_length(words), 0)  # white space at an end leaves an empty one
    return np.asarray(of.filter(some), dtype=np.int64), words.filter(some)


_RUN = ("start", "length", "period")
_RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in _RUN]))


def _batch(texts: pa.Array, shortest: int, periods: int) -> list[pa.Array]:
    """The runs of each text, and its words joined without those that a run repeats."""
    of, words = words_of(texts)
    codes = np.asarray(pc.dictionary_encode(words).indices, dtype=np.int64)
    start, length, period = runs_of_texts(of, codes, shortest, periods)
    many = np.bincount(of, minlength=len(texts))
    first = np.cumsum(many) - many
    run_of = of[start] if len(start) else start
    repeated = np.zeros(len(codes) + 1, np.int64)
    np.add.at(repeated, start + period, 1)
    np.add.at(repeated, start + length, -1)
    keep = np.cumsum(repeated[:-1]) == 0
    offsets = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
    spans = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start - first[run_of], length, period)], list(_RUN))
    runs = pa.ListArray.from_arrays(offsets(np.bincount(run_of, minlength=len(texts))), spans)
    kept = pa.ListArray.from_arrays(offsets(np.bincount(of[keep], minlength=len(texts))), words.filter(pa.array(keep)))
    return [runs, pc.binary_join(kept, " ")]


def periodic_runs(docs: DataFrame, text: str = "text", shortest: int = SHORTEST, periods: int = PERIODS) -> DataFrame:
    """One row per row of ``docs``: (row, runs, collapsed).

    ``row`` is the row without its text, so no column of ``docs`` clashes;
    ``runs`` has (start, length, period) of every run of the words
    ``[^\\x20\\x09-\\x0D]+`` of the whole text by start and period, words being
    numbered from 0, a run having at least ``shortest`` words and ``periods``
    (2 or more) times its period; ``collapsed`` is the text's words, joined by
    one space, without those that any run holds after its first period. A null
    or empty text has no run and an empty ``collapsed``; repeated rows and null
    ids are rows like others. A text is worked on in one task, some 200 bytes
    per word of what its rare words leave.
    """
    if periods < 2:
        raise ValueError("a run has two periods at least")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", BATCH_BYTES):
            yield pa.RecordBatch.from_arrays([piece.column("row"), *_batch(piece.column("text"), shortest, periods)], ["row", "runs", "collapsed"])

    others = [f"`{c}`" for c in docs.columns if c != text]
    row = F.struct(*others) if others else F.struct(F.lit(True).alias("none"))
    narrow = docs.select(row.alias("row"), F.col(text).cast("string").alias("text"))
    kind = T.StructType([narrow.schema["row"], T.StructField("runs", _RUNS), T.StructField("collapsed", T.StringType())])
    return narrow.mapInArrow(find, kind)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def looped(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text): a tenth of the documents, by crc32 of their id, made periodic from some word on, the rest as they are.

    With h = crc32(id), g = floor(h / 10) and n words, word i >= a = g % n
    becomes word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)). A null id
    has no crc32, so its text stays as it is.
    """
    h = F.crc32(F.col(id).cast("string").cast("binary"))
    out = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"), h.alias("h"))
    w, g, n = F.col("w"), F.floor(F.col("h") / 10), F.size("w").cast("long")
    a = F.col("a")
    p = 1 + F.floor((n - a) / (3 + g % 8))
    place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % F.col("p"))
    chosen = F.when(F.col("h") % 10 == 0, _words(F.col("text")))  # null for the others, which Spark does not split
    placed = out.withColumn("w", chosen).withColumn("a", F.when(n > 0, g % n)).withColumn("p", p)
    again = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.element_at(w, (place(i) + 1).cast("int"))), " ")
    return placed.select("id", F.when(a.isNotNull(), again).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark, folder: str) -> DataFrame:
    """The runs of every document, a tenth of them made periodic, as counts, the longest, and digests."""
    found = periodic_runs(looped(table(spark, folder, "documents")))
    least = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("size"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    text = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.withColumn("best", least).select(
        F.col("row.id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.size")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("-best.size * 1000 div best.period").alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
