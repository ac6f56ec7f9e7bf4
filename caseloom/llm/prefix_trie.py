"""Conversation prefix trie: one node per distinct sequence of first turns, in minimal-perfect-hash tables by shard.

A conversation is the digests of its turns laid end to end, so bytes sort like
the trie walks. Conversations are dealt by ranges of that order, ids last, so
neither a first turn that many share nor many copies of one conversation make
one task large. Each range is a shard: its distinct prefixes get the slots of a
minimal perfect hash, every occurrence is verified against its slot, counts are
scattered into flat arrays, and subtree sums run through the array of parent
slots, the deepest first. Only nodes on the path of a shard's first or last
conversation can lie in another shard as well. They are merged by digest; what
both of two neighbouring shards counted, the common path at their border, is
taken off once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.shared import saved, small_side, table

#: turns of a shard, on average; with some 200 bytes a turn it bounds a task
SHARD_TURNS = 250_000
#: ids in one row of a list of conversations that end at a node
END_IDS = 8192
#: nodes in one batch out of a shard
NODES = 8192
_BYTES = 16
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def paths(turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", within: Column | None = None) -> DataFrame:
    """(id, path, words[, within]) with one row per non-null id.

    ``path`` has 16 bytes per turn, the md5 of role and text, ``words`` the
    number of words ``[^\\x20\\x09-\\x0D]+`` of each text. Turns stand in order
    of ``turn``, a null one first, and of their digest where it repeats; rows
    that repeat stay. A null role or text is empty; rows without an id belong to
    no conversation. Texts are not shuffled, rows meet by ``within``, a function
    of the id, or by id. A conversation is one row of some 20 bytes a turn.
    """
    said, who = F.coalesce(F.col(text).cast("string"), F.lit("")), F.coalesce(F.col(role).cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said).cast("binary"))
    narrow = turns.where(F.col(id).isNotNull()).select(
        (F.col(id) if within is None else within).alias("within"),
        F.col(id).alias("id"),
        F.struct(F.col(turn).alias("turn"), digest.alias("digest"), F.regexp_count(said, F.lit(r"[^\x20\x09-\x0D]+")).alias("words")).alias("said"),
    )
    met = narrow.repartition("within").groupBy("within", "id").agg(F.array_sort(F.collect_list("said")).alias("turns"))
    path = F.unhex(F.array_join(F.col("turns.digest"), "")).alias("path")
    return met.select("id", path, F.col("turns.words").alias("words"), *(["within"] if within is not None else []))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _seed(k: int) -> np.uint64:
    return np.uint64(k * int(_A) % (1 << 64))


class MinimalHash:
    """Slots 0..n-1 for n distinct 64-bit keys, one each, without the keys.

    Level by level, keys alone at their place of a bit array of twice their
    number take it, the others go on; a key's slot is the rank of its bit.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.uint64, np.ndarray, np.ndarray]] = []
        taken = 0
        while len(keys):
            seed = _seed(len(self.levels) + 1)
            at = self._places(keys, seed, 2 * len(keys))
            bits = np.bincount(at, minlength=2 * len(keys)) == 1
            self.levels.append((seed, bits, taken + np.cumsum(bits) - bits))
            taken += int(bits.sum())
            keys = keys[~bits[at]]
        self.size = taken

    @staticmethod
    def _places(keys: np.ndarray, seed: np.uint64, size: int) -> np.ndarray:
        return (_mix(keys + seed) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out, left = np.full(len(keys), -1), np.arange(len(keys))
        for seed, bits, rank in self.levels:
            at = self._places(keys[left], seed, len(bits))
            hit = bits[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return out


def prefix_digests(turns: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """128 bits for each prefix: row first + d - 1 stands for the first d of a conversation's ``turns`` (rows of two words)."""
    out = np.zeros_like(turns)
    longest = np.argsort(-lengths, kind="stable")
    active = np.searchsorted(-lengths[longest], -np.arange(1, lengths.max(initial=0) + 1), side="right")
    for d, n in enumerate(active.tolist()):
        at = first[longest[:n]] + d
        a, b = (out[at - 1, 0], out[at - 1, 1]) if d else (np.zeros(n, np.uint64), np.full(n, _C))
        s, t = turns[at, 0], turns[at, 1]
        out[at, 0] = _mix(_mix(a + s) + t * _A)
        out[at, 1] = _mix(_mix((b ^ t) + _B) + s * _C)
    return out


class Shard:
    """The trie of some conversations in flat arrays by slot; the root has the last slot."""

    def __init__(self, ids: np.ndarray, turns: np.ndarray, lengths: np.ndarray, words: np.ndarray):
        first = np.cumsum(lengths) - lengths
        self.digest = prefix_digests(turns, first, lengths)
        parent_row = np.arange(len(turns)) - 1
        parent_row[first[lengths > 0]] = -1
        for seed in range(64):
            keys = _mix(self.digest[:, 0] + _seed(seed)) + self.digest[:, 1]
            table = MinimalHash(np.unique(keys))
            slot, self.root = table.slots(keys), table.size
            row = np.zeros(self.root, np.int64)
            row[slot] = np.arange(len(slot))  # the row that a slot is checked against
            if (self.digest[row[slot]] == self.digest).all():
                break
        else:
            raise RuntimeError("no seed tells the prefixes apart")
        parent = np.where(parent_row >= 0, slot[parent_row], self.root)
        if (turns[row[slot]] != turns).any() or (parent[row[slot]] != parent).any():
            raise RuntimeError("two prefixes have one digest")
        depth_of_row = np.arange(len(turns)) - np.repeat(first, lengths) + 1
        self.slot_of_row, self.first, self.lengths = slot, first, lengths
        self.digest = np.concatenate([self.digest[row], np.zeros((1, 2), np.uint64)])
        self.parent = np.append(parent[row], -1)
        self.depth = np.append(depth_of_row[row], 0)
        self.words = np.append(words[row], 0).astype(np.int64)
        self.n_convs = np.append(np.bincount(slot, minlength=self.root), len(ids))
        self.conv_id = np.full(self.root + 1, np.iinfo(np.int64).max)
        np.minimum.at(self.conv_id, slot, np.repeat(ids, lengths))
        self.conv_id[-1] = ids.min()
        self.n_children = np.bincount(self.parent[:-1], minlength=self.root + 1)
        self.end = np.full(len(ids), self.root)
        self.end[lengths > 0] = slot[(first + lengths - 1)[lengths > 0]]
        self.n_leaves = (self.n_children == 0).astype(np.int64)
        self.said, self.distinct = self.n_convs * self.words, self.words.copy()
        by_depth = np.argsort(self.depth, kind="stable")
        bounds = np.searchsorted(self.depth[by_depth], np.arange(self.depth.max() + 2))
        for d in range(len(bounds) - 2, 0, -1):
            at = by_depth[bounds[d] : bounds[d + 1]]
            for sums in (self.n_leaves, self.said, self.distinct):
                np.add.at(sums, self.parent[at], sums[at])

    def path(self, k: int) -> np.ndarray:
        """The slots of conversation k, the root first."""
        return np.append(self.root, self.slot_of_row[self.first[k] : self.first[k] + self.lengths[k]])


_SUMS = ("n_convs", "n_children", "n_leaves", "said", "distinct")
_FIELDS = ["kind string", "part long", "hi long", "lo long", "depth long", "conv_id long", "parent_conv_id long", "parent_hi long", "parent_lo long"]
_FIELDS += [f"{n} long" for n in _SUMS] + ["words long", "on_first boolean", "on_last boolean", "last_depth long", "seq long", "ends array<bigint>"]
_NAMES = [f.split()[0] for f in _FIELDS]


def _rows(n: int, **columns: pa.Array) -> pa.RecordBatch:
    """A batch of the shards' table; columns that are not given are null."""
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64())}
    return pa.RecordBatch.from_arrays([columns.get(f.split()[0], pa.nulls(n, kinds[f.split()[1]])) for f in _FIELDS], _NAMES)


def _shard_rows(part: int, shard: Shard, ids: np.ndarray, end_ids: int) -> Iterator[pa.RecordBatch]:
    """Nodes that lie in this shard alone, what it has of the others, and the ids that end at those."""
    on_first, on_last = (np.isin(np.arange(shard.root + 1), shard.path(k)) for k in (0, len(ids) - 1))
    edge = on_first | on_last
    starts = np.flatnonzero(np.diff(shard.end, prepend=-1))  # equal conversations stand together, ids ascending
    stops = np.append(starts[1:], len(ids))
    from_, upto = np.zeros(shard.root + 1, np.int64), np.zeros(shard.root + 1, np.int64)
    from_[shard.end[starts]], upto[shard.end[starts]] = starts, stops
    longs = shard.digest.view(np.int64)

    def nodes(at: np.ndarray) -> dict[str, pa.Array]:
        up = shard.parent[at]
        known, outer = pa.array((up < 0) | edge[up]), pa.array((up < 0) | ~edge[up])
        columns = {n: pa.array(getattr(shard, n)[at]) for n in ("depth", "conv_id", "words", *_SUMS)}
        columns |= {"part": pa.array(np.full(len(at), part)), "hi": pa.array(longs[at, 0]), "lo": pa.array(longs[at, 1])}
        columns["parent_conv_id"] = pa.array(shard.conv_id[up], mask=np.asarray(known))
        return columns | {f"parent_{n}": pa.array(longs[up, k], mask=np.asarray(outer)) for k, n in enumerate(("hi", "lo"))}

    inner = np.flatnonzero(~edge)
    for at in np.split(inner, range(NODES, len(inner), NODES)) if len(inner) else []:
        many = upto[at] - from_[at]
        some = np.repeat(from_[at] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        ends = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many)]).astype(np.int32)), pa.array(ids[some], pa.int64()))
        yield _rows(len(at), kind=pa.array(["inner"] * len(at)), ends=ends, **nodes(at))
    at = np.flatnonzero(edge)
    last = pa.array(np.full(len(at), int(shard.lengths[-1])))
    marks = {"on_first": pa.array(on_first[at]), "on_last": pa.array(on_last[at]), "last_depth": last}
    yield _rows(len(at), kind=pa.array(["edge"] * len(at)), **marks, **nodes(at))
    for i in at[upto[at] > 0].tolist():
        own = ids[from_[i] : upto[i]]
        for k in range(0, len(own), end_ids):
            some = pa.array([own[k : k + end_ids]], pa.list_(pa.int64()))
            place = {n: pa.array([v], pa.int64()) for n, v in (("part", part), ("hi", longs[i, 0]), ("lo", longs[i, 1]), ("seq", k))}
            yield _rows(1, kind=pa.array(["ends"]), ends=some, **place)


def _shard(batches: Iterator[pa.RecordBatch], end_ids: int) -> Iterator[pa.RecordBatch]:
    some = [b for b in batches if b.num_rows]
    if some:
        paths_ = [b.column("path") for b in some]
        lengths = np.concatenate([np.asarray(pc.binary_length(c), dtype=np.int64) for c in paths_]) // _BYTES
        turns = np.frombuffer(b"".join(b"".join(c.to_pylist()) for c in paths_), np.uint64).reshape(-1, 2)
        ids = np.concatenate([np.asarray(b.column("id"), dtype=np.int64) for b in some])
        words = np.concatenate([np.asarray(b.column("words").flatten(), dtype=np.int64) for b in some])
        yield from _shard_rows(TaskContext.get().partitionId(), Shard(ids, turns, lengths, words), ids, end_ids)


class Trie(NamedTuple):
    """``nodes``: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends, and the key (hi, lo).

    ``ends`` has the ids of the conversations that end at the node, ascending;
    it is null where they stand in ``long_ends`` (hi, lo, part, seq, ends): in
    rows of up to ``end_ids`` ids, in order of part and seq, none if none end there.
    """

    nodes: DataFrame
    long_ends: DataFrame


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS, end_ids: int = END_IDS) -> Trie:
    """The trie of ``conversations`` (id, path, words), ids being distinct longs; see ``Trie`` and ``paths``.

    Each node, from the root of depth 0 that has no turn, has the smallest id of
    its members, their number n_convs, n_children, n_leaves (nodes without a child
    below it or itself) and saved_tokens: over its subtree, itself included, the
    sum of (n_convs - 1) times the words of a node's last turn. A conversation
    without a turn is a member of the root. No conversation, no node.
    """
    spark = conversations.sparkSession
    source = saved(conversations.select("id", "path", "words"))
    total = source.agg(F.sum(F.size("words"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_turns))
    ranged = source.repartitionByRange(n, "path", "id").sortWithinPartitions("path", "id")
    shards = saved(ranged.mapInArrow(lambda batches: _shard(batches, end_ids), ", ".join(_FIELDS)))

    partial = shards.where("kind = 'edge'")
    parts = partial.select("part").distinct()
    following = parts.select("part", F.lead("part").over(Window.orderBy("part")).alias("next"))  # one number per shard
    last = partial.where("on_last").select("part", "hi", "lo", "depth", "words", "last_depth").join(following, "part")
    opening = partial.where("on_first").select(F.col("part").alias("next"), "hi", "lo", "depth")
    border = Window.partitionBy("part")
    shared = last.join(opening, ["next", "hi", "lo", "depth"]).select(
        "hi",
        "lo",
        "depth",
        (-(F.col("depth") < F.max("depth").over(border)).cast("long")).alias("n_children"),
        (-(F.col("last_depth") == F.max("depth").over(border)).cast("long")).alias("n_leaves"),
        (-F.sum("words").over(border.orderBy(F.desc("depth")))).alias("distinct"),
    )
    both = partial.unionByName(shared, allowMissingColumns=True)
    firsts = [F.min(c).alias(c) for c in ("conv_id", "parent_hi", "parent_lo")]  # a parent's key is the same in every shard
    merged = saved(both.groupBy("hi", "lo", "depth").agg(*firsts, *[F.sum(c).alias(c) for c in _SUMS]))

    parents = small_side(merged.select(F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo"), F.col("conv_id").alias("of")))
    inner = shards.where("kind = 'inner'")
    below = inner.where("parent_hi is not null").join(parents, ["parent_hi", "parent_lo"]).withColumn("parent_conv_id", F.col("of"))
    edges = merged.join(parents, ["parent_hi", "parent_lo"], "left").withColumn("parent_conv_id", F.col("of"))
    columns = ["hi", "lo", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "said", "distinct", "ends"]
    every = inner.where("parent_hi is null").select(columns).unionByName(below.select(columns))
    every = every.unionByName(edges.withColumn("ends", F.lit(None).cast("array<bigint>")).select(columns))
    nodes = every.select(*columns[:8], (F.col("said") - F.col("distinct")).alias("saved_tokens"), "ends")
    return Trie(nodes, shards.where("kind = 'ends'").select("hi", "lo", "part", "seq", "ends"))


def long_end_digests(ends: DataFrame) -> DataFrame:
    """(hi, lo, sha256) of the comma-joined ids of each list in ``Trie.long_ends``, read in order, a row at a time."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, sha.hexdigest())], ["hi", "lo", "sha256"])

        for batch in batches:
            for hi, lo, ids in zip(*(batch.column(c) for c in ("hi", "lo", "ends")), strict=True):
                text = ",".join(map(str, ids.as_py())).encode()
                if key == (hi.as_py(), lo.as_py()):
                    sha.update(b"," + text)
                else:
                    if key is not None:
                        yield row()
                    key, sha = (hi.as_py(), lo.as_py()), hashlib.sha256(text)
        if key is not None:
            yield row()

    ordered = ends.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "part", "seq").select("hi", "lo", "ends")
    return ordered.mapInArrow(digest, "hi long, lo long, sha256 string")


#: conversations whose ids share the multiple of this below them begin alike, with up to 3 turns of the one with that id
FAMILY, MOST = 20, 4


def rebuilt(turns: DataFrame) -> DataFrame:
    """Paths of conversations that begin with the first h turns of id c - c % 20, then go on with their own after h.

    h is crc32(decimal id) % 4; of an absent conversation nothing is taken. The
    remainder of a negative id is negative or 0, as in SQL.
    """
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    own = paths(turns, within=base).withColumn("h", F.crc32(F.col("id").cast("string").cast("binary")) % MOST)
    heads = own.where(F.col("id") == F.col("within")).select(
        "within", F.substring("path", 1, _BYTES * (MOST - 1)).alias("head"), F.slice("words", 1, MOST - 1).alias("head_words")
    )
    h = F.col("h").cast("int")
    bytes_ = F.expr(f"concat(coalesce(substring(head, 1, cast({_BYTES} * h as int)), X''), substring(path, cast({_BYTES} * h as int) + 1))")
    before = F.coalesce(F.slice("head_words", F.lit(1), h), F.array().cast("array<int>"))
    after = F.slice("words", h + 1, F.greatest(F.size("words"), F.lit(1)))
    return own.join(heads, "within", "left").select(F.col("id").cast("long").alias("id"), bytes_.alias("path"), F.concat(before, after).alias("words"))


def op13_prefix_trie(spark, folder: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    trie = prefix_trie(rebuilt(table(spark, folder, "conversations")))
    short = F.sha2(F.array_join("ends", ",").cast("binary"), 256)
    digests = saved(long_end_digests(trie.long_ends))
    nodes = trie.nodes.select(*[c for c in trie.nodes.columns if c != "ends"], short.alias("short"), F.col("ends").isNull().alias("long"))
    none = hashlib.sha256(b"").hexdigest()
    listed = nodes.where("long").join(small_side(digests), ["hi", "lo"], "left").withColumn("ends_sha256", F.coalesce("sha256", F.lit(none)))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return nodes.where("not long").withColumn("ends_sha256", F.col("short")).select(columns).unionByName(listed.select(columns))


_STEP = "list_reduce(list_prepend(xor(a, b), [0::UBIGINT FOR k IN range(8)]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))"
_CRC = f"""xor(list_reduce(list_prepend(4294967295::UBIGINT, [ascii(substr(CAST(conv_id AS VARCHAR), CAST(i AS INT), 1))::UBIGINT
    FOR i IN range(1, length(CAST(conv_id AS VARCHAR)) + 1)]), lambda a, b: {_STEP}), 4294967295::UBIGINT)"""
_DIGEST = "md5(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))"
OP13_SQL = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_DIGEST}) - 1 AS k, {_DIGEST} AS said,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % {FAMILY} AS base, {_CRC} % {MOST} AS h FROM conversations WHERE conv_id IS NOT NULL),
u AS (SELECT c.conv_id, 0 AS own, k, said, words FROM c JOIN t ON t.conv_id = c.base WHERE k < h
    UNION ALL SELECT c.conv_id, 1, k, said, words FROM c JOIN t ON t.conv_id = c.conv_id WHERE k >= h),
p AS (SELECT conv_id, row_number() OVER w AS depth, md5(string_agg(said, '') OVER w) AS node, words FROM u
    WINDOW w AS (PARTITION BY conv_id ORDER BY own, k ROWS UNBOUNDED PRECEDING)),
q AS (SELECT conv_id, depth, node, words FROM p UNION ALL SELECT conv_id, 0, '', 0 FROM c),
e AS (SELECT conv_id, arg_max(node, depth) AS node FROM q GROUP BY conv_id),
ends AS (SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends FROM e GROUP BY node),
n AS (SELECT node, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words FROM q GROUP BY node),
m AS (SELECT n.*, a.node AS parent, a.conv_id AS parent_conv_id FROM n
    LEFT JOIN q AS b ON b.conv_id = n.conv_id AND b.depth = n.depth - 1 LEFT JOIN n AS a ON a.node = b.node),
f AS (SELECT parent AS node, count(*) AS n_children FROM m WHERE parent IS NOT NULL GROUP BY parent),
s AS (SELECT b.node, sum((m.n_convs - 1) * m.words) AS saved, count(*) FILTER (f.node IS NULL) AS leaves
    FROM m JOIN q AS b ON b.conv_id = m.conv_id AND b.depth <= m.depth LEFT JOIN f ON f.node = m.node GROUP BY b.node)
SELECT m.conv_id, CAST(m.depth AS BIGINT) AS depth, m.parent_conv_id, m.n_convs, CAST(coalesce(f.n_children, 0) AS BIGINT) AS n_children,
  CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(ends.ends, sha256('')) AS ends_sha256
FROM m JOIN s USING (node) LEFT JOIN f USING (node) LEFT JOIN ends USING (node)"""
