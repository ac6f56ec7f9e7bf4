"""Embedding near-duplicates: exact pairs of a cosine threshold by dual traversal of cover trees.

Vectors of one label are parted into cells by nearest pivot, level by level,
until a cell owns few enough of them for one task. A cell also gets, as guests,
the vectors of other cells that may lie within the threshold of one it owns: for
pivots p and q, a vector whose projection lies further than the threshold on p's
side of the plane between them cannot be that near to anything on q's side. So
an owned vector finds all its links in its own cell. Within a cell, two cover
trees are walked together and node pairs are cut off, or counted whole, by the
bounds that their covering radii give.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.links import components
from caseloom.llm.shared import saved, table

THRESHOLD = 0.98
#: vectors that a cell owns at most, and guests or rows to deal out that a task takes
CELL = 8192
#: centers of one side that are compared with all of the other's at a time
STRIP = 512
PIVOTS = 16
#: members that a leaf of a tree may have; leaves are compared as matrices
SMALL = 32
#: bytes of the vectors that a cell owns at most
CELL_BYTES = 32 << 20
_SLACK = 1e-9


@dataclasses.dataclass
class Node:
    center: int
    #: the largest distance from the center to any vector below
    radius: float
    members: np.ndarray
    children: list[Node]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Between rows of unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def cover_tree(units: np.ndarray, small: int = 1) -> Node:
    """Nested levels over the rows: each level's centers cover all rows within half the radius of the level above.

    A center stays one on every level below. A node whose members are all at
    its center, or that has at most ``small`` members, is a leaf.
    """

    def grow(center: int, members: np.ndarray, away: np.ndarray, scale: float) -> Node:
        radius = float(away.max())
        node = Node(center, radius, members, [])
        if len(members) <= small or radius <= _SLACK:
            return node
        scale = min(scale, radius) / 2
        rest, here = members, away
        while len(rest):
            near = here <= scale
            node.children.append(grow(center, rest[near], here[near], scale))
            rest = rest[~near]
            if len(rest):
                center = int(rest[0])
                here = distances(units[rest], units[center : center + 1])[:, 0]
                here[0] = 0.0
        return node

    members = np.arange(len(units))
    away = distances(units, units[:1])[:, 0]
    away[0] = 0.0
    return grow(0, members, away, 4.0)


class Links:
    """What is found about the rows of a cell: the weight that each is linked with, and which hang together."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.counts = np.zeros(len(weights), np.int64)
        self.parent = np.arange(len(weights))

    def roots(self, rows: np.ndarray) -> np.ndarray:
        out = self.parent[rows]
        while (up := self.parent[out]).tolist() != out.tolist():
            out = up
        self.parent[rows] = out
        return out

    def _join(self, a: np.ndarray, b: np.ndarray) -> None:
        """The components of a[k] and b[k], given by their roots, become one."""
        np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))

    def whole(self, rows: np.ndarray, others: np.ndarray | None) -> None:
        """Every row is linked with every one of ``others``, or with all other ``rows``."""
        if others is None:
            self.counts[rows] += self.weights[rows].sum() - self.weights[rows]
        else:
            self.counts[rows] += self.weights[others].sum()
            self.counts[others] += self.weights[rows].sum()
        every = rows if others is None else np.concatenate([rows, others])
        self._hook(every)

    def _hook(self, rows: np.ndarray) -> None:
        roots = self.roots(rows)
        self.parent[roots] = roots.min()

    def block(self, rows: np.ndarray, others: np.ndarray, linked: np.ndarray) -> None:
        """``linked`` tells row by row which of ``others`` each is linked with; every pair is told once."""
        self.counts[rows] += linked @ self.weights[others]
        self.counts[others] += self.weights[rows] @ linked
        at, to = linked.any(axis=1), linked.any(axis=0)
        rows, others, linked = rows[at], others[to], linked[np.ix_(at, to)]
        while len(rows):
            mine, theirs = self.roots(rows), self.roots(others)
            top = len(self.parent)
            least = np.where(linked, theirs[None, :], top).min(axis=1)
            greatest = np.where(linked, theirs[None, :], -1).max(axis=1)
            if (least == mine).all() and (greatest == mine).all():
                return
            low = np.minimum(mine, least)
            self._join(mine, low)
            self._join(theirs, np.minimum(theirs, np.where(linked, low[:, None], top).min(axis=0)))


def _members(nodes: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    """All members of some nodes, and the place of each one's node."""
    return np.concatenate([n.members for n in nodes]), np.repeat(np.arange(len(nodes)), [len(n.members) for n in nodes])


def traverse(units: np.ndarray, first: np.ndarray, second: np.ndarray | None, threshold: float, found: Links) -> None:
    """Tell ``found`` every linked pair of rows ``first`` and ``second`` once, or of two rows ``first``.

    Cover trees of both sides are walked together, lists of nodes at a time.
    A pair of nodes too far apart for their radii is left; one near enough is
    linked as a whole; leaves on both sides are compared as one matrix product;
    of any other pair the inner node is opened.
    """
    near = np.sqrt(max(2 - 2 * threshold, 0.0))
    same = second is None
    a, b = units[first], units[first if same else second]
    second = first if same else second
    one = cover_tree(a, SMALL)
    stack = [([one], [one] if same else [cover_tree(b, SMALL)], same)]
    while stack:
        xs, ys, twins = stack.pop()
        left, right = a[[n.center for n in xs]], b[[n.center for n in ys]]
        rx, ry = (np.array([n.radius for n in side]) for side in (xs, ys))
        inner_x, inner_y = (np.array([bool(n.children) for n in side]) for side in (xs, ys))
        for start in range(0, len(xs), STRIP):
            part = xs[start : start + STRIP]
            apart = np.sqrt(np.maximum(2 - 2 * (left[start : start + STRIP] @ right.T), 0))
            reach = rx[start : start + STRIP, None] + ry[None, :]
            keep = apart <= near + reach + _SLACK
            place = np.arange(start, start + len(part))
            if twins:
                keep &= place[:, None] <= np.arange(len(ys))[None, :]
            opened_x, opened_y = inner_x[place][:, None], inner_y[None, :]
            leaves = keep & ~opened_x & ~opened_y
            if leaves.any():
                _compare(part, ys, leaves, twins, a, b, first, second, threshold, found)
            keep &= opened_x | opened_y
            self_pair = place[:, None] == np.arange(len(ys))[None, :] if twins else np.zeros_like(keep)
            for i in np.flatnonzero((keep & self_pair).any(axis=1)).tolist():
                if 2 * part[i].radius <= near - _SLACK:
                    found.whole(first[part[i].members], None)
                else:
                    stack.append((part[i].children, part[i].children, True))
            keep &= ~self_pair
            decided = keep & (apart + reach <= near - _SLACK)
            for j in np.flatnonzero(decided.any(axis=0)).tolist():
                rows = _members([part[i] for i in np.flatnonzero(decided[:, j])])[0]
                found.whole(first[rows], second[ys[j].members])
            keep &= ~decided
            for j in np.flatnonzero((keep & opened_y & ~opened_x).any(axis=0)).tolist():
                stack.append(([part[i] for i in np.flatnonzero(keep[:, j] & ~opened_x[:, 0])], ys[j].children, False))
            for i in np.flatnonzero((keep & opened_x & ~opened_y).any(axis=1)).tolist():
                stack.append((part[i].children, [ys[j] for j in np.flatnonzero(keep[i] & ~opened_y[0])], False))
            for i, j in np.argwhere(keep & opened_x & opened_y).tolist():
                stack.append((part[i].children, ys[j].children, False))


def _compare(xs, ys, keep, twins, a, b, first, second, threshold, found: Links) -> None:
    """All members of leaves whose pair is in ``keep``, by products of at most ``STRIP`` rows; of twins the upper half."""
    at, to = np.flatnonzero(keep.any(axis=1)), np.flatnonzero(keep.any(axis=0))
    rows, of_row = _members([xs[i] for i in at])
    others, of_other = _members([ys[j] for j in to])
    small = keep[np.ix_(at, to)]
    for start in range(0, len(rows), STRIP):
        some, of = rows[start : start + STRIP], of_row[start : start + STRIP]
        linked = (a[some] @ b[others].T >= threshold) & small[of][:, of_other]
        if twins:  # a pair of nodes is kept once, so only within one node a pair of members would come twice
            within = np.array([id(xs[i]) for i in at])[of][:, None] == np.array([id(ys[j]) for j in to])[of_other][None, :]
            linked &= ~within | (some[:, None] < others[None, :])
        found.block(first[some], second[others], linked)


def cell_links(units: np.ndarray, weights: np.ndarray, owned: np.ndarray, among: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For the rows of one cell: how many vectors each owned row is linked with here, and a local root of each row.

    ``among``: count links between owned rows too, not only with guests.
    """
    own, guests = np.flatnonzero(owned), np.flatnonzero(~owned)
    found = Links(weights)
    if among and len(own):
        traverse(units, own, None, threshold, found)
    if len(own) and len(guests):
        traverse(units, own, guests, threshold, found)
    return found.counts, found.roots(np.arange(len(units)))


def routes(units: np.ndarray, pivots: np.ndarray, near: float) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest pivot, and (rows x pivots) whether it may be within ``near`` of a vector nearest to that pivot."""
    squared = np.maximum(2 - 2 * (units @ pivots.T), 0)
    between = distances(pivots, pivots)
    np.fill_diagonal(between, np.inf)
    beyond = (squared[:, :, None] - squared[:, None, :]) / (2 * np.maximum(between, 1e-12))[None, :, :]
    return squared.argmin(axis=1), beyond.max(axis=2) <= near + _SLACK


def unit_vectors(vectors: DataFrame, id: str, vector: str, label: str) -> DataFrame:
    """(id, label, unit): the vector in double precision and of length 1, as bytes; null where it links with nothing."""

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, of in zip(batch.column("vector"), batch.column("label").to_pylist(), strict=True):
                values = None if row.as_py() is None or of is None else row.values
                if values is None or not len(values) or values.null_count:
                    out.append(None)
                    continue
                x = np.asarray(values, dtype=np.float64)
                top = np.abs(x).max()
                if not np.isfinite(top) or top == 0:
                    out.append(None)
                    continue
                x = x / top
                out.append((x / np.sqrt(x @ x) + 0.0).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(out, pa.binary())], ["id", "label", "unit"])

    rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("vector"))
    return rows.mapInArrow(scale, "id long, label string, unit binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def parted(points: DataFrame, threshold: float, most: int) -> DataFrame:
    """(cell, key, unit, n, owned): every point owned by one cell of at most ``most`` owned points, and its guests.

    A pass deals out the cells that own more. Pivots are the points of lowest
    hash in each of 16 classes of hash, a partly aggregated minimum, so no cell
    is gathered anywhere.
    """
    near = float(np.sqrt(max(2 - 2 * threshold, 0.0)))

    def deal(rows: pa.Table, pivots: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({"cell": [], "key": [], "unit": [], "n": [], "owned": []}, schema=schema)
        units = _matrix(rows["unit"].combine_chunks())
        ordered = pivots.sort_by("place")
        nearest, goes = routes(units, _matrix(ordered["pivot"].combine_chunks()), near)
        at, to = np.nonzero(goes | (nearest[:, None] == np.arange(goes.shape[1])))
        dealt = rows.take(pa.array(at))
        owned = np.asarray(dealt["owned"]) & (nearest[at] == to)
        cells = [f"{c}/{t}" for c, t in zip(dealt["cell"].to_pylist(), to.tolist(), strict=True)]
        return pa.table([pa.array(cells, pa.string()), dealt["key"], dealt["unit"], dealt["n"], pa.array(owned)], schema=schema)

    schema = pa.schema([("cell", pa.string()), ("key", pa.binary()), ("unit", pa.binary()), ("n", pa.int64()), ("owned", pa.bool_())])
    done, todo = None, points
    while True:
        own, fit = F.sum(F.col("owned").cast("long")), F.floor(F.lit(CELL_BYTES) / F.max(F.octet_length("unit")))
        sizes = todo.groupBy("cell").agg(own.alias("_own"), F.count(F.lit(1)).alias("_all"), F.greatest(F.least(F.lit(most), fit), F.lit(1)).alias("_fit"))
        sizes = saved(sizes)
        if not sizes.where(F.col("_own") > F.col("_fit")).limit(1).count():
            break
        large = sizes.where(F.col("_own") > F.col("_fit")).select("cell", F.ceil(F.col("_all") / F.col("_fit")).cast("int").alias("_chunks"))
        ready = saved(todo.join(large, "cell", "left_anti"))
        done = ready if done is None else done.unionByName(ready)
        heavy = todo.join(large, "cell").withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("_chunks")).cast("int"))
        hashed = todo.where("owned").join(large, "cell").withColumn("place", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(PIVOTS)))
        pivots = hashed.groupBy("cell", "place").agg(
            F.min_by("unit", F.struct(F.xxhash64("key", F.lit(2)), "key")).alias("unit"), F.first("_chunks").alias("_chunks")
        )
        every = F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))
        each = pivots.select(F.col("cell").alias("of"), every.alias("part"), "place", F.col("unit").alias("pivot"))
        out = (
            heavy.select("cell", "chunk", "key", "unit", "n", "owned")
            .groupBy("cell", "chunk")
            .cogroup(each.groupBy("of", "part"))
            .applyInArrow(deal, "cell string, key binary, unit binary, n long, owned boolean")
        )
        todo = saved(out)
    return todo if done is None else done.unionByName(todo)


def embedding_links(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD, most: int = CELL
) -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id, kept.

    Linked are two rows of equal, not null label and equal length whose cosine,
    in double precision, is ``threshold`` or more. Vectors that are null, empty,
    zero or hold a null or non-finite component are linked with nothing. Equal
    vectors are folded to one first, so copies cost no pairs. component_id is
    the smallest id reachable; a row whose id is null and that is alone has
    null. Rows that repeat an id are rows of their own. ``threshold`` is above 0.
    """
    rows = saved(unit_vectors(vectors, id, vector, label))
    framed = F.concat(F.octet_length("label").cast("string"), F.lit(":"), "label").cast("binary")
    key = F.unhex(F.md5(F.concat(framed, F.col("unit"))))
    keyed = rows.withColumn("key", key)
    cell = F.concat_ws("/", F.octet_length("unit"), F.hex("label"))  # a slash only before the number of a part
    points = keyed.where("unit is not null").groupBy("key").agg(
        F.first(cell).alias("cell"), F.first("unit").alias("unit"), F.count(F.lit(1)).alias("n"), F.min("id").alias("least")
    )
    points = saved(points)
    placed = parted(points.select("cell", "key", "unit", "n", F.lit(True).alias("owned")), threshold, most)
    fit = F.greatest(F.least(F.lit(most), F.floor(F.lit(CELL_BYTES) / F.max(F.octet_length("unit")))), F.lit(1))
    guests = placed.where("not owned").groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / fit).cast("int").alias("_chunks"))
    dealt = saved(placed).join(guests, "cell", "left").withColumn("_chunks", F.coalesce("_chunks", F.lit(1)))
    every = F.sequence(F.lit(0), F.col("_chunks") - 1)
    own = F.array(F.pmod(F.xxhash64("key"), F.col("_chunks")).cast("int"))
    dealt = dealt.withColumn("chunk", F.explode(F.when(F.col("owned"), every).otherwise(own))).drop("_chunks")

    def count(group: pa.Table) -> pa.Table:
        owned = np.asarray(group["owned"].combine_chunks())
        first = bool(len(group)) and group["chunk"][0].as_py() == 0
        counts, roots = cell_links(_matrix(group["unit"].combine_chunks()), np.asarray(group["n"]), owned, first, threshold)
        told = owned | (roots != np.arange(len(roots)))
        keys = group["key"].combine_chunks()
        out = pa.table([keys, pa.array(np.where(owned, counts, 0)), keys.take(pa.array(roots))], ["key", "links", "root"])
        return out.filter(pa.array(told))

    found = saved(dealt.groupBy("cell", "chunk").applyInArrow(count, "key binary, links long, root binary"))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    of_point = (
        points.select("key", "n", "least")
        .join(links, "key")
        .join(groups.withColumnsRenamed({"node": "key"}), "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    lowest = of_point.groupBy("root").agg(F.min("least").alias("component_id"))
    known = of_point.join(lowest, "root").select("key", (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id")
    # rows that link with nothing have no key; dealt out by id they are not one hot key
    lone = F.when(F.col("key").isNull(), F.col("id").cast("string").cast("binary")).otherwise(F.col("key"))
    out = keyed.select("id", F.col("key").isNull().alias("_alone"), lone.alias("key")).join(known, "key", "left")
    of = F.when(F.col("_alone"), F.col("id")).otherwise(F.coalesce("component_id", "id"))
    return out.select(
        F.col("id").alias(id),
        F.when(F.col("_alone"), F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        of.alias("component_id"),
        F.coalesce(F.col("id") == of, F.lit(False)).alias("kept"),
    )


def op4_embedding_links(spark, folder: str) -> DataFrame:
    """Every vector with its links and its component."""
    return embedding_links(table(spark, folder, "embeddings"))


#: all pairs of a label, in double precision
OP4_SQL = f"""
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
g AS (SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
    AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN e IF x <> 0]) > 0),
p AS (SELECT a.r AS a, b.r AS b FROM g a JOIN g b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
    WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= {THRESHOLD}),
c(a, root) AS (SELECT r, vec_id FROM v UNION SELECT p.b, c.root FROM c JOIN p ON p.a = c.a),
m AS (SELECT a, min(root) AS component_id FROM c GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN m ON m.a = v.r LEFT JOIN n ON n.a = v.r"""
