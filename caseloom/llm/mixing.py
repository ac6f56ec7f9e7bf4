"""Mixing sources to target weights by hash-threshold histograms, with DataFrame functions only.

Every document has a fixed 60-bit hash. A source's target is met by whole
copies of all its documents and, for what remains, one copy more of those
documents whose hash is below the source's threshold. Thresholds come from sums
of sizes by source and leading hash bits; only the bucket in which the sum
passes the budget is split by its next bits. Nothing is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.shared import beside, saved, small_side, table

#: weights of the sources in code point order, repeating
WEIGHTS = (5, 2, 1)
#: a target is at most so many times its source's size
MOST = 3
#: words are runs of other than the six ASCII white space characters
WORD = r"[^\x20\x09-\x0D]+"
#: 4 levels of 15 bits are all 60 bits of the hash
LEVELS, BITS = 4, 15


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def order_hash(id: str, text: str) -> Column:
    """60 bits of the MD5 of the id and the text, so a rerun takes the same documents."""
    whole = F.concat_ws("|", F.col(id).cast("string"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size) to which weight and target are added; one row per source.

    The reshared weights end where water poured over the sources would stand:
    with the sources in order of most x size / weight, those below the level are
    full and all others hold level x weight.
    """
    everything = Window.partitionBy()  # one narrow row per source
    rank = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    weighed = sizes.withColumn("weight", weight).withColumn("cap", F.lit(most) * F.col("source_size"))
    ordered = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = weighed.withColumn("level", rest / open_weight)
    # the level of the first source that is not full holds for all after it
    not_full = F.col("level") * F.col("weight") <= F.col("cap")
    final = F.first(F.when(not_full, F.col("level")), ignorenulls=True).over(
        ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    full = F.col("level") * F.col("weight") > F.col("cap")
    target = F.when(full, F.col("cap").cast("double")).otherwise(F.least(final * F.col("weight"), F.col("cap").cast("double")))
    return level.select("source", "source_size", "weight", target.alias("target"))


def thresholds(narrow: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, threshold): the documents of a source with a hash up to it hold about its ``rest`` words.

    ``narrow`` has source, size, h; ``budgets`` source and rest. Level by level
    the sizes in the open bucket of each source are summed by their next bits.
    Within the last level a bucket is one hash; it is taken if that brings the
    sum nearer to the budget.
    """
    open_ = budgets.select("source", F.col("rest").cast("double").alias("rest"), F.lit(0).cast("long").alias("prefix"))
    open_ = saved(open_)
    for depth in range(1, LEVELS + 1):
        shift = (LEVELS - depth) * BITS
        inside = narrow.join(small_side(open_.withColumnRenamed("source", "_s")), F.col("source").eqNullSafe(F.col("_s")))
        inside = inside.where(F.shiftright("h", shift + BITS) == F.col("prefix"))
        sums = inside.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(
            F.sum("size").alias("words"), F.first("rest").alias("rest")
        )
        running = Window.partitionBy("source").orderBy("bucket")  # at most 2**BITS rows a source
        upto = sums.withColumn("upto", F.sum("words").over(running))
        fits = upto.groupBy("source").agg(
            F.first("rest").alias("rest"),
            F.coalesce(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("upto"))), F.lit(0)).alias("taken"),
            F.min(F.when(F.col("upto") > F.col("rest"), F.struct("bucket", "upto"))).alias("crossing"),
            F.max("bucket").alias("last"),
        )
        # a budget that holds the whole bucket leaves its last part as the open one
        at = F.coalesce(F.col("crossing.bucket"), F.col("last") + 1)
        left = F.col("rest") - F.col("taken")
        if depth < LEVELS:
            open_ = saved(fits.select("source", left.alias("rest"), at.alias("prefix")))
        else:
            nearer = F.col("crossing.upto") - F.col("rest") < left
            open_ = fits.select("source", F.when(F.col("crossing").isNotNull() & ~nearer, at - 1).otherwise(at).alias("threshold"))
    return open_


def plan(docs: DataFrame, id: str, text: str, source: str, weights=WEIGHTS, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """The narrow rows (id, source, size, h) and one row per source: source_size, target, whole, threshold."""
    narrow = docs.select(F.col(id).alias("id"), F.col(source).alias("source"), size_of(text).alias("size"), order_hash(id, text).alias("h"))
    narrow = saved(narrow)
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    aimed = targets(sizes, weights, most)
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0)
    budget = aimed.withColumn("whole", whole.cast("long"))
    budget = saved(budget.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))
    partly = budget.where((F.col("whole") < most) & (F.col("source_size") > 0)).select("source", "rest")
    cut = thresholds(narrow, partly).withColumnRenamed("source", "_s")
    per_source = budget.join(cut, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    return narrow, saved(per_source.withColumnRenamed("source", "_s"))


def _copies(h) -> Column:
    return F.col("whole") + F.when(h <= F.col("threshold"), 1).otherwise(0)


def mixed(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per row of ``docs``: id, source, size, source_size, target, copies, taken.

    size is the number of words, 0 for a null or empty text; copies, 0 to
    ``most``, is how often the mix takes the document, taken = copies x size.
    A source that is null is a source, last in order; one without words takes
    nothing. Rows that repeat id and text have the same hash and go in or stay
    out together. An empty table gives an empty result.
    """
    narrow, per_source = plan(docs, id, text, source, weights, most)
    out = narrow.join(small_side(per_source), F.col("source").eqNullSafe(F.col("_s")))
    copies = _copies(F.col("h"))
    return out.select(
        F.col("id").alias(id), "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def repeat_to_mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it."""
    _, per_source = plan(docs, id, text, source, weights, most)
    rows = beside(docs, source=F.col(source), h=order_hash(id, text))
    joined = rows.join(small_side(per_source), F.col("source").eqNullSafe(F.col("_s"))).withColumn("n", _copies(F.col("h")))
    return joined.where("n > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("_copy")).select("row.*")


def op5_mixing(spark, folder: str) -> DataFrame:
    """Every document with its size, its source's target and the words the mix takes of it."""
    return mixed(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP5_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    CAST('0x' || substr(md5(concat_ws('|', CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT)]::DOUBLE AS weight FROM s),
o AS (SELECT *, 3 * source_size AS cap, row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS k FROM w),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS lvl
    FROM o WINDOW b AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT min(k) AS k0, arg_min(lvl, k) AS final FROM l WHERE lvl * weight <= cap),
t AS (SELECT source, source_size, CASE WHEN k < k0 THEN cap ELSE least(final * weight, cap) END::DOUBLE AS target FROM l, f),
q AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END AS whole FROM t),
r AS (SELECT *, target - whole * source_size AS rest FROM q),
g AS (SELECT d.source, h, sum(size) AS words FROM d GROUP BY ALL),
c AS (SELECT g.*, sum(words) OVER (PARTITION BY source ORDER BY h) AS upto FROM g),
x AS (SELECT c.source, c.h, r.whole < 3 AND (upto <= rest OR (upto - words <= rest AND upto - rest < rest - (upto - words))) AS more
    FROM c JOIN r ON c.source IS NOT DISTINCT FROM r.source)
SELECT d.doc_id, d.size, CAST(r.source_size AS BIGINT) AS source_size, r.target,
  CAST((whole + CASE WHEN more THEN 1 ELSE 0 END) * d.size AS BIGINT) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source JOIN x ON d.source IS NOT DISTINCT FROM x.source AND d.h = x.h
"""
