"""Sets of ids as bitmaps: a key with a million ids is some rows of fixed size, not one row with a million strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: codes in one bitmap of 4 KB, as the built-in functions have it
WIDTH = 1 << 15
#: parts that ids are numbered in, each by a window of its own
PARTS = 1 << 12


def id_codes(ids: DataFrame, id: str, parts: int = PARTS) -> DataFrame:
    """(id, code): every distinct id that is not null, numbered from 0 without gaps.

    Ids are numbered within parts by hash, in order of id, and the counts of the
    parts before are added: the same ids get the same codes, whatever their rows,
    and a window sees one part, or one row per part.
    """
    known = ids.select(F.col(id).alias("id")).where(F.col("id").isNotNull()).distinct()
    placed = known.withColumn("_part", F.pmod(F.xxhash64("id"), F.lit(parts)))
    line = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row per part
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(line), F.lit(0)).alias("_before"))
    numbered = placed.withColumn("_at", F.row_number().over(Window.partitionBy("_part").orderBy("id")) - 1)
    return numbered.join(F.broadcast(before), "_part").select("id", (F.col("_before") + F.col("_at")).alias("code"))


def id_bitmaps(df: DataFrame, keys: list[str], code: str) -> DataFrame:
    """(keys, block, ids): for each key and each range of ``WIDTH`` codes a bitmap of those that the key has.

    Codes are whole numbers from 0; a null one is none. Bitmaps are built on the
    map side, so repeated rows and heavy keys cost no shuffle; a key has as many
    rows as ranges that it has codes in. A null key is a key.
    """
    at = F.col(code) + 1  # the functions count from 1
    known = df.where(F.col(code).isNotNull())
    placed = known.select(*keys, F.bitmap_bucket_number(at).alias("block"), F.bitmap_bit_position(at).alias("_at"))
    return placed.groupBy(*keys, "block").agg(F.bitmap_construct_agg("_at").alias("ids"))


def union(*bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """The bitmaps of several tables as those of one, or with fewer ``keys`` than they have, of all keys that agree in them."""
    every = [b.select(*keys, "block", "ids") for b in bitmaps]
    whole = every[0]
    for more in every[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy(*keys, "block").agg(F.bitmap_or_agg("ids").alias("ids"))


def counts(bitmaps: DataFrame, keys: list[str], out: str = "n_ids") -> DataFrame:
    """How many distinct ids each key has."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("ids")).alias(out))


def members(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, code): one row per code of each bitmap, whole, however many a key has."""

    def byte(i: Column) -> Column:
        return F.conv(F.hex(F.substring("ids", i, F.lit(1))), 16, 10).cast("int")

    some = F.filter(F.sequence(F.lit(1), F.length("ids")), lambda i: byte(i) > 0)
    bytes_ = bitmaps.select(*keys, "block", "ids", F.explode(some).alias("_i"))
    bits = bytes_.select(*keys, "block", "_i", byte(F.col("_i")).alias("_byte"), F.explode(F.array(*[F.lit(b) for b in range(8)])).alias("_b"))
    held = bits.where(F.expr("(shiftright(_byte, _b) & 1) = 1"))
    return held.select(*keys, ((F.col("block") - 1) * WIDTH + (F.col("_i") - 1) * 8 + F.col("_b")).cast("long").alias("code"))
