"""Deduplication of order lines: (l_orderkey, l_linenumber) occurs several times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.catalog import Source, query
from caseloom.functions.lists import members
from caseloom.operators import canonical, idsets

KEYS = ["l_orderkey", "l_linenumber"]
ORDER = [
    ("l_tax", "desc"),
    ("l_discount", "asc"),
    ("l_extendedprice", "desc"),
    ("l_partkey", "desc"),
    ("l_suppkey", "desc"),
    ("l_quantity", "desc"),
    ("l_shipdate", "desc"),
    ("l_returnflag", "asc"),
    ("l_linestatus", "asc"),
]
_ORDER_SQL = ", ".join(f"{c} {d} NULLS LAST" for c, d in ORDER)
FIELDS = ["l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate"]
_CONFLICTS = (
    "concat_ws('|', " + ", ".join(f"CASE WHEN count(DISTINCT {c}) > 1 THEN '{c}' END" for c in FIELDS) + ")"
)
_SUMMARY = """count(*) AS document_count, max(l_tax) AS max_l_tax,
  round(CAST(sum(CAST(l_tax AS DECIMAL(38,15))) AS DOUBLE) / count(l_tax), 9) AS avg_l_tax"""


@query(
    "canonical_best",
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY {_ORDER_SQL}) AS rn FROM lineitem) WHERE rn = 1""",
)
def canonical_best(src: Source) -> DataFrame:
    return canonical.pick_best(src.lineitem, KEYS, ORDER)


@query(
    "duplicate_summary",
    f"SELECT l_orderkey, l_linenumber, {_SUMMARY}, count(*) > 1 AS duplicate_flag FROM lineitem GROUP BY ALL",
)
def duplicate_summary(src: Source) -> DataFrame:
    out = canonical.duplicate_summary(src.lineitem, KEYS, "l_tax")
    return out.withColumn("avg_l_tax", F.round("avg_l_tax", 9))


@query(
    "duplicate_ids",
    """SELECT user_id, count(*) AS document_count, max(value) AS max_value,
      round(CAST(sum(CAST(value AS DECIMAL(38,15))) AS DOUBLE) / count(value), 6) AS avg_value,
      count(*) > 1 AS duplicate_flag,
      string_agg(DISTINCT CAST(event_id AS STRING), '|' ORDER BY CAST(event_id AS STRING)) AS event_ids
    FROM events GROUP BY user_id""",
)
def duplicate_ids(src: Source) -> DataFrame:
    """Copies per user with all their ids."""
    events = src.events.withColumn("event_id", F.col("event_id").cast("string"))
    out = canonical.duplicate_summary(events, ["user_id"], "value", id_col="event_id")
    return out.withColumns(
        {
            "event_ids": F.array_join("event_ids", "|"),
            "avg_value": F.round("avg_value", 6),
        }
    )


_BITMAP_ID = "'E-' || CAST(event_id AS STRING)"


@query(
    "id_bitmaps",
    f"""SELECT event_type, count(DISTINCT event_id) AS n_ids, count(DISTINCT event_id) AS n_members,
      min({_BITMAP_ID}) AS first_id, max({_BITMAP_ID}) AS last_id
    FROM events WHERE event_id % 2 = 0 OR event_id % 3 = 0 GROUP BY event_type""",
)
def id_bitmaps(src: Source) -> DataFrame:
    """Ids of a few heavy keys, of two overlapping tables: coded, made bitmaps, united, counted and read back."""
    events = src.events.select("event_type", F.concat(F.lit("E-"), F.col("event_id").cast("string")).alias("id"), "event_id")
    codes = idsets.id_codes(events, "id")
    coded = events.join(codes, "id")
    parts = [idsets.id_bitmaps(coded.where(F.col("event_id") % n == 0), ["event_type"], "code") for n in (2, 3)]
    whole = idsets.union(*parts, keys=["event_type"])
    told = idsets.members(whole, ["event_type"]).join(codes, "code").groupBy("event_type")
    told = told.agg(F.count(F.lit(1)).alias("n_members"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    return idsets.counts(whole, ["event_type"]).join(told, "event_type")


@query(
    "id_links",
    "SELECT DISTINCT user_id, 'event_ids' AS list_name, CAST(event_id AS STRING) AS value FROM events",
)
def id_links(src: Source) -> DataFrame:
    """The whole membership of a list, however long, as rows."""
    return members(src.events, ["user_id"], {"event_ids": F.array(F.col("event_id").cast("string"))})


@query(
    "conflict_fields",
    f"""SELECT l_orderkey, l_linenumber, {_CONFLICTS} AS conflict_fields, {_CONFLICTS} <> '' AS conflict_flag
      FROM lineitem GROUP BY ALL""",
)
def conflict_fields(src: Source) -> DataFrame:
    out = canonical.conflict_fields(src.lineitem, KEYS, FIELDS)
    return out.withColumn("conflict_fields", F.array_join("conflict_fields", "|"))


@query(
    "union_codes",
    """SELECT l_orderkey, string_agg(DISTINCT code, '|' ORDER BY code) AS codes FROM (
      SELECT l_orderkey, unnest([p_type, p_brand]) AS code FROM lineitem JOIN part ON l_partkey = p_partkey)
    GROUP BY l_orderkey""",
)
def union_codes(src: Source) -> DataFrame:
    part = src.part.select("p_partkey", F.array("p_type", "p_brand").alias("part_codes"))
    lines = src.lineitem.select("l_orderkey", "l_partkey").join(part, F.col("l_partkey") == F.col("p_partkey"))
    out = canonical.union_arrays(lines, ["l_orderkey"], {"codes": F.col("part_codes")})
    return out.select("l_orderkey", F.array_join("codes", "|").alias("codes"))


@query(
    "canonicalize_full",
    f"""WITH best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY {_ORDER_SQL}) AS rn FROM lineitem) WHERE rn = 1),
      facts AS (SELECT l_orderkey, l_linenumber, {_SUMMARY}, {_CONFLICTS} AS conflicts,
        string_agg(DISTINCT CAST(l_partkey AS STRING), '|' ORDER BY CAST(l_partkey AS STRING)) AS part_keys,
        string_agg(DISTINCT l_returnflag || l_linestatus, '|' ORDER BY l_returnflag || l_linestatus) AS flags
        FROM lineitem GROUP BY ALL)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_tax, document_count,
      document_count > 1 AS duplicate_document_flag, max_l_tax, avg_l_tax,
      conflicts AS cross_document_conflict_fields, conflicts <> '' AS cross_document_conflict, part_keys, flags
    FROM best JOIN facts USING (l_orderkey, l_linenumber)""",
)
def canonicalize_full(src: Source) -> DataFrame:
    out = canonical.canonicalize(
        src.lineitem,
        KEYS,
        ORDER,
        "l_tax",
        FIELDS,
        {
            "part_keys": F.array(F.col("l_partkey").cast("string")),
            "flags": F.array(F.concat("l_returnflag", "l_linestatus")),
        },
    )
    return out.select(
        *KEYS,
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_tax",
        "document_count",
        "duplicate_document_flag",
        "max_l_tax",
        F.round("avg_l_tax", 9).alias("avg_l_tax"),
        F.array_join("cross_document_conflict_fields", "|").alias("cross_document_conflict_fields"),
        "cross_document_conflict",
        F.array_join("part_keys", "|").alias("part_keys"),
        F.array_join("flags", "|").alias("flags"),
    )
