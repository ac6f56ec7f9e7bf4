"""Invariants and health of derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.catalog import Source, query
from caseloom.catalog.coverage import explode_lines
from caseloom.operators import audit, reconcile


@query(
    "audit_keys",
    """SELECT count(DISTINCT o_orderkey) AS keys_before, count(DISTINCT o_orderkey) AS keys_after, CAST(0 AS BIGINT) AS keys_lost,
      CAST(0 AS BIGINT) AS keys_invented, count(*) FILTER (o_orderkey % 5 IN (0, 2, 4)) AS keys_repeated FROM orders""",
)
def audit_keys(src: Source) -> DataFrame:
    """Exploding code lists loses no order, invents none and repeats those with two codes."""
    return audit.audit_keys(src.orders, explode_lines(src), ["o_orderkey"])


_AFTER = """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 997 <> 3
    UNION ALL SELECT o_orderkey + 1000000000, o_custkey FROM orders WHERE o_orderkey % 1009 = 5
    UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 1013 = 7"""


@query(
    "reconcile_keys",
    f"""WITH a AS (SELECT o_orderkey, o_custkey, count(*) AS n FROM orders GROUP BY ALL),
      b AS (SELECT o_orderkey, o_custkey, count(*) AS n FROM ({_AFTER}) GROUP BY ALL)
    SELECT o_orderkey, o_custkey, coalesce(a.n, 0) AS n_before, coalesce(b.n, 0) AS n_after
    FROM a FULL JOIN b USING (o_orderkey, o_custkey) WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""",
)
def reconcile_keys(src: Source) -> DataFrame:
    """Which orders a later table has lost, invented or repeated."""
    after = src.spark.sql(_AFTER.replace("FROM orders", "FROM {orders}"), orders=src.orders)
    return reconcile.differing_keys(src.orders, after, ["o_orderkey", "o_custkey"])


@query(
    "audit_unique",
    """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def audit_unique(src: Source) -> DataFrame:
    return audit.audit_unique(src.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "audit_domain",
    """SELECT count(*) FILTER (o_orderstatus NOT IN ('F', 'O') OR o_orderstatus IS NULL) AS o_orderstatus_outside,
      count(*) FILTER (o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') OR o_orderpriority IS NULL)
        AS o_orderpriority_outside FROM orders""",
)
def audit_domain(src: Source) -> DataFrame:
    allowed = {"o_orderstatus": ["F", "O"], "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]}
    return audit.audit_domain(src.orders, allowed)


@query(
    "audit_null",
    "SELECT CAST(0 AS BIGINT) AS approved_amount_filled, count(quality) AS quality_filled FROM documents LEFT JOIN labels USING (doc_id)",
)
def audit_null(src: Source) -> DataFrame:
    labelled = src.documents.join(src.labels, "doc_id", "left").withColumn("approved_amount", F.lit(None).cast("double"))
    return audit.audit_null(labelled, ["approved_amount", "quality"])


@query(
    "audit_pattern_absent",
    "SELECT column_name, hits FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (regexp_matches({c}, '{fv.SSN_PATTERN}')) AS hits FROM documents"
        for c in ("text", "lang", "source")
    ) + ")",
)
def audit_pattern_absent(src: Source) -> DataFrame:
    return audit.audit_pattern_absent(src.documents, fv.SSN_PATTERN)


@query(
    "reference_health",
    """WITH f AS (SELECT o_custkey + 100 AS k, count(*) AS a FROM orders GROUP BY ALL),
      d AS (SELECT c_custkey AS k, count(*) AS b FROM customer GROUP BY ALL),
      s AS (SELECT coalesce(a, 0) AS a, coalesce(b, 0) AS b FROM f FULL JOIN d USING (k))
    SELECT CAST(sum(a) AS BIGINT) AS fact_rows, CAST(0 AS BIGINT) AS null_key_rows,
      CAST(coalesce(sum(a) FILTER (b = 0), 0) AS BIGINT) AS orphan_rows,
      CAST(coalesce(sum(a) FILTER (b = 1), 0) AS BIGINT) AS resolved_rows,
      CAST(coalesce(sum(a) FILTER (b > 1), 0) AS BIGINT) AS ambiguous_rows, count(*) FILTER (b > 1) AS repeated_keys,
      count(*) FILTER (b > 0 AND a = 0) AS unused_keys FROM s""",
)
def reference_health(src: Source) -> DataFrame:
    orders = src.orders.select((F.col("o_custkey") + 100).alias("wanted_customer"))
    return audit.reference_health(orders, src.customer, ("wanted_customer", "c_custkey"))
