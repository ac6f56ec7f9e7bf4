"""Orders ask for grants that the orders of the neighbouring customer provide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.catalog import Source, query
from caseloom.catalog.histories import dated_orders
from caseloom.operators import authorization

KEYS = ["o_custkey", "procedure_code"]


def classified(src: Source) -> DataFrame:
    orders = dated_orders(src)
    requests = orders.select(
        "o_orderkey", "o_custkey", F.col("o_orderpriority").alias("procedure_code"), "day", "o_orderstatus"
    )
    status = (
        F.when(F.col("o_orderstatus") == "F", "APPROVED")
        .when(F.col("o_orderstatus") == "O", F.when(F.col("o_orderkey") % 2 == 0, "APPROVED").otherwise("DENIED"))
        .otherwise(F.when(F.col("o_orderkey") % 2 == 0, "PENDING").otherwise("CANCELLED"))
    )
    grants = orders.select(
        F.concat(F.lit("AUTH-"), F.col("o_orderkey").cast("string")).alias("authorization_id"),
        status.alias("authorization_status"),
        F.date_sub("day", 200).alias("valid_from"),
        F.when(F.col("o_orderkey") % 11 != 0, F.date_add("day", 600)).alias("valid_to"),
        (F.col("o_custkey") + 1).alias("o_custkey"),
        F.col("o_orderpriority").alias("procedure_code"),
    )
    matched = authorization.match_authorizations(requests, grants, KEYS, "day")
    return authorization.classify_authorization(matched, "procedure_code")


_CLASSIFIED = """d AS (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders),
  g AS (SELECT 'AUTH-' || CAST(o_orderkey AS STRING) AS authorization_id, CASE WHEN o_orderstatus = 'F' THEN 'APPROVED'
      WHEN o_orderstatus = 'O' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'APPROVED' ELSE 'DENIED' END
      WHEN o_orderkey % 2 = 0 THEN 'PENDING' ELSE 'CANCELLED' END AS authorization_status,
    day - 200 AS valid_from, CASE WHEN o_orderkey % 11 <> 0 THEN day + 600 END AS valid_to, o_custkey + 1 AS o_custkey,
    o_orderpriority FROM d),
  matched AS (SELECT d.o_orderkey, d.o_custkey, d.o_orderpriority, g.authorization_id, g.authorization_status, g.valid_from,
    g.valid_to, coalesce(g.authorization_status = 'APPROVED' AND d.day BETWEEN g.valid_from AND g.valid_to, false) AS ok
    FROM d LEFT JOIN g ON d.o_custkey = g.o_custkey AND d.o_orderpriority = g.o_orderpriority),
  ranked AS (SELECT *, count(authorization_id) OVER w AS n, count(*) FILTER (ok) OVER w AS valid, row_number() OVER (
      PARTITION BY o_orderkey ORDER BY ok DESC, valid_to DESC NULLS LAST, authorization_id) AS rn
    FROM matched WINDOW w AS (PARTITION BY o_orderkey)),
  classified AS (SELECT *, CASE WHEN n = 0 THEN 'MISSING' WHEN n > 1 THEN 'AMBIGUOUS' WHEN ok THEN 'VALID'
      WHEN authorization_status = 'APPROVED' THEN 'EXPIRED' ELSE authorization_status END AS authorization_result
    FROM ranked WHERE rn = 1)"""


@query(
    "authorization_classify",
    f"""WITH {_CLASSIFIED} SELECT o_orderkey, n AS authorization_match_count, valid AS valid_authorization_count,
      authorization_id, authorization_status, valid_from, valid_to, authorization_result FROM classified""",
)
def authorization_classify(src: Source) -> DataFrame:
    return classified(src).select(
        "o_orderkey",
        "authorization_match_count",
        "valid_authorization_count",
        "authorization_id",
        "authorization_status",
        "valid_from",
        "valid_to",
        "authorization_result",
    )


_RANK = "CASE authorization_result " + " ".join(
    f"WHEN '{s}' THEN {i}" for i, s in enumerate(fv.AUTHORIZATION_PRIORITY)
) + " END"


@query(
    "priority_rollup",
    f"""WITH {_CLASSIFIED} SELECT o_custkey, arg_min(authorization_result, {_RANK}) AS pre_authorization_status,
      coalesce(string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority)
        FILTER (authorization_result = 'VALID'), '') AS authorized,
      coalesce(string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority)
        FILTER (authorization_result <> 'VALID'), '') AS lacking
    FROM classified GROUP BY o_custkey""",
)
def priority_rollup(src: Source) -> DataFrame:
    """Worst status per customer, and its codes with and without a valid grant."""
    rows = classified(src)
    valid = F.col("authorization_result") == "VALID"

    def codes(condition: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("procedure_code")))), "|")

    return rows.groupBy("o_custkey").agg(
        authorization.worst_status(F.col("authorization_result")).alias("pre_authorization_status"),
        codes(valid).alias("authorized"),
        codes(~valid).alias("lacking"),
    )
