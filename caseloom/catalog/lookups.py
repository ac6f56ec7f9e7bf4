"""Reference tables with repeated keys, and records that look them up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.catalog import Source, query
from caseloom.operators import lookup, rules


@query(
    "reduce_dimension",
    """SELECT p_brand, p_type, p_partkey, p_name, p_size, p_retailprice, match_count FROM (
      SELECT *, count(*) OVER (PARTITION BY p_brand, p_type) AS match_count, row_number() OVER (
        PARTITION BY p_brand, p_type ORDER BY p_retailprice DESC, p_partkey DESC) AS rn FROM part) WHERE rn = 1""",
)
def reduce_dimension(src: Source) -> DataFrame:
    order = [("p_retailprice", "desc"), ("p_partkey", "desc")]
    return lookup.reduce_dimension(src.part, ["p_brand", "p_type"], order)


def customer_suppliers(src: Source) -> DataFrame:
    """Customers looking for the active supplier of the nation three numbers on (the last three have none)."""
    suppliers = src.supplier.withColumn("is_active", F.col("s_acctbal") > 0)
    order = [("is_active", "desc"), ("s_suppkey", "asc")]
    reduced = lookup.reduce_dimension(suppliers, ["s_nationkey"], order, "provider_match_count")
    wanting = src.customer.withColumn("wanted_nation", F.col("c_nationkey") + 3)
    return lookup.lookup(wanting, reduced, {"wanted_nation": "s_nationkey"}, "provider_match_count", "provider")


_SUPPLIERS = """reduced AS (SELECT * FROM (SELECT *, s_acctbal > 0 AS is_active,
    count(*) OVER (PARTITION BY s_nationkey) AS n,
    row_number() OVER (PARTITION BY s_nationkey ORDER BY (s_acctbal > 0) DESC, s_suppkey) AS rn FROM supplier) WHERE rn = 1),
  customer_suppliers AS (SELECT c_custkey, s_suppkey, s_name, is_active, coalesce(n, 0) AS provider_match_count,
    coalesce(n, 0) > 0 AS provider_exists, coalesce(n, 0) > 1 AS provider_ambiguous
    FROM customer LEFT JOIN reduced ON c_nationkey + 3 = s_nationkey)"""


@query("lookup_ambiguous", f"WITH {_SUPPLIERS} SELECT * FROM customer_suppliers")
def lookup_ambiguous(src: Source) -> DataFrame:
    return customer_suppliers(src).select(
        "c_custkey", "s_suppkey", "s_name", "is_active", "provider_match_count", "provider_exists", "provider_ambiguous"
    )


def order_customers(src: Source) -> DataFrame:
    """Orders looking up the customer a hundred numbers on (the last hundred have none)."""
    reduced = lookup.reduce_dimension(src.customer, ["c_custkey"], [("c_name", "asc")], "member_match_count")
    wanting = src.orders.withColumn("wanted_customer", F.col("o_custkey") + 100)
    return lookup.lookup(wanting, reduced, {"wanted_customer": "c_custkey"}, "member_match_count", "member")


_CUSTOMERS = """order_customers AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice, o_orderdate, c_custkey,
    c_name, c_nationkey, c_mktsegment, c_acctbal, c_custkey IS NOT NULL AS member_exists
    FROM orders LEFT JOIN customer ON o_custkey + 100 = c_custkey)"""


@query(
    "lookup_unique",
    f"WITH {_CUSTOMERS} SELECT o_orderkey, o_custkey, c_name, c_mktsegment, member_exists FROM order_customers",
)
def lookup_unique(src: Source) -> DataFrame:
    return order_customers(src).select("o_orderkey", "o_custkey", "c_name", "c_mktsegment", "member_exists")


PAIRS = [
    ("nation_match", "order_nation", "c_nationkey", 25),
    ("segment_match", "order_segment", "c_mktsegment", 35),
    ("name_match", "order_name", "c_name", 40),
]


def scored(src: Source) -> DataFrame:
    """Each order guesses its customer's nation, segment and name, right for some keys."""
    k = F.col("o_orderkey")
    guessed = order_customers(src).withColumns(
        {
            "order_nation": (k % 25).cast("int"),
            "order_segment": F.when(k % 2 == 0, "BUILDING").otherwise("MACHINERY"),
            "order_name": F.when(
                k % 3 != 0, F.concat(F.lit("Customer#"), F.lpad(F.col("wanted_customer").cast("string"), 9, "0"))
            ),
        }
    )
    return lookup.match_score(guessed, PAIRS, "member_exists")


_SCORED = f"""{_CUSTOMERS}, flags AS (SELECT *, coalesce(o_orderkey % 25 = c_nationkey, false) AS nation_match,
    coalesce(CASE WHEN o_orderkey % 2 = 0 THEN 'BUILDING' ELSE 'MACHINERY' END = c_mktsegment, false) AS segment_match,
    coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN 'Customer#' || lpad(CAST(o_custkey + 100 AS STRING), 9, '0') END = c_name,
      false) AS name_match FROM order_customers),
  scored AS (SELECT *, (CAST(nation_match AS INT) * 25 + CAST(segment_match AS INT) * 35 + CAST(name_match AS INT) * 40)
    / 100.0 AS entity_match_confidence FROM flags)"""


@query(
    "match_score",
    f"""WITH {_SCORED} SELECT o_orderkey, nation_match, segment_match, name_match,
      CAST(entity_match_confidence AS DOUBLE) AS entity_match_confidence FROM scored""",
)
def match_score(src: Source) -> DataFrame:
    return scored(src).select(
        "o_orderkey", "nation_match", "segment_match", "name_match", "entity_match_confidence"
    )


@query(
    "active_on",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, count(*) AS copies,
      coalesce(bool_or(o_orderstatus = 'F' AND CAST(l_shipdate AS DATE) BETWEEN CAST(o_orderdate AS DATE)
        AND CAST(o_orderdate AS DATE) + 60), false) AS active
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
)
def active_on(src: Source) -> DataFrame:
    reduced = lookup.reduce_dimension(
        src.orders.select(
            "o_orderkey",
            "o_orderstatus",
            F.to_date("o_orderdate").alias("opens"),
            F.date_add(F.to_date("o_orderdate"), 60).alias("closes"),
        ),
        ["o_orderkey"],
        [("opens", "desc")],
        "order_match_count",
    )
    lines = src.lineitem.withColumn("ship_day", F.to_date("l_shipdate"))
    found = lookup.lookup(lines, reduced, {"l_orderkey": "o_orderkey"}, "order_match_count", "order")
    flagged = rules.flag_active(found, "ship_day", "opens", "closes", "o_orderstatus", "active", wanted="F")
    return flagged.groupBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate").agg(
        F.count(F.lit(1)).alias("copies"), F.bool_or("active").alias("active")
    )


@query(
    "reference_errors",
    f"""WITH {_SUPPLIERS}, {_SCORED}, resolved AS (SELECT s.*, coalesce(cs.is_active, false) AS provider_active,
        coalesce(cs.provider_match_count, 0) AS pn,
        coalesce(cs.provider_exists, false) AS px, s.c_acctbal IS NOT NULL AS qx,
        s.c_acctbal > 0 AND s.o_orderpriority <> '5-LOW' AS qa
      FROM scored s LEFT JOIN customer_suppliers cs ON s.o_custkey = cs.c_custkey)
    SELECT o_orderkey, concat_ws('|', CASE WHEN NOT qx THEN 'POLICY_NOT_FOUND' END,
      CASE WHEN qx AND NOT coalesce(qa, false) THEN 'POLICY_INACTIVE_ON_SERVICE_DATE' END,
      CASE WHEN NOT member_exists THEN 'MEMBER_NOT_FOUND' END,
      CASE WHEN member_exists AND entity_match_confidence < 1 THEN 'MEMBER_IDENTITY_MISMATCH' END,
      CASE WHEN NOT px THEN 'PROVIDER_NOT_FOUND' END, CASE WHEN pn > 1 THEN 'PROVIDER_AMBIGUOUS' END,
      CASE WHEN px AND NOT provider_active THEN 'PROVIDER_INACTIVE' END) AS reference_enrichment_errors FROM resolved""",
)
def reference_errors(src: Source) -> DataFrame:
    providers = customer_suppliers(src).select(
        F.col("c_custkey").alias("o_custkey"),
        "provider_exists",
        "provider_ambiguous",
        F.coalesce("is_active", F.lit(False)).alias("provider_active"),
    )
    no = F.lit(False)
    resolved = lookup.attach(
        scored(src), providers, ["o_custkey"], {"provider_exists": no, "provider_ambiguous": no, "provider_active": no}
    ).withColumns(
        {
            "policy_exists": F.col("member_exists"),
            "policy_ambiguous": no,
            "policy_active_on_service_date": F.coalesce(
                (F.col("c_acctbal") > 0) & (F.col("o_orderpriority") != "5-LOW"), no
            ),
        }
    )
    checked = rules.validate(resolved, lookup.reference_rules(), "reference_enrichment_errors")
    return checked.select(
        "o_orderkey", F.array_join("reference_enrichment_errors", "|").alias("reference_enrichment_errors")
    )
