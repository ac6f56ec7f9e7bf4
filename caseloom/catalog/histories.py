"""Trailing history of orders, and near-duplicates with and without heavy keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.catalog import Source, query
from caseloom.operators import history, scoring
from caseloom.operators.trailing_state import TrailingState
from caseloom.sources.lineage import cut, new_path

NAMES = (
    "prior_claim_count_365d",
    "prior_claim_amount_365d",
    "most_recent_prior_service_date",
    "historical_average_claim_amount",
)


def dated_orders(src: Source) -> DataFrame:
    return src.orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        "o_orderstatus",
        F.to_date("o_orderdate").alias("day"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )


def _with_metrics(src: Source) -> DataFrame:
    orders = dated_orders(src)
    return history.trailing_metrics(orders, orders, ["o_custkey"], "day", "day", "amount", NAMES)


_ORDERS = """d AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) AS day,
    CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders)"""
_METRICS = f"""{_ORDERS}, metrics AS (SELECT c.o_orderkey, c.o_custkey, c.amount, count(h.o_orderkey) AS n,
    CAST(coalesce(sum(h.amount), 0) AS DECIMAL(18,2)) AS total, max(h.day) AS last_day,
    CAST(sum(h.amount) AS DOUBLE) / nullif(count(h.amount), 0) AS mean
    FROM d c LEFT JOIN d h ON c.o_custkey = h.o_custkey AND h.day < c.day AND h.day >= c.day - 365
    GROUP BY ALL)"""


_METRICS_SQL = f"""WITH {_METRICS} SELECT o_orderkey, n AS prior_claim_count_365d, total AS prior_claim_amount_365d,
      last_day AS most_recent_prior_service_date, round(mean, 6) AS historical_average_claim_amount FROM metrics"""


def _rounded(df: DataFrame) -> DataFrame:
    count, total, last, mean = NAMES
    return df.select("o_orderkey", count, total, last, F.round(mean, 6).alias(mean))


@query("trailing_metrics", _METRICS_SQL)
def trailing_metrics(src: Source) -> DataFrame:
    return _rounded(_with_metrics(src))


@query("trailing_state", _METRICS_SQL)
def trailing_state(src: Source) -> DataFrame:
    """The same from totals by day, into which the orders came in four batches, one of them late and twice."""
    orders = dated_orders(src)
    state = TrailingState(src.spark, new_path(src.spark, "trailing_state"), orders.select("o_custkey").schema)
    year = F.year("day")
    late = F.col("o_orderkey") % 10 == 0
    batches = {"late": late, "early": ~late & (year < 1997), "middle": ~late & year.between(1997, 1998), "rest": ~late & (year > 1998)}
    for name in ("early", "middle", "late", "rest", "late"):
        state.merge(orders.where(batches[name]), name, "day", "amount")
    return _rounded(state.metrics(orders, "day", NAMES))


def _same_part(src: Source) -> DataFrame:
    lines = src.lineitem.select("l_orderkey", "l_partkey", F.to_date("l_shipdate").alias("day"), "l_extendedprice")
    counted = history.trailing_metrics(lines, lines, ["l_partkey"], "day", "day", "l_extendedprice")
    return counted.groupBy("l_orderkey").agg(F.sum("prior_count").alias("same_procedure_claim_count_365d"))


_SAME = """same AS (SELECT c.l_orderkey, count(h.l_orderkey) AS same_procedure_claim_count_365d
    FROM lineitem c LEFT JOIN lineitem h ON c.l_partkey = h.l_partkey
      AND CAST(h.l_shipdate AS DATE) < CAST(c.l_shipdate AS DATE)
      AND CAST(h.l_shipdate AS DATE) >= CAST(c.l_shipdate AS DATE) - 365 GROUP BY c.l_orderkey)"""


@query("same_key_history", f"WITH {_SAME} SELECT * FROM same")
def same_key_history(src: Source) -> DataFrame:
    return _same_part(src)


_LINES = """l AS (SELECT DISTINCT l_orderkey, l_partkey, CAST(l_shipdate AS DATE) AS day FROM lineitem)"""


@query(
    "same_key_distinct_history",
    f"""WITH {_LINES} SELECT c.l_orderkey, c.l_partkey, c.day, count(DISTINCT h.l_orderkey) AS prior_orders
    FROM l c LEFT JOIN l h ON c.l_partkey = h.l_partkey AND h.day < c.day AND h.day >= c.day - 365 GROUP BY ALL""",
)
def same_key_distinct_history(src: Source) -> DataFrame:
    """Distinct orders, not lines, that had the part in the year before."""
    lines = src.lineitem.select("l_orderkey", "l_partkey", F.to_date("l_shipdate").alias("day")).distinct()
    return history.trailing_distinct(lines, lines, ["l_partkey"], "day", "day", "l_orderkey", "prior_orders")


@query(
    "distinct_prior_orders",
    """WITH c AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders),
      h AS (SELECT o_custkey, o_orderkey % 1000 AS id, CAST(o_orderdate AS DATE) AS day FROM orders),
      k AS (SELECT o_orderkey, o_custkey + i AS o_custkey, day FROM c, range(0, 2) r(i))
    SELECT k.o_orderkey, count(DISTINCT h.id) AS prior_ids FROM k JOIN h ON k.o_custkey = h.o_custkey
      AND h.day < k.day AND h.day >= k.day - 365 GROUP BY k.o_orderkey""",
)
def distinct_prior_orders(src: Source) -> DataFrame:
    """Ids that recur under many keys count once for an order that asks for two keys."""
    orders = src.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    past = orders.select("o_custkey", (F.col("o_orderkey") % 1000).alias("id"), "day")
    lines = orders.withColumn("o_custkey", F.explode(F.array(F.col("o_custkey"), F.col("o_custkey") + 1)))
    found = history.distinct_counts(lines, past, ["o_custkey"], ("o_orderkey", "day"), ("id", "day"), "prior_ids")
    return found.where("prior_ids > 0")


def _near(src: Source) -> DataFrame:
    orders = dated_orders(src)
    ids = ("o_orderkey", "day", "amount")
    return history.near_duplicate_counts(
        orders, orders, ["o_custkey", "o_orderpriority"], ids, ids, days=90, tolerance="0.25", between=cut
    )


_NEAR = """near AS (SELECT c.o_orderkey, count(DISTINCT h.o_orderkey) AS candidate_duplicate_count
    FROM d c JOIN d h ON c.o_custkey = h.o_custkey AND c.o_orderpriority = h.o_orderpriority
      AND abs(h.day - c.day) <= 90 AND abs(h.amount - c.amount) <= c.amount * 0.25 AND h.o_orderkey <> c.o_orderkey
    GROUP BY c.o_orderkey)"""


@query("near_duplicates", f"WITH {_ORDERS}, {_NEAR} SELECT * FROM near")
def near_duplicates(src: Source) -> DataFrame:
    return _near(src)


@query(
    "near_duplicates_heavy",
    """WITH e AS (SELECT event_id, event_type, CAST(ts AS DATE) AS day, CAST(value AS DECIMAL(18,2)) AS amount FROM events)
    SELECT c.event_id, count(*) AS candidate_duplicate_count FROM e c JOIN e h ON c.event_type = h.event_type
      AND abs(h.day - c.day) <= 3 AND abs(h.amount - c.amount) <= c.amount * 0.05 AND h.event_id <> c.event_id
    GROUP BY c.event_id""",
)
def near_duplicates_heavy(src: Source) -> DataFrame:
    """A handful of keys hold all events."""
    events = src.events.select(
        "event_id", "event_type", F.to_date("ts").alias("day"), F.col("value").cast("decimal(18,2)").alias("amount")
    )
    ids = ("event_id", "day", "amount")
    return history.near_duplicate_counts(events, events, ["event_type"], ids, ids, days=3, between=cut)


@query(
    "top_n_evidence",
    f"""WITH {_ORDERS}, ranked AS (SELECT c.o_orderkey, h.o_orderkey AS prior, h.day, h.amount, row_number() OVER (
        PARTITION BY c.o_orderkey ORDER BY h.day DESC, h.o_orderkey) AS rn FROM d c JOIN d h ON c.o_custkey = h.o_custkey
        AND h.day < c.day AND h.day >= c.day - 365)
    SELECT d.o_orderkey, coalesce(string_agg(CAST(prior AS STRING) || ':' || CAST(r.day AS STRING) || ':' ||
      CAST(r.amount AS STRING), '|' ORDER BY rn), '') AS historical_evidence
    FROM d LEFT JOIN ranked r ON d.o_orderkey = r.o_orderkey AND rn <= 5 GROUP BY d.o_orderkey""",
)
def top_n_evidence(src: Source) -> DataFrame:
    orders = dated_orders(src)
    out = history.recent_evidence(orders, orders, ["o_custkey"], "day", "day", "o_orderkey", ["amount"])
    text = F.transform(
        "historical_evidence",
        lambda x: F.concat_ws(
            ":", x["o_orderkey"].cast("string"), x["day"].cast("string"), x["amount"].cast("string")
        ),
    )
    return out.select("o_orderkey", F.array_join(text, "|").alias("historical_evidence"))


@query(
    "risk_score",
    f"""WITH {_METRICS}, {_SAME}, {_NEAR} SELECT m.o_orderkey,
      coalesce(candidate_duplicate_count, 0) > 0 AS duplicate_claim_flag,
      least(100, CASE WHEN coalesce(candidate_duplicate_count, 0) > 0 THEN 50 ELSE 0 END
        + CASE WHEN n > 10 THEN 20 ELSE 0 END + CASE WHEN coalesce(same_procedure_claim_count_365d, 0) > 3 THEN 15 ELSE 0 END
        + CASE WHEN CAST(m.amount AS DOUBLE) > mean * 3 THEN 15 ELSE 0 END) AS fraud_risk_score
    FROM metrics m LEFT JOIN same ON m.o_orderkey = same.l_orderkey LEFT JOIN near ON m.o_orderkey = near.o_orderkey""",
)
def risk_score(src: Source) -> DataFrame:
    from caseloom.operators.lookup import attach

    zero = F.lit(0).cast("long")
    same = _same_part(src).withColumnRenamed("l_orderkey", "o_orderkey")
    joined = attach(_with_metrics(src), same, ["o_orderkey"], {"same_procedure_claim_count_365d": zero})
    joined = attach(joined, _near(src), ["o_orderkey"], {"candidate_duplicate_count": zero})
    flagged = joined.withColumn("duplicate_claim_flag", F.col("candidate_duplicate_count") > 0)
    scored = scoring.score(flagged, scoring.risk_rules("amount"), fv.RISK_CAP, "fraud_risk_score")
    return scored.select("o_orderkey", "duplicate_claim_flag", "fraud_risk_score")
