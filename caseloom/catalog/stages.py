"""Sources and sinks: given tables written to the shared folder and read back, and stages run one at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.catalog import Source, query
from caseloom.catalog.claims import CASE_BUILD_SQL, REFERENCES_SQL, case_build, claims_reference_columns
from caseloom.catalog.coverage import COVERED, rolled_up
from caseloom.catalog.world import OCR_DOCUMENTS, RAW, claim_world, derive, raw_orders
from caseloom.operators import audit
from caseloom.plans import claims
from caseloom.sources import feeds, stages, tables
from caseloom.sources.lineage import new_path
from caseloom.sources.schemas import OCR_COLUMNS

RAW_COLUMNS = ["o_orderkey", "order_date", "amount", "codes", "policy_number", "currency", "confidence", "flag", "ssn"]
_TEXT = ", ".join(f"nullif(CAST({c} AS STRING), '') AS {c}" for c in RAW_COLUMNS)
_HASHED = ", ".join(f"coalesce({c}, chr(0))" for c in RAW_COLUMNS)


@query(
    "raw_scan",
    f"""WITH {RAW}, t AS (SELECT {_TEXT} FROM raw)
    SELECT *, sha256(concat_ws('||', {_HASHED})) AS record_hash, true AS is_stamped FROM t""",
)
def raw_scan(src: Source) -> DataFrame:
    """A landed CSV feed, every field as text, with its row hash and ingest columns."""
    path = new_path(src.spark, "raw_scan")
    landed = raw_orders(src).select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS])
    tables.write_stage(landed, path, "csv")
    back = tables.read_raw(src.spark, path, RAW_COLUMNS)
    stamped = F.col("ingested_at").isNotNull() & F.col("source_file").contains("raw_scan")
    return back.select(*RAW_COLUMNS, "record_hash", stamped.alias("is_stamped"))


_FEED_SQL = f"""WITH {RAW}, t AS (SELECT {_TEXT} FROM raw)
    SELECT *, sha256(concat_ws('||', {_HASHED})) AS record_hash FROM t"""


@query("feed_scan", _FEED_SQL)
def feed_scan(src: Source) -> DataFrame:
    """The same feed, with breaks inside its fields, read by split."""
    path = new_path(src.spark, "feed_scan")
    landed = raw_orders(src).select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS])
    tables.write_stage(landed, path, "csv")
    return feeds.read_feed(src.spark, path, RAW_COLUMNS).select(*RAW_COLUMNS, "record_hash")


@query(
    "reference_scan",
    """SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment,
      DATE '1990-01-01' + CAST(c_custkey % 5000 AS INT) AS since, c_acctbal > 0 AS in_credit FROM customer""",
)
def reference_scan(src: Source) -> DataFrame:
    """A reference CSV under its declared schema."""
    typed = src.customer.select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"),
        "c_mktsegment",
        F.date_add(F.lit("1990-01-01").cast("date"), (F.col("c_custkey") % 5000).cast("int")).alias("since"),
        (F.col("c_acctbal") > 0).alias("in_credit"),
    )
    path = new_path(src.spark, "reference_scan")
    tables.write_stage(typed, path, "csv")
    return tables.read_reference(src.spark, path, typed.schema)


def _stage(src: Source, fmt: str) -> DataFrame:
    rolled = rolled_up(src).withColumn("few", F.when(F.size("covered_procedure_codes") > 0, F.col("covered_procedure_codes")))
    path = new_path(src.spark, f"stage_{fmt}")
    tables.write_stage(rolled, path, fmt)
    back = tables.read_stage(src.spark, path, fmt, None if fmt == "parquet" else rolled.schema)
    line = F.transform("coverage_evidence", lambda x: F.concat_ws(":", x["procedure_code"], x["estimated_eligible_amount"].cast("string")))
    return back.select(
        "o_orderkey",
        F.array_join("uncovered_procedure_codes", "|").alias("uncovered_procedure_codes"),
        F.col("few").isNull().alias("is_null_list"),
        F.array_join(line, "|").alias("evidence"),
        "estimated_eligible_amount",
        "all_procedures_have_coverage",
    )


_STAGE_SQL = f"""WITH {COVERED} SELECT o_orderkey,
      coalesce(string_agg(procedure_code, '|' ORDER BY procedure_code) FILTER (NOT found), '') AS uncovered_procedure_codes,
      count(*) FILTER (found) = 0 AS is_null_list,
      string_agg(concat_ws(':', procedure_code, CAST(eligible AS STRING)), '|' ORDER BY procedure_code) AS evidence,
      CAST(sum(eligible) AS DECIMAL(18,2)) AS estimated_eligible_amount,
      count(*) FILTER (NOT found) = 0 AND count(*) FILTER (found) > 0 AS all_procedures_have_coverage
    FROM covered GROUP BY o_orderkey"""


@query("stage_parquet", _STAGE_SQL)
def stage_parquet(src: Source) -> DataFrame:
    return _stage(src, "parquet")


@query("stage_csv", _STAGE_SQL)
def stage_csv(src: Source) -> DataFrame:
    """Lists, null lists and nested lines through text."""
    return _stage(src, "csv")


_SUNK = ("case_id", "o_orderkey", "member_id", "service_date", "billed_amount", "review_reasons", "is_stamped")


@query("case_sink", f"SELECT {', '.join(_SUNK[:-1])}, true AS is_stamped FROM ({CASE_BUILD_SQL})")
def case_sink(src: Source) -> DataFrame:
    path = new_path(src.spark, "case_sink")
    tables.write_case(case_build(src), path)
    stamped = F.col("created_at").isNotNull() & (F.col("created_at") == F.col("updated_at"))
    return src.spark.read.parquet(path).withColumn("is_stamped", stamped).select(*_SUNK)


@query("json_sink", f"SELECT {', '.join(_SUNK[:-1])}, true AS is_stamped FROM ({CASE_BUILD_SQL})")
def json_sink(src: Source) -> DataFrame:
    path = new_path(src.spark, "json_sink")
    built = case_build(src)
    tables.write_case_json(built, path)
    schema = built.schema.add("created_at", "timestamp").add("updated_at", "timestamp")
    stamped = F.col("created_at").isNotNull() & F.col("updated_at").isNotNull()
    return src.spark.read.schema(schema).json(path).withColumn("is_stamped", stamped).select(*_SUNK)


def _documents(src: Source) -> DataFrame:
    """The raw documents, made by evenly dealt tasks however the orders are filed: a task's rows are the files it lands."""
    return derive(src, OCR_DOCUMENTS, orders=src.orders.hint("rebalance", "o_orderkey")).select(*OCR_COLUMNS)


@query("stage_resume", REFERENCES_SQL)
def stage_resume(src: Source) -> DataFrame:
    """The second stage from what the first has left in the folder, which began at landed CSV."""
    world = claim_world(src)
    landed, folder = new_path(src.spark, "landed"), new_path(src.spark, "resume")
    tables.write_stage(_documents(src), landed, "csv")
    claims.run_stage(src.spark, "canonical_claims", folder, world, landed)
    claims.run_stage(src.spark, "reference_enriched_claims", folder, world)
    return claims_reference_columns(tables.read_stage(src.spark, f"{folder}/reference_enriched_claims"))


@query("stage_republish", REFERENCES_SQL)
def stage_republish(src: Source) -> DataFrame:
    """The first two stages published, then the second alone once more, after the policies that it reads have changed."""
    world, root = claim_world(src), new_path(src.spark, "republish")
    paths = {name: f"{root}/landed/{name}" for name in ("ocr_documents", "policy", "member", "provider")}
    for name, path in paths.items():
        landed = _documents(src) if name == "ocr_documents" else world[name]
        tables.write_stage(landed.withColumn("policy_status", F.lit("INACTIVE")) if name == "policy" else landed, path, "csv")
    upto = "reference_enriched_claims"
    claims.resume_stages(src.spark, f"{root}/stages", paths, upto)
    tables.write_stage(world["policy"], paths["policy"], "csv")
    claims.resume_stages(src.spark, f"{root}/stages", paths, upto)
    return claims_reference_columns(stages.read_published(src.spark, f"{root}/stages/{upto}"))


@query(
    "stage_counts",
    """SELECT unnest(['rows', 'open', 'urgent', 'expected', 'unexpected']) AS measure, unnest([count(*),
      count(*) FILTER (o_orderstatus = 'O'), count(*) FILTER (o_orderpriority = '1-URGENT'), count(*), 0]::BIGINT[]) AS value
    FROM orders""",
)
def stage_counts(src: Source) -> DataFrame:
    """Counts observed while a stage is written, and how many differ from those of the stage before."""
    seen, counts = audit.observe_counts(
        src.orders, "orders_stage", open=F.col("o_orderstatus") == "O", urgent=F.col("o_orderpriority") == "1-URGENT"
    )
    path = new_path(src.spark, "stage_counts")
    tables.write_stage(seen, path)
    found = counts.get
    expected = tables.read_stage(src.spark, path).count()
    found |= {"expected": expected, "unexpected": len(audit.audit_counts({"orders": found["rows"]}, {"orders": expected}))}
    return src.spark.createDataFrame(list(found.items()), "measure string, value long")
