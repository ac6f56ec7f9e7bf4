"""Read raw, reference and stage tables; write stages and cases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.sources.lineage import shuffles_freed
from caseloom.sources.schemas import all_strings

ARRAY_MARK = "|"
ABSENT = "\u0000"
#: a null list in a text stage; an empty one is empty text
NULL_LIST = "\\N"
#: rows of one CSV file at most: a file whose fields may hold line breaks is read by one task
FILE_ROWS = 50_000


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of all fields; a null field keeps its place, so shifted fields differ."""
    return F.sha2(F.concat_ws("||", *[F.coalesce(F.col(c).cast("string"), F.lit(ABSENT)) for c in columns]), 256)


def _csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> DataFrame:
    reader = spark.read.schema(schema).option("header", True).option("escape", '"')
    return reader.option("multiLine", multiline).csv(path)


def read_raw(spark: SparkSession, path: str, columns: Sequence[str], multiline: bool = True) -> DataFrame:
    """Header CSV with every field as text, plus ingest time, source file and row hash.

    A multi-line file cannot be split, so its size bounds one task's work: land
    large feeds as many files, or as one line per record with ``multiline`` off.
    """
    raw = _csv(spark, path, all_strings(columns), multiline)
    return raw.select(
        "*",
        F.current_timestamp().alias("ingested_at"),
        F.col("_metadata.file_path").alias("source_file"),
        row_hash(columns).alias("record_hash"),
    )


def read_reference(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> DataFrame:
    """Header CSV under a declared schema; a value that does not fit becomes null."""
    raw = _csv(spark, path, all_strings(schema.fieldNames()), multiline)
    return raw.select(*[_from_text(f) for f in schema.fields])


def _from_text(field: T.StructField) -> Column:
    text, dtype = F.col(f"`{field.name}`"), field.dataType
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StringType):
        empty = text.isNull() | (text == "")
        listed = F.when(empty, F.array().cast(dtype)).otherwise(F.split(text, r"\|"))
        value = F.when(text.eqNullSafe(NULL_LIST), F.lit(None).cast(dtype)).otherwise(listed)
    elif isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        value = F.from_json(text, dtype)
    elif isinstance(dtype, T.StringType):
        value = text
    else:
        value = F.trim(text).try_cast(dtype)
    return value.alias(field.name)


def read_stage(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """A stage written by ``write_stage``; text formats need the schema back."""
    if fmt != "csv":
        reader = spark.read.schema(schema) if schema is not None and fmt == "json" else spark.read
        return reader.format(fmt).load(path)
    if schema is None:
        raise ValueError("a CSV stage can only be read with its schema")
    return read_reference(spark, path, schema)


def _as_text(df: DataFrame) -> DataFrame:
    """Array-of-text columns joined by ``|``, null ones marked, other nested columns as JSON."""
    flat: dict[str, Column] = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            flat[f.name] = F.coalesce(F.array_join(f.name, ARRAY_MARK), F.lit(NULL_LIST))
        elif isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            flat[f.name] = F.to_json(f.name)
    return df.withColumns(flat) if flat else df


def write_stage(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the whole stage folder; a CSV stage lands as many files, so that as many tasks read it back."""
    if fmt == "csv":
        # quotes doubled and blanks kept, so that text comes back as it was
        writer = _as_text(df).write.option("header", True).option("escape", '"').option("maxRecordsPerFile", FILE_ROWS)
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).mode("overwrite")
        with shuffles_freed(df.sparkSession):
            writer.csv(path)
    else:
        with shuffles_freed(df.sparkSession):
            df.write.mode("overwrite").format(fmt).save(path)


def with_run_times(df: DataFrame) -> DataFrame:
    now = F.current_timestamp()
    return df.withColumns({"created_at": now, "updated_at": now})


def write_case(df: DataFrame, path: str) -> None:
    """Final case table, stamped with its run time, as Parquet."""
    with shuffles_freed(df.sparkSession):
        with_run_times(df).write.mode("overwrite").parquet(path)


def write_case_json(df: DataFrame, path: str) -> None:
    """Readable copy for debugging."""
    with shuffles_freed(df.sparkSession):
        with_run_times(df).write.mode("overwrite").json(path)
