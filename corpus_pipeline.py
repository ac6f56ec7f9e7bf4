"""From raw documents to token files: five stages, each on all that the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last
return the columns of ``documents``; the last returns one row per record of the
token files. Null texts count as empty; rows with null ids are rows like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caseloom.llm import decontaminate, mixing, near_duplicates, quality, token_files
from caseloom.llm.shared import delete, released, table
from caseloom.sources.lineage import new_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier rejects."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the one of the smallest id, of each group of near copies."""
    return near_duplicates.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the sources meet their target weights."""
    return mixing.repeat_to_mix(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the mix as token files and read back one row per record."""
    return token_files.token_output(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_output", token_stage),
]

#: neither a trained model nor a tokenizer can be said in SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written as Parquet in the shared folder and reread.

    What a stage has saved on its way goes when it is done, and its input when
    the stage after it has been written; ``shared.clear`` deletes the rest.
    """
    docs, read = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        with released(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if read:
            delete(spark, read)
        docs, read = spark.read.schema(docs.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
