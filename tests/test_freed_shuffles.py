"""What a table that is written leaves on disk besides itself."""

import time

import pytest
from pyspark.sql import functions as F

from caseloom.sources import lineage, tables


def shuffle_files(spark):
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


WRITERS = {
    "cut": lambda df, path: lineage.cut(df, "freed"),
    "bucketed": lambda df, path: lineage.bucketed(["k"], 3)(df, "freed"),
    "stage": lambda df, path: tables.write_stage(df, path),
    "csv": lambda df, path: tables.write_stage(df, path, "csv"),
    "case": lambda df, path: tables.write_case(df, path),
}


@pytest.mark.parametrize("writer", WRITERS)
def test_shuffles_of_a_written_table_are_deleted(spark, tmp_path, writer):
    before = shuffle_files(spark)
    df = spark.range(2000).groupBy((F.col("id") % 700).alias("k")).agg(F.count("*").alias("n")).repartition(4, "n", "k")
    WRITERS[writer](df, str(tmp_path / "out"))
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert shuffle_files(spark) - before == set()


def test_tables_written_are_read_again_and_the_setting_is_as_it_was(spark):
    was = spark.conf.get(lineage.FREEING, None)
    df = spark.range(100).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n"))
    assert sorted(lineage.cut(df, "freed").collect()) == sorted(lineage.bucketed(["k"], 3)(df, "freed").collect()) == sorted(df.collect())
    assert spark.conf.get(lineage.FREEING, None) == was
