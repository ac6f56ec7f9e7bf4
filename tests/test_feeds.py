"""Feeds read by split hold the same records as those read by one task a file."""

import random

import pytest
from pyspark.sql import functions as F

from caseloom.sources import feeds, tables

COLUMNS = ["a", "b c", "d"]


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150b")
    spark.conf.set("spark.sql.files.openCostInBytes", "10b")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows(df):
    return sorted(map(repr, df.select(*COLUMNS, "record_hash", F.regexp_extract("source_file", "[^/]*$", 0)).collect()))


def field(rng):
    text = "".join(rng.choices(['"', "\n", ",", "a", "é", " ", "x" * 40, "\r\n", "007", "\t"], k=rng.choice([0, 0, 1, 2, 5])))
    needs = any(c in text for c in '"\n\r,') or text != text.strip()
    return '"' + text.replace('"', '""') + '"' if needs or rng.random() < 0.2 else text


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_equal_those_of_one_task(spark, tmp_path, small_splits, end):
    """Line breaks, quotes and separators in fields, blank lines, short records, records over many splits, several files."""
    rng = random.Random(end)
    for n in range(4):
        lines = [",".join(field(rng) for _ in range(3)) for _ in range(120)]
        lines += ["", "only", '"",""', "1,2,3,4", f'"{"long" * 300}\n\n{"text" * 300}",x,y']
        rng.shuffle(lines)
        lines.append("last,one,here")
        (tmp_path / f"f{n}.csv").write_bytes((end.join(["a,b c,d", *lines]) + ("" if n % 2 else end)).encode())
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("a,b c,d\n")
    got, wanted = feeds.read_feed(spark, str(tmp_path), COLUMNS), tables.read_raw(spark, str(tmp_path), COLUMNS)
    assert feeds._lines(spark, str(tmp_path)).select("source_file", "start").distinct().count() > 40
    assert feeds._splits_within_quotes(feeds._lines(spark, str(tmp_path)))
    assert got.columns == wanted.columns
    a, b = rows(got), rows(wanted)
    assert (len(a), [x for x in a if x not in b][:5], [x for x in b if x not in a][:5]) == (len(b), [], [])


def test_an_unclosed_quote_runs_to_the_end(spark, tmp_path, small_splits):
    (tmp_path / "f.csv").write_text('a,b c,d\n1,2,3\n4,"5,6\n' + "7,8,9\n" * 100)
    got = feeds.read_feed(spark, str(tmp_path), COLUMNS).collect()
    assert [r["a"] for r in sorted(got, key=lambda r: r["a"])] == ["1", "4"]


def test_whole_records_are_not_shuffled(spark, tmp_path, small_splits):
    (tmp_path / "f.csv").write_text("a,b c,d\n" + "".join(f'{i},"x\ny",z\n' for i in range(200)))
    lines = feeds._lines(spark, str(tmp_path))
    pieces = feeds._pieces(lines, feeds._splits_within_quotes(lines))
    counts = {r["kind"]: r["count"] for r in pieces.groupBy("kind").count().collect()}
    assert counts["whole"] > 180 and sum(n for k, n in counts.items() if k != "whole") <= 40
    assert feeds.read_feed(spark, str(tmp_path), COLUMNS).count() == 200
