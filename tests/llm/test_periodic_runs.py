"""Lyndon arrays and runs against brute force, and the query against its definition."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from caseloom.llm import periodic_runs as periodic


def runs_by_brute_force(words, shortest=6, periods=4):
    """Every period, every maximal stretch that keeps it; of equal stretches the one of the smallest period."""
    found = {}
    for q in range(1, len(words) // periods + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > start and i - start + q >= max(shortest, periods * q):
                found.setdefault((start, i - start + q), q)
            i += i == start
    return sorted((start, length, q) for (start, length), q in found.items())


def longest_lyndon(word):
    lyndon = lambda w: all(w < w[k:] for k in range(1, len(w)))
    return [max(n for n in range(1, len(word) - i + 1) if lyndon(word[i : i + n])) for i in range(len(word))]


def test_grouping_gives_lyndon_arrays():
    rng = random.Random(0)
    for _ in range(500):
        word = [rng.randint(1, rng.choice([1, 2, 3])) for _ in range(rng.randint(0, 14))]
        assert periodic.lyndon_lengths(np.array([0, *word, 0]))[1:-1].tolist() == longest_lyndon(word)


@pytest.mark.parametrize("shortest, periods", [(6, 4), (2, 2), (5, 3)])
def test_runs_equal_brute_force(shortest, periods):
    rng = random.Random(periods)
    for _ in range(700):
        texts = []
        for _ in range(rng.randint(0, 4)):
            n, k = rng.randint(0, 60), rng.choice([1, 2, 3, 9])
            word = [rng.randint(0, k) for _ in range(n)]
            if n and rng.random() < 0.6:
                a, p = rng.randrange(n), rng.randint(1, 6)
                word = [word[a + (i - a) % p] if i >= a and a + (i - a) % p < n else word[i] for i in range(n)]
            texts.append(word)
        of = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        found = periodic.runs_of_texts(of, np.array(sum(texts, []), np.int64), shortest, periods)
        wanted, before = [], 0
        for word in texts:
            wanted += [(s + before, n, q) for s, n, q in runs_by_brute_force(word, shortest, periods)]
            before += len(word)
        assert sorted(zip(*[x.tolist() for x in found], strict=True)) == wanted


def test_long_runs_take_linear_time():
    tiled = np.concatenate([[0], np.tile(np.arange(1, 30_001), 5), [0], np.ones(100_000, np.int64), [0]])
    found = [x.tolist() for x in periodic.runs_between(tiled)]
    assert found == [[1, 150_002], [150_000, 100_000], [30_000, 1]]


def by_definition(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = runs_by_brute_force(words)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    s, m, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), s, m, q, None if q is None else 1000 * m // q, sha(lines), sha(kept))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_equals_its_definition(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["a", "b", "c", "ä\x1c", "x\xa0y"], k=rng.randint(0, 70))), "de") for i in range(300)]
    rows += [(None, "a a a a a a a", None), (None, None, None), (301, None, "x"), (302, "", "x"), (303, " \n\t ", "x")]
    rows += [(304, "\x0ba b\x0ca b\ra b a  b c", "x"), (305, "x " * 9_000, "x"), (305, "x " * 9_000, "x"), (306, "q" * 100_000, "x")]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(4).write.parquet(f"{folder}/documents.parquet")
    got = [tuple(r[c] for c in COLUMNS) for r in periodic.op12_periodic_runs(spark, folder).collect()]
    assert sorted(map(repr, got)) == sorted(repr(by_definition(i, t)) for i, t, _ in rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert periodic.periodic_runs(docs.where("false")).count() == 0
    assert periodic.periodic_runs(docs.select("text")).count() == len(rows)


def test_spans_and_text_of_the_operator(spark):
    docs = spark.createDataFrame([("say " + "la " * 8 + "now", 1, 2)], "text string, runs int, collapsed int")
    (row,) = periodic.periodic_runs(docs).collect()
    assert row["row"].asDict() == {"runs": 1, "collapsed": 2}
    assert [tuple(r) for r in row["runs"]] == [(1, 8, 1)]
    assert row["collapsed"] == "say la now"


def test_query_on_the_given_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in periodic.op12_periodic_runs(spark, folder).collect()}
    short = [d for d in docs if len(d["text"]) < 9_000]
    assert len(short) > 100 and len(got) == len(docs)
    assert [got[d["doc_id"]] for d in short] == [by_definition(d["doc_id"], d["text"]) for d in short]
