"""Inner parts of the line join: how lines are taken apart, told apart and compared."""

import random

import numpy as np
import pyarrow as pa
from caseloom.llm import line_dedup, words
from pyspark.sql import functions as F


def test_words_of_lines_by_hash_and_by_rarity():
    rng = np.random.default_rng(0)
    lines = ["", "a b a", "Hello, WORLD hello", "ÜBER über-ß x1y2", "  ", "don't --- stop", "z" * 200 + " " + "z" * 199, "éa É b\tc 123 ½"]
    for rank in (None, rng.permutation(1 << line_dedup.RARITY_BITS).astype(np.uint32)):
        line, hashes, size = line_dedup.word_sets(pa.array(lines), rank)
        for k, text in enumerate(lines):
            found = words.flat_words(pa.array([text]))[1]
            got = hashes[line == k]
            assert len(got) == size[k] and sorted(got.tolist()) == sorted(set(line_dedup._hashed(found).tolist()))
            order = got if rank is None else line_dedup._by_rarity(got, rank)
            assert order.tolist() == sorted(order.tolist())


def test_tallies_are_no_further_apart_than_lines():
    rng = np.random.default_rng(1)
    for n in (64, 100, 300):
        a = rng.choice(2**62, n, replace=False).astype(np.uint64)
        for changed in (0, 3, 20):
            b = np.concatenate([a[changed:], rng.choice(2**62, changed, replace=False).astype(np.uint64)])
            both = line_dedup.tallies(np.repeat([0, 1], n), np.concatenate([a, b]), np.array([n, n]))
            assert line_dedup._apart(both[:1], both[1:])[0] <= 2 * changed
    a, b = (line_dedup.tallies(np.zeros(150, int), rng.choice(2**62, 150).astype(np.uint64), np.array([150])) for _ in range(2))
    assert line_dedup._apart(a, b)[0] > 33  # two lines of 150 words that match differ in no more


def test_shared_words_by_matrix_in_slices(monkeypatch):
    monkeypatch.setattr(line_dedup, "WIDE", 7)
    rng = np.random.default_rng(2)
    lists = [rng.choice(50, rng.integers(3, 30), replace=False).astype(np.uint64) for _ in range(30)]
    place = np.array([rng.integers(0, len(x)) for x in lists])
    common, before = line_dedup._shared(lists, place, 10**9)
    for x in range(30):
        for y in set(range(30)) - {x}:
            assert common[x, y] == len(set(lists[x]) & set(lists[y]))
            assert before[x, y] == len(set(lists[x][: place[x]]) & set(lists[y][: place[y]]))
    assert line_dedup._shared(lists, place, 10) is None


def test_near_copies_meet_at_few_words_and_few_unlike_long_lines_do(spark):
    rng = random.Random(5)
    word = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(n))
    base = word(60)
    common = word(60).split()
    unlike = [" ".join(rng.sample(common, 4) + word(150).split()) for _ in range(40)]
    lines = [base, base + " last", *unlike]
    documents = line_dedup._documents(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), "doc_id", "text")
    rank = line_dedup._ranks(np.arange(1 << line_dedup.RARITY_BITS, dtype=np.uint32))
    found = line_dedup.active_entries(line_dedup.prefixes(documents, rank, 0.8), 0.8).groupBy("c1").count().collect()
    # the filters let some unlike lines pass, which are compared whole; the two near copies share 13 of their rarest words and are compared at one or two, next to a word that one lacks
    assert 2 <= len(found) < 20 and all(r["count"] <= 2 for r in found)


def test_links_by_sets_and_by_matrices_are_the_same(spark, monkeypatch):
    rng = random.Random(6)
    base = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(40)]
    lines = [" ".join([*base[:k], f"new{n}", *base[k + 1 :]]) for n in range(3) for k in range(20)]
    documents = line_dedup._documents(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), "doc_id", "text")
    found, rarity = line_dedup.occurrences(documents)
    firsts = found.groupBy("c1", "c2").agg(F.min(F.struct("id", "tie", "line_no")).alias("first"))

    def links(few):
        monkeypatch.setattr(line_dedup, "FEW", few)
        got = line_dedup.line_links(documents, firsts, rarity, 0.8, 16).join(firsts, ["c1", "c2"]).collect()
        return {r["first"]["id"]: (r["links"], r["other"]["id"]) for r in got}

    sets = [set(x.split()) for x in lines]
    like = [[o for o, t in enumerate(sets) if t != s and len(s & t) >= 0.8 * len(s | t)] for s in sets]
    wanted = {k: (len(o), o[0]) for k, o in enumerate(like) if o}
    assert links(1) == links(10**9) == wanted and wanted
