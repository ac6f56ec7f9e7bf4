"""Queries and inner parts held against plain recomputations, and the ways beyond a broadcast."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from caseloom.llm import decontaminate, embedding_links, line_dedup, near_duplicates, quality, shared, token_files, words
from tokenizers import Tokenizer

FOLDER = "/root/testdata/sf0.001"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


# --- op1 -----------------------------------------------------------------------------------
def test_op1_query_and_the_text_left(spark, tmp_path):
    """The registered query on a table of its own, and what is left of each text, line by line."""
    rng = random.Random(3)
    base = [prose(rng, 20) for _ in range(6)]
    rows = []
    for i in range(40):
        lines = [rng.choice(base) for _ in range(rng.randrange(4))] + [prose(rng, 12)]
        lines += [" ".join([*rng.choice(base).split()[:19], f"new{i}"]), "", "one two"]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), "x"))
    rows += [(40, None, "x"), (41, "", None), rows[0]]
    spark.createDataFrame(rows, "doc_id long, text string, removed string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    sets = [(i, n, frozenset(re.findall(r"\w+", x.lower()))) for i, t, _ in rows[:-1] for n, x in enumerate((t or "").split("\n"))]
    gone = {}
    for k, (i, n, s) in enumerate(sets):
        if s and any(o and len(s & o) >= 0.8 * len(s | o) - 1e-12 for _, _, o in sets[:k]):
            gone.setdefault(i, []).append(n)
    got = line_dedup.op1_line_dedup(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["removed"] for r in got} == {i: ",".join(map(str, gone.get(i, []))) for i, _, _ in rows}
    assert all(r["n_removed"] == len(gone.get(r["doc_id"], [])) for r in got) and sum(map(len, gone.values())) > 50
    left = line_dedup.drop_repeated_lines(spark.read.parquet(f"{tmp_path}/documents.parquet")).collect()
    keep = lambda i, t: None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get(i, []))
    assert sorted((r["doc_id"], r["text"] or "") for r in left) == sorted((i, keep(i, t) or "") for i, t, _ in rows)


# --- op2 -----------------------------------------------------------------------------------
def test_a_hash_is_sent_only_where_a_fitting_partition_takes_it(spark):
    rng = random.Random(6)
    items = [(1, "tiny"), (2, prose(rng, 30)), (3, prose(rng, 300))]
    sketched = decontaminate.item_sketches(spark.createDataFrame(items, "id int, text string"), "id", "text", 0.8, 5)
    rows = sketched.collect()
    sketches = sketched.selectExpr("size_class", "explode(sketch) AS h")
    takes = decontaminate.size_partitions(sketches, 0.8)
    assert [t[0] for t in takes] == sorted(math.ceil(0.8 * 2 ** r["size_class"]) for r in rows)
    cuts = {r["size_class"]: max(np.array(r["sketch"]).view(np.uint64)) for r in rows}
    by_size = [cuts[c] for c in sorted(cuts)]
    assert [t[1] for t in takes] == by_size
    tried = np.array([h for r in rows for h in r["hashes"]], np.int64).view(np.uint64)
    for size in (1, 20, 1000):
        sent = decontaminate.taken(takes, np.full(len(tried), size), tried)
        fit = [(cut, found) for least, cut, found in takes if least <= size]
        assert sent.tolist() == [any(h <= cut and shared.in_bitmap(found, np.array([h]))[0] for cut, found in fit) for h in tried]
    # the one hash of the tiny item lets no other hash through above the cut-off of its own partition
    large = decontaminate.taken(takes[1:], np.full(len(tried), 1000), tried)
    above = tried > max(by_size[1:])
    assert not large[above].any()
    noise = np.random.default_rng(1).integers(0, 2**63, 20_000, dtype=np.uint64) * np.uint64(2)
    assert decontaminate.taken(takes, np.full(len(noise), 1000), noise).mean() < 0.1


def test_candidates_of_a_text_in_several_lists(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "LISTED", 3)
    rng = random.Random(8)
    text = prose(rng, 400).split()
    items = [(i, " ".join(text[7 * i : 7 * i + 30])) for i in range(40)] + [(99, prose(rng, 30))]
    docs = spark.createDataFrame([(1, " ".join(text)), (2, prose(rng, 100)), (3, " ".join(text[:60]))], "doc_id long, text string")
    got = {r["doc_id"]: r["items"] for r in decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    have = lambda words_: {tuple(words_[k : k + 5]) for k in range(len(words_) - 4)}
    short = [i for i, t in items if len(have(t.split()) & have(text[:60])) >= 0.8 * len(have(t.split())) - 1e-9]
    assert got == {1: list(range(40)), 2: [], 3: short}


# --- op7 -----------------------------------------------------------------------------------
def test_classes_and_kept_rows_of_near_duplicates(spark):
    rng = random.Random(2)
    a, b = prose(rng, 80), prose(rng, 50)
    near = " ".join([*a.split()[:-1], "changed"])
    rows = [(5, a), (3, a), (9, near), (4, b), (None, b), (7, None), (6, ""), (3, a)]
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    told = sorted(((r["doc_id"], r["class_id"], r["group_id"], r["kept"]) for r in got), key=repr)
    assert told == sorted(
        [(5, 3, 3, False), (3, 3, 3, True), (3, 3, 3, True), (9, 9, 3, False), (4, 4, 4, True), (None, 4, 4, False), (7, 6, 6, False), (6, 6, 6, True)],
        key=repr,
    )


@pytest.mark.parametrize("block, block_bytes", [(1024, 64 << 20), (3, 64 << 20), (1024, 4000)])
def test_buckets_are_compared_in_blocks_of_rows_and_bytes(spark, block, block_bytes):
    """Members of one bucket with lists from 1 to 3,000 shingles: the same links however they are dealt out."""
    rng = random.Random(block)
    texts = []
    for n in (5, 40, 40, 300, 3000):
        one = prose(rng, n).split()
        texts += [" ".join(one), " ".join([*one[:-1], "other"]), " ".join(one) + " more"]
    docs = spark.createDataFrame([(shared_key(t), t) for t in texts], "key binary, text string")
    features = shared.saved(near_duplicates.features(docs, 5))
    bands = docs.selectExpr("key", "array(7L, 8L) AS bands")
    members = docs.selectExpr("7L AS h", "key", "key AS root", f"{len(texts)}L AS n")
    found = near_duplicates.crossing(members, features, bands, 0.8, block, block_bytes).collect()
    parent = {shared_key(t): shared_key(t) for t in texts}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for r in found:
        parent[find(bytes(r["a"]))] = find(bytes(r["b"]))
    sides = {shared_key(t): words.weighted(*words.shingles(pa.array([t])), 1)[1:] for t in texts}
    keys = list(sides)
    wanted = {k: k for k in keys}

    def root(k):
        while wanted[k] != k:
            k = wanted[k]
        return k

    for i, x in enumerate(keys):
        for y in keys[:i]:
            if near_duplicates.probability_jaccard(sides[x], sides[y]) >= 0.8:
                wanted[root(x)] = root(y)
    assert {frozenset(k for k in keys if find(k) == find(x)) for x in keys} == {frozenset(k for k in keys if root(k) == root(x)) for x in keys}


def shared_key(text):
    import hashlib

    return hashlib.md5(text.encode()).digest()


# --- op8 -----------------------------------------------------------------------------------
def test_op8_query_on_the_given_table(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = sorted(spark.read.parquet(f"{FOLDER}/documents.parquet").collect(), key=lambda r: r["doc_id"])
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.op8_token_output(spark, FOLDER).collect()}
    start, wanted = 0, {}
    for r in docs:
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        wanted[r["doc_id"]] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert got == wanted


# --- op10 ----------------------------------------------------------------------------------
def buckets_of(text):
    """Each feature of a text, word by word, as the docstring of ``features`` has it."""
    split, out = (text or "").split(), Counter()
    told = [w for i, w in enumerate(split) for w in ([w, quality.AGAIN] if i and split[i - 1] == w else [w])]
    for w in told:
        out[int(pd.util.hash_array(np.array([w], dtype=object), categorize=False)[0] % np.uint64(quality.BUCKETS))] += 1
        marked = f"<{w}>"
        for n in quality.NGRAMS:
            for k in range(len(marked) - n + 1):
                total = np.array([n], np.uint64)
                for c in marked[k : k + n]:
                    total = words.mix(total) + np.uint64(ord(c))
                out[int(words.mix(total)[0] % np.uint64(quality.BUCKETS))] += 1
    return out


TEXTS = ["so so good, so good", "", None, "Ä a\tbb bb bb", "x", "tail. tail. end"]


def test_features_and_scores_recomputed():
    got = list(quality.document_features(pa.array(TEXTS, pa.string())))
    for text, (ids, share) in zip(TEXTS, got, strict=True):
        wanted = buckets_of(text)
        total = max(sum(wanted.values()), 1)
        assert dict(zip(ids.tolist(), share.tolist(), strict=True)) == pytest.approx({k: v / total for k, v in wanted.items()})
    rng = np.random.default_rng(0)
    model = quality.Model(rng.normal(size=quality.BUCKETS).astype(np.float32), 0.3)
    for text, score in zip(TEXTS, model.score(pa.array(TEXTS, pa.string())).tolist(), strict=True):
        found = buckets_of(text)
        pull = sum(float(model.pull[k]) * v for k, v in found.items()) / max(sum(found.values()), 1)
        assert score == pytest.approx(1 / (1 + math.exp(-pull - 0.3)))


def test_one_gradient_step_by_hand():
    """One document, one epoch: softmax over the mean vector, the step that the loss asks for."""
    ids, share = np.array([3, 11], np.int32), np.array([0.75, 0.25], np.float32)
    model = quality.train([(ids, share, 1)], dim=2, epochs=1, rate=0.2, seed=1)
    vectors = np.random.default_rng(1).uniform(-0.5, 0.5, (quality.BUCKETS, 2)).astype(np.float32)
    hidden = 0.75 * vectors[3] + 0.25 * vectors[11]
    out = np.outer([-0.5, 0.5], hidden) * 0.2  # both classes have chance one half, label 1 pulls, label 0 pushes
    pull = vectors @ (out[1] - out[0])  # the vectors stay, as the output was zero before the step
    assert model.pull[:50] == pytest.approx(pull[:50], abs=1e-6)
    assert model.bias == pytest.approx(0.1 * 0.2)


# --- beyond a broadcast --------------------------------------------------------------------
def test_results_without_any_broadcast(spark, monkeypatch):
    rng = random.Random(4)
    text = [prose(rng, 60) for _ in range(8)]
    rows = [(i, rng.choice(text) if i % 3 else prose(rng, 40) + " " + rng.choice(text)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame([(i, " ".join(t.split()[5:30])) for i, t in enumerate(text)], "item_id long, text string")
    vectors = np.random.default_rng(3).normal(size=(80, 4)).round(1)
    vectors = spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")

    def everything():
        found = [
            decontaminate.contaminated(docs, items),
            near_duplicates.near_duplicates(docs),
            embedding_links.embedding_links(vectors, threshold=0.9, most=10),
            line_dedup.repeated_lines(docs),
        ]
        return [sorted(map(repr, f.collect())) for f in found]

    small = everything()
    monkeypatch.setattr(shared, "BROADCAST_ROWS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert everything() == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
