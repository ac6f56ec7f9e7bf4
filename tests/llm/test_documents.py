"""The document operators against brute force, on a small table with every awkward case."""

import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from caseloom.llm import decontaminate, line_dedup, mixing, near_duplicates, quality, words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, id long, _key string, size int"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


def build():
    rng = random.Random(5)
    base = [prose(rng, n) for n in (40, 60, 80, 120)]
    texts = [*base, base[0], base[0].upper() + "!", base[1] + " tail", base[1].replace(" ", "  "), None, "", "", " .. \n", "word", "word"]
    edited = base[2].split()
    for i in range(12):  # near copies of one text, each edited elsewhere
        copy = list(edited)
        copy[6 * i] = f"edit{i}"
        texts.append(" ".join(copy))
    texts.append(" ".join(prose(rng, 30_000).split()))  # a very long text
    texts.append(base[3] + "\n" + base[0] + "\n" + base[3] + " more\n\n" + base[3])
    rows = [(i, t, "en", ["a", "b", None][i % 3], 0, "k", -i, "x", 7) for i, t in enumerate(texts)]
    rows.append(rows[0])  # a repeated row
    rows += [(None, base[0], None, None, None, None, None, None, None), (None, "no id", "en", "zz", 1, "k", 1, "x", 7)]
    rows.append((0, "another text under an id that is taken", "en", "a", 1, "k", 1, "x", 7))
    return rows


ROWS = build()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    _, h, w = words.weighted(*words.shingles(pa.array([text or ""], pa.string())), 1)
    return h, w


def test_shingles_are_of_five_words():
    a = words.shingles(pa.array(["a b c d e f", "A, b; c d E f", "a b", None, ""]))
    assert a[0].tolist() == [0, 0, 1, 1, 2]
    assert a[1][:2].tolist() == a[1][2:4].tolist()


def test_probability_jaccard_by_definition():
    rng = np.random.default_rng(3)
    for _ in range(20):
        a, b = ({int(x): int(rng.integers(1, 6)) for x in rng.choice(12, 7, replace=False)} for _ in range(2))
        wanted = sum(
            1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in a.keys() | b.keys()) for d in a.keys() & b.keys()
        )
        pair = [(np.array(sorted(x), np.uint64), np.array([x[k] for k in sorted(x)])) for x in (a, b)]
        assert abs(near_duplicates.probability_jaccard(*pair) - wanted) < 1e-12


def test_registers_estimate_the_similarity():
    a = {i: 1 + i % 3 for i in range(300)}
    b = {i: 1 + i % 3 for i in range(60, 330)}
    row = np.repeat([0, 1], [len(a), len(b)])
    hashes = words.mix(np.array([*a, *b], np.uint64))
    kept = near_duplicates.signatures(row, hashes, np.array([*a.values(), *b.values()]), 2, 2048)
    side = [(np.sort(hashes[row == r]), np.array([*x.values()])[np.argsort(hashes[row == r])]) for r, x in ((0, a), (1, b))]
    assert abs((kept[0] == kept[1]).mean() - near_duplicates.probability_jaccard(*side)) < 0.05


def test_near_duplicates_equal_brute_force(docs):
    got = near_duplicates.near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    classes = sorted({r[1] or "" for r in ROWS})
    parent = {t: t for t in classes}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    found = {t: shingles(t) for t in classes}
    for s, t in itertools.combinations(classes, 2):
        if near_duplicates.probability_jaccard(found[s], found[t]) >= 0.8:
            parent[find(s)] = find(t)
    wanted = {}
    for i, t, *_ in ROWS:
        wanted.setdefault(find(t or ""), set()).add((i, t or ""))
    groups = {}
    by_key = {hashlib.md5(t.encode()).digest(): t for t in classes}
    for x in got:
        groups.setdefault(bytes(x["group_key"]), set()).add((x["doc_id"], by_key[bytes(x["text_key"])]))
    assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in wanted.values()}
    for x in got:
        ids = [i for i, _ in groups[bytes(x["group_key"])] if i is not None]
        assert x["group_id"] == (min(ids) if ids else None)


def test_one_document_of_each_group_stays(docs, nothing):
    kept = near_duplicates.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    groups = near_duplicates.near_duplicates(docs).select("group_key").distinct().count()
    assert len(rows) == groups
    assert near_duplicates.drop_near_duplicates(nothing).count() == near_duplicates.near_duplicates(nothing).count() == 0


ITEMS = "item_id long, text string, key string"


def test_contamination_equals_brute_force(spark, docs, nothing):
    base = [r[1] for r in ROWS[:4]]
    cut = base[3].split()
    items = [
        (1, " ".join(cut[10:50])),
        (2, " ".join([*cut[10:48], "other", "words"])),
        (3, " ".join([*cut[10:30], *"all new and not in any of the texts at all here".split()])),
        (4, None),
        (5, ""),
        (6, "word"),
        (6, base[0]),
        (None, base[1]),
        (1, " ".join(cut[10:50])),
    ]
    table = spark.createDataFrame([(*i, "k") for i in items], ITEMS)
    wanted = []
    for i, t, *_ in ROWS:
        have = set(shingles(t)[0].tolist())
        hits = {(k, s) for k, s in items if (q := set(shingles(s)[0].tolist())) and len(q & have) >= 0.8 * len(q) - 1e-9}
        wanted.append((i, t, bool(hits), len(hits), sorted({k for k, _ in hits if k is not None})))
    got = decontaminate.contaminated(docs, table)
    rows = sorted(((x["doc_id"], x["contaminated"], x["n_items"], x["items"]) for x in got.collect()), key=repr)
    assert rows == sorted(((w[0], *w[2:]) for w in wanted), key=repr)
    assert any(w[2] for w in wanted) and not all(w[2] for w in wanted)
    left = decontaminate.drop_contaminated(docs, table)
    assert left.columns == docs.columns and left.count() == sum(not w[2] for w in wanted)
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.drop_contaminated(docs, none).count() == len(ROWS)
    assert decontaminate.contaminated(nothing, table).count() == 0


def test_line_dedup_equals_brute_force(docs, nothing):
    lines = {}
    for i, t, *_ in ROWS:
        lines[(i, t)] = [frozenset(words.flat_words(pa.array([x]))[1].to_pylist()) for x in (t or "").split("\n")]
    got = line_dedup.repeated_lines(docs).collect()
    assert len(got) == len(lines)
    cleaned = line_dedup.drop_repeated_lines(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == len(ROWS)
    # the order of rows that share an id is by a hash of the text: take it from the result
    text_of = {r["tie"]: r["text"] for r in line_dedup._documents(docs, "doc_id", "text").collect()}
    order = sorted(got, key=lambda r: (r["id"] is not None, r["id"] or 0, r["tie"]))
    flat = [(r["id"], r["tie"], n, s) for r in order for n, s in enumerate(lines[(r["id"], text_of[r["tie"]])])]
    gone = {}
    for k, (i, tie, n, s) in enumerate(flat):
        if s and any(o and len(s & o) / len(s | o) >= 0.8 - 1e-12 for *_, o in flat[:k]):
            gone.setdefault((i, tie), []).append(n)
    assert {(r["id"], r["tie"]): r["removed"] for r in got if r["n_removed"]} == gone
    assert gone
    assert line_dedup.repeated_lines(nothing).count() == 0


def test_entries_of_a_common_word_are_sifted_in_cells(spark):
    rng = random.Random(4)
    lines = [f"viewed {rng.randrange(300)} times by {rng.randrange(40)} on the page since monday" for _ in range(600)]
    documents = line_dedup._documents(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), "doc_id", "text")
    rank = line_dedup._ranks(line_dedup.occurrences(documents)[1])
    entries = line_dedup.prefixes(documents, rank, 0.8)
    heavy = line_dedup.heavy_words(documents, rank, 0.8, 32, 1)
    assert heavy.count() > 0
    cells = line_dedup._cells(entries, heavy)
    most = lambda df: max(r["count"] for r in df.dropDuplicates(["token", "cell", "c1"]).groupBy("token", "cell").count().collect())
    assert most(line_dedup._cells(entries, None)) > 200 and most(cells) < 130
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    got = rows(line_dedup.active_entries(entries, 0.8, heavy))
    assert got and got == rows(line_dedup.active_entries(entries, 0.8))


def test_links_of_lines_in_small_blocks(spark):
    rng = random.Random(9)
    base = prose(rng, 30).split()
    lines = [" ".join([*base[:k], f"new{k}", *base[k + 1 :]]) for k in range(30)] + [prose(rng, 20) for _ in range(20)]
    documents = line_dedup._documents(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), "doc_id", "text")
    found, rarity = line_dedup.occurrences(documents)
    firsts = found.groupBy("c1", "c2").agg(F.min(F.struct("id", "tie", "line_no")).alias("first"))
    sets = [set(x.split()) for x in lines]
    wanted = {i: sum(len(s & t) >= 0.8 * len(s | t) for t in sets) - 1 for i, s in enumerate(sets)}
    for block in (3, 1024):
        got = line_dedup.line_links(documents, firsts, rarity, 0.8, block).join(firsts, ["c1", "c2"])
        got = {r["first"]["id"]: r["links"] for r in got.collect()}
        assert got == {i: n for i, n in wanted.items() if n}


def test_mixing_meets_targets(docs, nothing):
    got = [r.asDict() for r in mixing.mixed(docs).collect()]
    assert len(got) == len(ROWS)
    total = sum(r["size"] for r in got)
    by = {}
    for r in got:
        by.setdefault(r["source"], []).append(r)
        assert r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"])
    order = sorted(by, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    sizes = {s: sum(r["size"] for r in rows) for s, rows in by.items()}
    aim, open_, left = {}, set(order), float(total)
    while True:  # the excess of full sources is shared again until none is above
        share = {s: left * weights[s] / sum(weights[o] for o in open_) for s in open_}
        full = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not full:
            aim |= share
            break
        for s in full:
            aim[s] = 3.0 * sizes[s]
            left -= aim[s]
        open_ -= full
    for s, rows in by.items():
        assert rows[0]["source_size"] == sizes[s]
        assert abs(rows[0]["target"] - aim[s]) < 1e-6
        assert abs(sum(r["taken"] for r in rows) - aim[s]) <= max(r["size"] for r in rows)
    again = [r.asDict() for r in mixing.mixed(docs.repartition(5)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    repeated = mixing.repeat_to_mix(docs)
    assert repeated.columns == docs.columns
    assert repeated.count() == sum(r["copies"] for r in got)
    assert mixing.mixed(nothing).count() == 0


def test_quality_of_held_out_rows(spark, docs, nothing):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        text = prose(rng, 40)
        rows.append((i, text if i % 4 else " ".join(w.upper() + "!!" for w in text.split()), int(i % 4 > 0)))
    table = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = [(r[0], r[2], "x") for r in rows] + [(None, 1, "x"), (3, None, "x"), (5, 9, "x"), (rows[1][0], 1, "x")]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, text string")
    model = quality.fit(table, labels, sample=200)
    scored = quality.scored(table.withColumn("held_out", quality.held_out()), model).collect()
    held = [r for r in scored if r["held_out"]]
    assert len(held) > 100
    assert np.mean([(r["score"] >= 0.5) == (r["doc_id"] % 4 > 0) for r in held]) > 0.97
    assert quality.fit(table.repartition(7), labels, sample=200).score(pa.array(["Some text."])) == model.score(pa.array(["Some text."]))
    odd = quality.scored(docs, model).collect()
    assert len(odd) == len(ROWS) and all(0 <= r["score"] <= 1 for r in odd)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert quality.keep_good(nothing, labels).count() == 0
    untrained = quality.fit(table, labels.where("false"))
    assert untrained.score(pa.array(["a", "", None])).tolist() == [0.5] * 3
