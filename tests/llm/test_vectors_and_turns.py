"""Embedding links, chat formatting and the licence scan, on small tables with every awkward case."""

import math
import random
import time
from pathlib import Path

import duckdb
import numpy as np
import pytest
from caseloom.llm import chat, embedding_links, license_texts, licenses

VECTORS = "vec_id long, embedding array<float>, label int, key string, unit string"


def clouds(seed=2):
    """Clusters wider and narrower than the threshold, copies, and points that are far from all."""
    rng = np.random.default_rng(seed)
    rows = []
    for label, dim in ((1, 16), (2, 16), (1, 8)):
        for width in (0.0, 0.01, 0.05, 0.12):
            center = rng.normal(size=dim)
            for _ in range(25):
                rows.append((label, center / np.linalg.norm(center) + rng.normal(size=dim) * width / math.sqrt(dim) * 4))
        rows += [(label, rng.normal(size=dim)) for _ in range(30)]
    return [(i, [float(x) for x in np.float32(v)], label, "k", "u") for i, (label, v) in enumerate(rows)]


def brute(rows, threshold=0.98):
    n = len(rows)
    good = [r[1] is not None and r[2] is not None and len(r[1]) > 0 and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    unit = [np.array(r[1], float) / np.linalg.norm(np.array(r[1], float) / max(map(abs, r[1]))) / max(map(abs, r[1])) if g else None for r, g in zip(rows, good, strict=True)]
    near = [[j for j in range(n) if j != i and good[i] and good[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in range(n)]
    root = list(range(n))
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        root[i] = min(ids) if ids else None
    return sorted(map(repr, [(r[0], len(near[i]), root[i], r[0] is not None and r[0] == root[i]) for i, r in enumerate(rows)]))


def linked(spark, rows, **options):
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    return sorted(map(repr, map(tuple, embedding_links.embedding_links(df, **options).collect())))


def test_links_equal_brute_force(spark):
    assert linked(spark, clouds()) == brute(clouds())


def test_links_over_many_small_cells(spark):
    """Cells of at most 12 vectors: several passes of pivots, guests in chunks."""
    assert linked(spark, clouds(), most=12) == brute(clouds())


def test_links_of_awkward_vectors(spark):
    a = [1.0, 2.0, 3.0]
    rows = [
        (1, a, 1), (2, a, 1), (3, [2.0, 4.0, 6.0], 1), (4, a, 2), (5, a, None), (6, None, 1), (7, [0.0, 0.0, 0.0], 1), (8, [1.0, None, 3.0], 1),
        (9, [float("nan"), 2.0, 3.0], 1), (10, [float("inf"), 2.0, 3.0], 1), (11, [], 1), (12, [1.0, 2.0], 1), (None, a, 1), (None, None, 1), (2, a, 1),
        (13, [1e-30, 2e-30, 3e-30], 1), (14, [-1.0, -2.0, -3.0], 1),
    ]
    rows = [(*r, "k", "u") for r in rows]
    assert linked(spark, rows) == brute(rows)
    assert linked(spark, []) == []


def test_cover_tree_covers_in_nested_levels():
    units = np.random.default_rng(0).normal(size=(300, 5))
    units /= np.linalg.norm(units, axis=1)[:, None]

    def walk(node):
        away = embedding_links.distances(units[node.members], units[[node.center]])[:, 0]
        assert away.max() <= node.radius + 1e-7
        if node.children:
            assert sorted(np.concatenate([c.members for c in node.children])) == sorted(node.members)
            assert node.center in [c.center for c in node.children]
            assert all(c.radius <= node.radius / 2 + 1e-9 for c in node.children)
            for c in node.children:
                walk(c)

    walk(embedding_links.cover_tree(units))


@pytest.mark.parametrize("small, strip", [(1, 3), (2, 512), (32, 512)])
def test_cells_of_every_density_equal_brute_force(monkeypatch, small, strip):
    """Owned rows and guests, copies, weights; leaves as matrices, whole nodes, and what the bounds cut off."""
    monkeypatch.setattr(embedding_links, "SMALL", small)
    monkeypatch.setattr(embedding_links, "STRIP", strip)
    rng = np.random.default_rng(small)
    for _ in range(80):
        n, d, k = (int(x) for x in rng.integers([1, 1, 1], [160, 6, 5]))
        units = rng.normal(size=(k, d))[rng.integers(0, k, n)] + rng.normal(size=(n, d)) * rng.choice([0.01, 0.1, 0.3, 1])
        units = np.concatenate([units, units[: n // 3]])
        units /= np.linalg.norm(units, axis=1, keepdims=True)
        n, threshold, among = len(units), float(rng.choice([0.5, 0.9, 0.98, 0.999])), bool(rng.random() < 0.7)
        weights, owned = rng.integers(1, 5, n), rng.random(n) < rng.choice([0.2, 0.7, 1.0])
        near = (units @ units.T >= threshold) & ~np.eye(n, dtype=bool)
        near &= (owned[:, None] ^ owned[None, :]) | (among & owned[:, None] & owned[None, :])
        label = np.arange(n)
        while ((low := np.minimum(label, np.where(near, label[None, :], n).min(axis=1))) != label).any():
            label = low
        counts, roots = embedding_links.cell_links(units, weights, owned, among, threshold)
        assert (counts[owned] == (near * weights[None, :]).sum(axis=1)[owned]).all()
        assert len(set(zip(roots.tolist(), label.tolist(), strict=True))) == len(set(roots.tolist())) == len(set(label.tolist()))


def test_a_dense_cell_is_compared_by_matrices():
    """8,192 vectors of which most pairs are linked and no ball decides: one task's worth, within seconds."""
    rng = np.random.default_rng(4)
    center = rng.normal(size=64)
    units = center / np.linalg.norm(center) + rng.normal(size=(8192, 64)) * 0.1 / 8
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    began = time.perf_counter()
    counts, roots = embedding_links.cell_links(units, np.ones(8192, np.int64), np.ones(8192, bool), True, 0.98)
    assert time.perf_counter() - began < 60  # pair by pair it took half an hour
    assert len(set(roots.tolist())) == 1
    assert counts[:50].tolist() == [int((units[i] @ units.T >= 0.98).sum()) - 1 for i in range(50)]


def test_labels_of_any_text_are_apart(spark):
    """Labels with slashes that look like a part of another label's cell."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=2)], "x", 1) for i in range(60)]
    rows += [(100 + i, [1.0 + i], label, 1) for i, label in enumerate(["x/16", "x/16/3", "x/3", "", "/", "x\x00"])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string, cell int")
    got = {r["vec_id"]: r["n_links"] for r in embedding_links.embedding_links(df, most=6).collect()}
    want = {i: 0 for i in got}
    for i, u, _, _ in rows[:60]:
        want[i] = sum(np.dot(u, v) / math.dist(u, (0, 0)) / math.dist(v, (0, 0)) >= 0.98 for j, v, _, _ in rows[:60] if j != i)
    assert got == want


def test_cells_are_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(embedding_links, "CELL_BYTES", 16 * 8 * 12)  # 12 vectors of 16, 24 of 8 dimensions
    assert linked(spark, clouds()) == brute(clouds())


TURNS = "conv_id long, turn long, role string, text string, turns string, id int"


def turns(rows):
    return [(*r, "x", 1) for r in rows]


def test_preferences(spark):
    rows = turns(
        [
            (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "bye"), (1, 3, "assistant", "see you"), (1, 4, "user", "?"),
            (2, 0, "user", "hi"), (2, 1, "assistant", "go away"),
            (3, 0, "user", "alone"),
            (4, None, None, None), (4, 1, "assistant", None), (4, 1, "assistant", None),
            (6, 0, "user", "hi"), (6, 1, "assistant", "hello"), (6, 2, "user", "bye"), (6, 3, "assistant", "no"),
            (7, 0, "user", "hi"), (7, 1, "assistant", "go away"),
            (None, 0, "user", "nobody's"),
            (500, 0, "assistant", "x" * 100_000),
        ]
    )
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    got = {r["id"]: r for r in chat.format_preferences(chat.paired(chat.conversations(df))).collect()}
    assert set(got) == {1, 2, 3, 4, 6, 7, 500}
    # the same first turn: they diverge at the second or at the fourth
    assert [(got[i]["other"], got[i]["n_common"]) for i in (1, 2, 6, 7)] == [(2, 1), (6, 1), (1, 3), (6, 1)]
    six = got[6]
    assert six["prompt"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>\n<|im_start|>user\nbye<|im_end|>\n"
    assert [tuple(p) for p in six["chosen_parts"]] == [("<|im_start|>assistant\n", False), ("no<|im_end|>", True), ("\n", False)]
    assert [tuple(p) for p in six["rejected_parts"]] == [("<|im_start|>assistant\n", False), ("see you<|im_end|>", True), ("\n", False)]
    # alone with its first turn, no reply of its own: all prompt
    assert (got[3]["other"], got[3]["n_common"], got[3]["chosen_parts"], got[3]["rejected_parts"]) == (4, 1, [], [])
    assert got[3]["prompt"] == "<|im_start|>user\nalone<|im_end|>\n"
    assert got[4]["other"] == 6 and got[4]["prompt"].startswith("<|im_start|>\n<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n")
    # the last id goes round to the first, whose reply replaces its own
    assert (got[500]["other"], got[500]["n_common"]) == (1, 0)
    assert [tuple(p) for p in got[500]["rejected_parts"]][1] == ("see you<|im_end|>", True)
    assert chat.paired(chat.conversations(df.where("false"))).count() == 0
    (lone,) = chat.paired(chat.conversations(df.where("conv_id = 3"))).collect()
    assert lone["other"] == 3 and lone["chosen"] == lone["rejected"]


def test_ids_far_apart_are_never_paired_with_themselves(spark):
    rows = turns([(i * 64, t, ("user", "assistant")[t], f"{t} of {i}") for i in range(50) for t in (0, 1)])
    got = {r["id"]: r for r in chat.paired(chat.conversations(spark.createDataFrame(rows, TURNS))).collect()}
    assert {i: r["other"] for i, r in got.items()} == {i * 64: (i + 1) % 50 * 64 for i in range(50)}
    assert all(r["chosen"] != r["rejected"] for r in got.values())


def test_preferences_equal_their_sql(spark, tmp_path):
    """Groups of one first turn, copies, conversations without replies, ties and nulls, in several ranges."""
    rng = random.Random(9)
    rows = [(None, 0, "user", "x")]
    for c in rng.sample(range(-500, 5000), 180):
        start = rng.choice([("system", "hot"), ("user", "a"), ("user", f"own {c}"), ("assistant", "a")])
        rows.append((c, 0, *start))
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["yes", "no", None])) for t in range(1, rng.randrange(1, 5))]
    rows += [(6000 + c, t, "user" if t % 2 == 0 else "assistant", f"copy {t}") for c in range(60) for t in range(4)]
    spark.createDataFrame(turns(rows), TURNS).repartition(5).coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    df = chat.op6_chat_preferences(spark, str(tmp_path))
    wanted = con.sql(f"SELECT {', '.join(df.columns)} FROM ({chat.OP6_SQL})").fetchall()
    got = [tuple(r) for r in df.collect()]
    assert sorted(got) == sorted(wanted) and len({r[2] for r in got}) > 2
    assert sum(r[0] == r[1] for r in got) == 0


def test_preferences_of_given_pairs(spark):
    schema = "n_common string, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>"
    a = [("user", "q"), ("assistant", "a")]
    rows = [("x", a, a), ("x", a, a[:1]), ("x", a, None), ("x", [], a), ("x", a, [("user", "other"), ("assistant", "a")])]
    got = chat.format_preferences(spark.createDataFrame(rows, schema).coalesce(1)).collect()
    assert [(r["n_common"], len(r["chosen_parts"]), len(r["rejected_parts"])) for r in got] == [(2, 0, 0), (1, 3, 0), (0, 6, 0), (0, 0, 6), (0, 6, 6)]


@pytest.mark.parametrize("name", list(license_texts.LICENSES))
def test_licence_texts_are_found_whole(spark, name):
    variants = []
    for text in license_texts.LICENSES[name]:
        loud = "Copyright (c) 2020 Somebody\n\n" + text.upper().replace("LICENSE", "Licence").replace(",", " ; ")
        variants += [text, loud, "Some words before.\n\n" + text + "\n\nAnd after."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(variants)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan_licenses(df, licenses.known_licenses(spark)).collect()}
    assert all(name in r["licenses"] for r in got.values())
    assert [got[i]["whole_text"] for i in range(3)] == [True, True, False]


def test_published_licence_texts_and_headers_are_known(spark):
    folder = Path(license_texts.__file__).parent / "license_data"
    whole = {p.stem: p.read_text() for p in folder.glob("*.txt")}
    apache, gpl = whole["Apache-2.0"], whole["GPL-3.0"]
    header = apache[apache.index("Licensed under the Apache License, Version 2.0 (the") :]
    code = "#!/bin/sh\n\n# Copyright 2020 Somebody\n#\n" + "".join(f"# {x.strip()}\n" for x in header.splitlines()) + "\necho 1\n"
    mit = license_texts.LICENSES["MIT"][-1].replace("IN NO EVENT SHALL THE ", "IN NO EVENT SHALL THE\n").replace("CLAIM, ", "CLAIM,\n")
    rows = [(f"whole {n}", t, n) for n, t in whole.items()] + [(f"held {n}", f"Before.\n\n{t}\n\nAfter.", n) for n, t in whole.items()]
    rows += [("code", code, "Apache-2.0"), ("terms", apache[: apache.index("APPENDIX")], "Apache-2.0"), ("mit", mit, "MIT")]
    rows += [("gpl terms", gpl[: gpl.index("How to Apply These")], "GPL-3.0"), ("cut", gpl[: len(gpl) // 2], "")]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id string, text string, want string"), licenses.known_licenses(spark))
    found = {r["doc_id"]: (r["licenses"], r["whole_text"]) for r in got.collect()}
    assert {i: found[i][0] for i, _, _ in rows} == {i: [want] if want else [] for i, _, want in rows}
    assert {i for i, (_, w) in found.items() if w} == {i for i, _, _ in rows if i.startswith("whole") or i in ("terms", "gpl terms", "mit")}


def test_licence_scan_of_awkward_texts(spark):
    mit = "Released under the MIT License."
    rows = [
        (1, None), (2, ""), (3, "\n\n"), (4, mit), (4, mit), (None, mit), (5, f"{mit} Or not."), (6, "Copyright 2020 A\n(c) B\n© C"),
        (7, f"x\n  -- released under  THE mit licence --\r\n{mit}"), (8, "word " * 50_000 + "\n" + mit), (9, "Licenced under the MIT-license"),
    ]
    df = spark.createDataFrame([(*r, "k", "d") for r in rows], "doc_id long, text string, license string, digest string")
    got = licenses.scan_licenses(df, licenses.known_licenses(spark)).collect()
    assert len(got) == len(rows)
    hit = {(r["doc_id"], r["n_licenses"], r["whole_text"]) for r in got}
    assert hit == {(1, 0, False), (2, 0, False), (3, 0, False), (4, 1, True), (None, 1, True), (5, 0, False), (6, 0, False), (7, 1, False), (8, 1, False), (9, 1, True)}
    assert licenses.scan_licenses(df.where("false"), licenses.known_licenses(spark)).count() == 0
    nothing_known = spark.createDataFrame([], "license string, text string")
    assert {r["n_licenses"] for r in licenses.scan_licenses(df, nothing_known).collect()} == {0}
