"""The prefix trie against a plain trie of dictionaries, and its hash tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from caseloom.llm import prefix_trie as tries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(rows):
    """The contract's rows by walking every rebuilt conversation; rows are (conv_id, turn, role, text)."""
    said = {}
    for c, turn, role, text in rows:
        if c is not None:
            digest = hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()
            said.setdefault(c, []).append(((turn is not None, turn or 0), digest, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(x, key=lambda y: y[:2])] for c, x in said.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        path = (*own.get(base, [])[:h], *turns[h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append((c, d == len(path)))
    out = {}
    for path in sorted(nodes, key=len, reverse=True):
        members, words = nodes[path], len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        below = [v for k, v in out.items() if len(k) == len(path) + 1 and k[: len(path)] == path]
        ends = ",".join(str(c) for c, end in sorted(members) if end)
        parent = min(c for c, _ in nodes[path[:-1]]) if path else None
        saved = (len(members) - 1) * words + sum(b[6] for b in below)
        leaves = sum(b[5] for b in below) if below else 1
        out[path] = (min(c for c, _ in members), len(path), parent, len(members), len(below), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return sorted(map(repr, out.values()))


def awkward():
    rng = random.Random(4)
    rows = []
    for c in [*range(-45, 160), 10**12, 10**12 + 3]:
        for turn in range(rng.choice([1, 1, 2, 3, 5, 8])):
            rows.append((c, turn, rng.choice(["user", "assistant"]), "say " * rng.choice([0, 1, 2])))
    rows += [(c, t, "user", f"copy {t}") for c in range(200, 420) for t in range(4)]  # one large group of copies
    rows += [(c, t, "user", f"copy {t}" if t < 4 else f"own {c}") for c in range(420, 460) for t in range(5)]
    rows += [(500, t, "user", f"turn {t}") for t in range(300)]
    rows += [(501, None, None, None), (501, 1, "a", "x"), (501, 1, "a", "x"), (501, 1, "b", " \t\x0b"), (None, 0, "user", "lost")]
    rows += [(502, 3, "r1", "2x"), (502, 3, "r", "12x"), (503, 0, "é", "\xa0y z"), (504, 0, "", ""), (504, 1, None, "q " * 5_000)]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("turns"))
    rows = [(*r, "x", 1) for r in awkward()]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, path string, within int")
    df.repartition(5).write.parquet(f"{path}/conversations.parquet")
    return path


def test_query_equals_a_plain_trie(spark, folder):
    got = [tuple(r[c] for c in COLUMNS) for r in tries.op13_prefix_trie(spark, folder).collect()]
    assert sorted(map(repr, got)) == plain_trie(awkward())


@pytest.mark.parametrize("shard_turns", [40, 10**9])
def test_shards_of_any_size_give_the_same_nodes(spark, folder, shard_turns):
    """Some 60 shards, so most nodes of the large group lie on a border; ids of an end in rows of 7."""
    conversations = tries.rebuilt(spark.read.parquet(f"{folder}/conversations.parquet"))
    trie = tries.prefix_trie(conversations, shard_turns=shard_turns, end_ids=7)
    digests = {(r["hi"], r["lo"]): r["sha256"] for r in tries.long_end_digests(trie.long_ends).collect()}
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    got = [(*(r[c] for c in COLUMNS[:-1]), sha(r["ends"]) if r["ends"] is not None else digests.get((r["hi"], r["lo"]), sha([]))) for r in trie.nodes.collect()]
    assert sorted(map(repr, got)) == plain_trie(awkward())


def test_no_conversation_no_node(spark, tmp_path):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    none.write.parquet(f"{tmp_path}/conversations.parquet")
    assert tries.op13_prefix_trie(spark, str(tmp_path)).count() == 0


def test_conversations_without_turns_are_members_of_the_root(spark):
    rows = [(c, b"", []) for c in range(30)]
    trie = tries.prefix_trie(spark.createDataFrame(rows, "id long, path binary, words array<int>"), shard_turns=1)
    (root,) = trie.nodes.collect()
    assert (root["conv_id"], root["depth"], root["n_convs"], root["n_children"], root["n_leaves"], root["saved_tokens"]) == (0, 0, 30, 0, 1, 0)
    assert [i for r in trie.long_ends.orderBy("part", "seq").collect() for i in r["ends"]] == list(range(30))


def test_minimal_hash():
    keys = np.random.default_rng(1).integers(0, 2**63, size=20_000, dtype=np.uint64)
    keys = np.unique(keys)
    found = tries.MinimalHash(keys)
    assert found.size == len(keys)
    assert sorted(found.slots(keys).tolist()) == list(range(len(keys)))
    assert tries.MinimalHash(keys[:0]).size == 0


def test_prefixes_of_one_digest_are_refused(monkeypatch):
    monkeypatch.setattr(tries, "prefix_digests", lambda turns, first, lengths: np.ones_like(turns))
    turns = np.arange(4, dtype=np.uint64).reshape(2, 2)
    with pytest.raises(RuntimeError, match="one digest"):
        tries.Shard(np.array([1, 2]), turns, np.array([1, 1]), np.array([1, 1]))
