"""Token files and WARC archives: exact round trips, and damage that must not pass."""

import base64
import gzip
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from caseloom.llm import records, token_files, warc
from tokenizers import Tokenizer

TEXTS = [
    "", " ", "  a  b", "a b ", "x \n y", "it's  don't", "<|endoftext|> a<|endoftext|>b c", "  a 　b", "\x1e a", "日本語 テスト 😀 x",
    "a\n\nb c\n", "tab\t x", "\xa0a", "\n a b", "a \x1cb c", "1,000.5, and... so, on.", "(a), b.), \"c,\" d.", ",a .b", "word " * 30_000, None,
]


def slow_crc32c(data):
    state = 0xFFFFFFFF
    for byte in data:
        state ^= byte
        for _ in range(8):
            state = (state >> 1) ^ (0x82F63B78 if state & 1 else 0)
    return state ^ 0xFFFFFFFF


def test_crc32c():
    assert slow_crc32c(b"123456789") == 0xE3069283
    rng = random.Random(0)
    parts = [b"123456789", *(rng.randbytes(rng.choice([4, 5, 8, 255, 256, 257, 511, 3000])) for _ in range(40))]
    got = records.crc32c(np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts]))
    assert got.tolist() == [slow_crc32c(p) for p in parts]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_encoder_equals_the_library(tokenizer, monkeypatch):
    wanted = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    coder = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    monkeypatch.setattr(token_files, "REMEMBERED", 8)
    for _ in range(3):
        counts, ids = coder.encode(pa.array(TEXTS, pa.string()))
        assert counts.tolist() == [len(w) for w in wanted]
        assert ids.tolist() == [i for w in wanted for i in w]


def test_token_output_equals_the_library(spark, tokenizer):
    rows = [(i, t, "x", 3) for i, t in enumerate(TEXTS)] + [(None, "no id", "x", 3), (4, "same id", "x", 3), (4, "same id", "x", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tie string, start int").repartition(4)
    got = sorted(token_files.token_output(docs).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    start, left = 0, [(r[0], r[1]) for r in rows]
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
        match = [
            (i, t)
            for i, t in left
            if i == r["doc_id"]
            and (ids := [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0])
            and len(ids) == r["n_tokens"]
            and zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]
        ]
        left.remove(match[0])
    assert not left
    assert token_files.token_output(docs.where("false")).count() == 0


def test_shuffled_reads_and_damage(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(50)], "doc_id long, text string")
    manifest = token_files.write_token_files(docs, str(tmp_path / "out"))
    row = manifest.first()
    index = records.read_index(row["index"])
    whole = [p for parts in records.read_records(row["file"]) for p in parts]
    assert len(index) == len(whole) == row["n_records"]
    order = np.random.default_rng(1).permutation(len(index))
    assert records.read_at(row["file"], index["offset"][order]) == [whole[i] for i in order]
    data = bytearray((tmp_path / "out" / row["file"].split("/")[-1]).read_bytes())
    for at in (0, 9, 20, len(data) - 1):
        bad = data.copy()
        bad[at] ^= 1
        (tmp_path / "bad").write_bytes(bad)
        with pytest.raises(ValueError):
            list(records.read_records(str(tmp_path / "bad")))
    (tmp_path / "cut").write_bytes(data[:-3])
    with pytest.raises(ValueError):
        list(records.read_records(str(tmp_path / "cut")))


PAGES = [
    (0, "http://a.example/é?q=1", "<p>one</p>", "x"),
    (1, "http://b.example/\r\nX-Bad: 1", "<p>one</p>", "x"),
    (2, None, None, "x"),
    (3, "http://c.example", "", None),
    (4, "", "é" * 400_000, "x"),
    (5, "http://d.example", "two\r\n\r\nWARC/1.1\r\n", "x"),
    (None, "http://e.example", "<p>one</p>", "x"),
    (None, "http://f.example", "alone", "x"),
    (1, "http://b.example/\r\nX-Bad: 1", "<p>one</p>", "x"),
]


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, _sha1 string").repartition(3)
    manifest = warc.write_warc(pages, str(tmp_path / "warc"))
    got = warc.read_warc(manifest, payloads=True).collect()
    wanted = []
    for i, _, html, _ in PAGES:
        payload = (html or "").encode()
        same = [j for j, _, h, _ in PAGES if (h or "") == (html or "")]
        top = max((j for j in same if j is not None), default=None)
        response = top is None or i == top
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        row = (i, len(payload), digest, "response" if response else "revisit", None if response else top, payload if response else None)
        wanted.append(row)
    rows = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["payload"] and bytes(r["payload"])) for r in got]
    rows = [(*r[:5], b"" if r[3] == "response" and not r[5] else r[5]) for r in rows]
    assert sorted(map(repr, rows)) == sorted(map(repr, wanted))
    # every member is a gzip file of its own, and the whole is one for other readers too
    for r in manifest.collect():
        data = open(r["file"], "rb").read()
        assert gzip.decompress(data).count(b"WARC-Record-ID: ") == r["n_records"]
    assert warc.read_warc(warc.write_warc(pages.where("false"), str(tmp_path / "none"))).count() == 0


def test_revisits_from_a_least_size_on(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, extra string")
    got = warc.read_warc(warc.write_warc(pages, str(tmp_path / "warc"), least=5)).collect()
    assert {r["record_type"] for r in got if r["payload_bytes"] < 5} == {"response"}
    assert sum(r["record_type"] == "revisit" for r in got) == 2


def test_damaged_archives_do_not_pass(tmp_path):
    digest = warc.digest_text(hashlib.sha1(b"payload").digest())
    good = warc.record(1, "http://a.example", b"payload", digest, False, None)
    path = str(tmp_path / "a.warc.gz")

    def read(*members):
        with open(path, "wb") as out:
            out.write(b"".join(members))
        return list(warc.read_archive(path, True))

    assert [r.payload for r in read(warc.member(good), warc.member(good))] == [b"payload"] * 2
    for bad in (
        good.replace(b"payload", b"paYload"),
        good.replace(b"Content-Length: 85", b"Content-Length: 84"),
        good + b"x",
        good[:-6],
        good.replace(b"WARC/1.1", b"WARC/0.1"),
        good[:60],
    ):
        assert bad != good
        with pytest.raises(ValueError):
            read(warc.member(bad))
    with pytest.raises(ValueError):
        read(warc.member(good)[:-9])
    with pytest.raises(ValueError):
        read(warc.member(good)[:-3] + b"zzz")
