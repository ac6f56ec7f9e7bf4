"""Token counts against the library on whole texts."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
from caseloom.llm import token_counts
from tokenizers import Tokenizer

PIECES = [
    *"ab 'sStT019。，、！!é<|>endoftext\n\t\x1c\x85\xa0　ΣςかĳŉǅÅ½²日本", "́", "̸", "<|endoftext|>", "<|startoftext|>", "'ll", "'LL",
    "\r\n", "1́", "が", "Ｘ", "ﬁ", "😀",
]


def library(texts, name=token_counts.TOKENIZER):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return [len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def noise(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("remembered, long_piece", [(400_000, 1024), (8, 3)])
def test_counts_equal_the_library(monkeypatch, remembered, long_piece):
    monkeypatch.setattr(token_counts, "REMEMBERED", remembered)
    monkeypatch.setattr(token_counts, "LONG_PIECE", long_piece)
    monkeypatch.setattr(token_counts, "ENCODE_BYTES", 500)
    texts = [*noise(3000), "", None, "  ", "x" * 50_000, "12ab" * 20_000, "日本。" * 9_000, "word " * 40_000]
    counter = token_counts.Counter(public_tokenizers.path(token_counts.TOKENIZER))
    assert counter.parts
    for _ in range(2):
        assert counter.counts(pa.array(texts, pa.string())).tolist() == library(texts)


def test_tokenizers_whose_words_hold_white_space_are_not_cut():
    texts = [*noise(500), "", None, "a  b\n c "]
    counter = token_counts.Counter(public_tokenizers.path("byte_bpe_50k.json"))
    assert not counter.parts
    assert counter.counts(pa.array(texts, pa.string())).tolist() == library(texts, "byte_bpe_50k.json")
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    wanted = [len(SentencePieceProcessor(model_file=path).encode(t or "")) for t in texts]
    assert token_counts.Counter(path).counts(pa.array(texts, pa.string())).tolist() == wanted


def test_one_row_per_document(spark):
    texts = [*noise(200), "", None, "same", "same", "word " * 2048, "word " * 2049]
    rows = [(i if i % 7 else None, t, -1, -2) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, id int").repartition(5)
    got = [tuple(r) for r in token_counts.token_counts(docs).collect()]
    wanted = [(r[0], len((r[1] or "").encode()), n, n > 2048) for r, n in zip(rows, library(texts), strict=True)]
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))
    assert token_counts.token_counts(docs.where("false")).count() == 0


def test_the_query_covers_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.op11_token_counts(spark, folder).collect()}
    counts = library([r["text"] for r in docs])
    assert got == {r["doc_id"]: (len(r["text"].encode()), n, n > 2048) for r, n in zip(docs, counts, strict=True)}
