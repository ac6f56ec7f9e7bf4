"""Token counts: texts encoded in batches inside Arrow functions that give back lengths only.

Batches are balanced by bytes. A text is cut at places over which the tokenizer
cannot merge, each distinct piece of a batch is encoded once, and a text's
count is the sum over its pieces, so no task holds the encoding of a long text.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.shared import pieces, table

TOKENIZER = "word_bpe_49k.json"
#: a document with more tokens than this is over the limit
LIMIT = 2048
#: bytes of text that a worker cuts into pieces at a time
BATCH_BYTES = 4 << 20
#: bytes of distinct pieces that the library encodes at a time
ENCODE_BYTES = 1 << 18
#: pieces whose counts a worker remembers
REMEMBERED = 400_000
#: a piece of more bytes is cut further
LONG_PIECE = 1 << 10
#: beside a digit, and between a letter and a full-width mark, no token and no composed letter goes on
_WITHIN = re.compile(r"(?<=[0-9])(?=.)|(?<=[^0-9])(?=[0-9])|(?<=[^\W\d_])(?=[。、，！？])", re.DOTALL)


def _path(tokenizer: str) -> str:
    import public_tokenizers

    return tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer)


def _parts_at_white_space(config: dict) -> bool:
    """Whether ASCII white space and ASCII digits part the text for good.

    So it is where the first step before the merges keeps only matches of a
    pattern of single numbers and of runs of letters or of other signs, and no
    added token holds white space or a digit or takes in what stands beside it.
    """
    steps = config.get("pre_tokenizer") or {}
    first = (steps.get("pretokenizers") or [steps])[0]
    pattern = str((first.get("pattern") or {}).get("Regex"))
    keeps = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
    kinds = {r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+"}
    found = set(pattern.split("|"))
    plain = all(re.fullmatch("'[a-z]+", p) for p in found - kinds)
    steps = config.get("normalizer") or {"normalizers": []}
    known = all(n.get("type") in ("NFC", "Lowercase", "Replace") for n in steps.get("normalizers", [steps]))
    free = all(
        not re.search(r"[\s0-9]", t["content"]) and not (t["lstrip"] or t["rstrip"] or t["single_word"])
        for t in config.get("added_tokens", [])
    )
    return keeps and kinds <= found and plain and known and free


class Counter:
    """Numbers of tokens by the library, without begin, end or added special tokens."""

    def __init__(self, path: str):
        self.known: dict[str, int] = {}
        if path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=path)
            self.lengths = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            self.parts = False
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.lengths = lambda texts: [len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            self.parts = _parts_at_white_space(json.loads(tokenizer.to_str()))

    def _encoded(self, texts: list[str]) -> list[int]:
        """The length of each text, in batches of about ``ENCODE_BYTES``; one text is never split here."""
        out: list[int] = []
        start = size = 0
        for stop, text in enumerate(texts):
            if size and size + len(text) > ENCODE_BYTES:
                out += self.lengths(texts[start:stop])
                start, size = stop, 0
            size += len(text)
        return out + self.lengths(texts[start:]) if texts else out

    def _of_pieces(self, distinct: list[str]) -> np.ndarray:
        """The count of each distinct piece, remembered from earlier batches or encoded now."""
        new = [w for w in distinct if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = distinct
        cut = [_WITHIN.split(w) if len(w) > LONG_PIECE else [w] for w in new]
        each = np.array(self._encoded(list(chain.from_iterable(cut))), np.int64)
        ends = np.cumsum([len(c) for c in cut], dtype=np.int64)
        upto = np.concatenate([[0], np.cumsum(each)])
        counts = np.diff(upto[np.concatenate([[0], ends])])
        self.known.update(zip(new, counts.tolist(), strict=True))
        return np.array([self.known[w] for w in distinct], np.int64)

    def counts(self, texts: pa.Array) -> np.ndarray:
        """How many tokens each text has; a null text counts as empty."""
        texts = pc.fill_null(texts, "")
        if not self.parts:
            return np.array(self._encoded(texts.to_pylist()), np.int64)
        lists = pc.ascii_split_whitespace(texts)
        coded = pc.dictionary_encode(pc.list_flatten(lists))
        of_piece = self._of_pieces(coded.dictionary.to_pylist())[np.asarray(coded.indices, dtype=np.int64)]
        ends = np.cumsum(np.asarray(pc.list_value_length(lists), dtype=np.int64))
        return np.diff(np.concatenate([[0], np.cumsum(of_piece)])[np.concatenate([[0], ends])])


@lru_cache(2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``).

    Counts are those of the library for a whole text: ``tokenizer`` is a file of
    the public tokenizers or a path, a .json for tokenizers, a .model for
    sentencepiece. Where the tokenizer's parts allow it a text is cut at white
    space, and a long piece without any beside digits and full-width marks; else
    it is encoded whole. Null texts count as empty; null and repeated ids and
    repeated rows are rows like others; other columns are not read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(_path(tokenizer))
        for piece in pieces(batches, "text", BATCH_BYTES):
            texts = piece.column("text")
            size = pc.cast(pc.fill_null(pc.binary_length(texts), 0), pa.int64())
            yield pa.RecordBatch.from_arrays([piece.column("id"), size, pa.array(own.counts(texts))], ["id", "n_bytes", "n_tokens"])

    narrow = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    counted = narrow.mapInArrow(count, f"id {narrow.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op11_token_counts(spark, folder: str) -> DataFrame:
    """The token count of every document."""
    return token_counts(table(spark, folder, "documents"))
