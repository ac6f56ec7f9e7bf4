"""Token-ID output: every document encoded, framed as a binary record, written in id order with an offset index."""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm import records
from caseloom.llm.shared import pieces, saved, table
from caseloom.sources.lineage import new_path

TOKENIZER = "byte_bpe_50k.json"
END = 0
#: bytes of text encoded at a time; with the remembered words it bounds a worker's memory
PIECE = 3 << 20
#: distinct words whose ids a worker remembers; beyond, those seen in one piece only are forgotten
REMEMBERED = 400_000
#: a sign that no merge of the vocabulary takes in, so it parts words that are encoded as one text
_PART = "\x1e"
#: what a record starts with: id, whether there is one, bytes per token id
HEAD, HEAD_BYTES = "<qBB", 10
#: texts with a space beside other white space, white space at an end, a comma or full stop that follows other than a
#: letter or digit, or the sign are encoded in one piece
_WHITE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"
_GAPS = rf" {_WHITE}|{_WHITE} |^{_WHITE}|{_WHITE}$|\x{{1E}}|(?:^|[^\p{{L}}\p{{N}}])[.,]"


class Encoder:
    """Ids of many texts by the tokenizers library, each distinct word encoded once.

    Byte-level BPE never merges across the start of a word (a space followed by
    other than white space) nor from a letter or digit to a comma or full stop,
    so a text's ids are those of the parts between such places laid end to end. ``encode`` equals ``encode_batch(texts, add_special_tokens=False)``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.part,) = self.tokenizer.encode(_PART, add_special_tokens=False).ids
        sign = self.tokenizer.id_to_token(self.part)
        if any(sign in token and token != sign for token in self.tokenizer.get_vocab()):
            raise ValueError(f"{path}: the vocabulary merges the sign that parts words")
        self.known: dict[str, int] = {}
        self.start, self.length, self.seen = (np.zeros(0, np.int64) for _ in range(3))
        self.pool = np.zeros(0, np.uint32)

    def _forget(self) -> None:
        """Keep the words that more than one piece had."""
        keep = np.flatnonzero(self.seen > 1)
        new = np.full(len(self.seen), -1)
        new[keep] = np.arange(len(keep))
        self.known = {w: k for w, k in zip(self.known, new.tolist(), strict=True) if k >= 0} if len(keep) < REMEMBERED // 2 else {}
        keep = keep if self.known else keep[:0]
        length = self.length[keep]
        self.pool = self.pool[np.repeat(self.start[keep] - (np.cumsum(length) - length), length) + np.arange(length.sum())]
        self.start, self.length, self.seen = np.cumsum(length) - length, length, np.ones(len(keep), np.int64)

    def _learn(self, new: list[str]) -> None:
        groups = [_PART.join(new[i : i + 512]) + _PART for i in range(0, len(new), 512)]
        found = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(groups, add_special_tokens=False)]
        ids = np.concatenate(found) if found else np.zeros(0, np.uint32)
        ends = np.flatnonzero(ids == self.part)
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.length = np.concatenate([self.length, np.diff(np.concatenate([[-1], ends])) - 1])
        self.pool = np.concatenate([self.pool, np.delete(ids, ends)])
        self.start = np.cumsum(self.length) - self.length
        self.seen = np.concatenate([self.seen, np.zeros(len(new), np.int64)])

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return np.array([len(x) for x in found], np.int64), np.array([i for x in found for i in x], np.uint32)

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        for sign in (" ", ",", "."):
            texts = pc.replace_substring(texts, sign, _PART + sign)
        lists = pc.split_pattern(texts, _PART)
        coded = pc.dictionary_encode(pc.list_flatten(lists))
        distinct = coded.dictionary.to_pylist()
        if len(self.known) + len(distinct) > REMEMBERED:
            self._forget()
        places = np.array([self.known.get(w, -1) for w in distinct], np.int64)
        unknown = np.flatnonzero(places < 0)
        places[unknown] = len(self.known) + np.arange(len(unknown))
        self._learn([distinct[i] for i in unknown.tolist()])
        self.seen[places] += 1
        code = places[np.asarray(coded.indices)]
        length = self.length[code]
        ends = np.cumsum(length)
        ids = self.pool[np.repeat(self.start[code] - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)]
        words = np.cumsum(np.asarray(pc.list_value_length(lists), dtype=np.int64))
        upto = np.concatenate([[0], ends])[np.concatenate([[0], words])]
        return np.diff(upto), ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each text has, and all ids in order; a null text counts as empty."""
        texts = pc.fill_null(texts, "")
        odd = np.asarray(pc.match_substring_regex(texts, _GAPS), dtype=bool)
        if not odd.any():
            return self._words(texts)
        parts = {True: self._whole(texts.filter(pa.array(odd)).to_pylist()), False: self._words(texts.filter(pa.array(~odd)))}
        counts = np.zeros(len(texts), np.int64)
        for kind, (many, _) in parts.items():
            counts[odd == kind] = many
        ids, of = np.zeros(int(counts.sum()), np.uint32), np.repeat(odd, counts)
        for kind, (_, some) in parts.items():
            ids[of == kind] = some
        return counts, ids


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _path(tokenizer: str) -> str:
    import public_tokenizers

    return tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, id: str = "doc_id", text: str = "text", end: int = END
) -> DataFrame:
    """Encode every text, append ``end``, and write the records under ``folder`` in ascending order of id.

    Returns the manifest, saved: one row per file with part (its place in the
    order), file, index, n_records, n_tokens. Rows are dealt by ranges of id and
    text hash, so a range holds its rows in order and rows that repeat an id can
    be parted. A file's name holds its task attempt; a lost or repeated attempt
    leaves a file that no manifest names. Null ids come first, null texts count
    as empty. Ids of 2 bytes are written while the vocabulary fits them, else 4.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = encoder(_path(tokenizer)), TaskContext.get().partitionId()
        width = 2 if coder.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 and end < 1 << 16 else 4
        name = f"{folder}/part-{part:06d}-{TaskContext.get().taskAttemptId()}"
        n_records = n_tokens = offset = 0
        out = index = None
        try:
            for piece in pieces(batches, "text", PIECE):
                if out is None:
                    system, path = records.open_fs(name)
                    system.create_dir(records.open_fs(folder)[1], recursive=True)
                    out, index = (system.open_output_stream(f"{path}.{end}", compression=None) for end in ("rec", "idx"))
                counts, ids = coder.encode(piece.column("text"))
                stops, doc_ids = np.cumsum(counts), piece.column("id").to_pylist()
                small = ids.astype(f"<u{width}")
                last = np.array([end], f"<u{width}").tobytes()
                parts = [
                    struct.pack(HEAD, d or 0, d is not None, width) + small[a:b].tobytes() + last
                    for d, a, b in zip(doc_ids, (stops - counts).tolist(), stops.tolist(), strict=True)
                ]
                framed = records.frame(parts)
                sizes = np.array([len(f) for f in framed], np.int64)
                entries = np.zeros(len(framed), records.INDEX)
                entries["offset"] = offset + np.cumsum(sizes) - sizes
                entries["id"] = [d or 0 for d in doc_ids]
                entries["has_id"] = [d is not None for d in doc_ids]
                out.write(b"".join(framed))
                index.write(entries.tobytes())
                offset += int(sizes.sum())
                n_records, n_tokens = n_records + len(parts), n_tokens + int(counts.sum()) + len(parts)
        finally:
            for stream in (out, index):
                if stream is not None:
                    stream.close()
        if n_records:
            row = [[part], [f"{name}.rec"], [f"{name}.idx"], [n_records], [n_tokens]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in row], ["part", "file", "index", "n_records", "n_tokens"])

    keyed = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    ranged = keyed.repartitionByRange(F.col("id").asc_nulls_first(), "tie").sortWithinPartitions(F.col("id").asc_nulls_first(), "tie")
    written = ranged.select("id", "text").mapInArrow(write, "part long, file string, index string, n_records long, n_tokens long")
    return saved(written)


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per record of the files: id, start (token ids of all records before it), n_tokens, ids_crc32.

    Files are read one a task, from front to back, every checksum verified.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one narrow row per file
    placed = saved(manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).select("part", "file", "start"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                for parts in records.read_records(file):
                    heads = [struct.unpack_from(HEAD, p) for p in parts]
                    counts = np.array([(len(p) - HEAD_BYTES) // h[2] for p, h in zip(parts, heads, strict=True)], np.int64)
                    sums = [
                        zlib.crc32(np.frombuffer(p, f"<u{h[2]}", offset=HEAD_BYTES).astype("<u4").tobytes())
                        for p, h in zip(parts, heads, strict=True)
                    ]
                    starts = start + np.cumsum(counts) - counts
                    start += int(counts.sum())
                    columns = [pa.array([h[0] if h[1] else None for h in heads], pa.int64()), pa.array(starts), pa.array(counts), pa.array(sums, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "start", "n_tokens", "ids_crc32"])

    n = max(1, placed.count())
    return placed.repartitionByRange(n, "part").mapInArrow(read, "id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, tokenizer: str = TOKENIZER, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``docs`` as token files under the shared folder and read them back, one row per document."""
    folder = new_path(docs.sparkSession, "tokens")
    manifest = write_token_files(docs, folder, tokenizer, id, text)
    return read_token_files(manifest).withColumnRenamed("id", id)


def op8_token_output(spark, folder: str) -> DataFrame:
    """Every document's place and checksum in the token files."""
    return token_output(table(spark, folder, "documents"))
