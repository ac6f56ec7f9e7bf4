"""Quality classifier: learned vectors of hashed words and character n-grams, averaged per document, then softmax.

Trained by stochastic gradient descent in numpy on a bounded sample of labelled
documents; every document is scored whole.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.llm import words
from caseloom.llm.shared import beside, pieces, saved, table

#: documents that training reads at most; those with the lowest hash of their id are taken
SAMPLE = 4_000
#: features of one document that training keeps at most: one per bucket, so a bound of its own
BUCKETS = 1 << 17
NGRAMS = (3, 4, 5)
AGAIN = "\x1d=\x1d"
#: bytes of text scored at a time; the runs of characters of its words take some hundred times as much
PIECE = 1 << 20


@dataclasses.dataclass(frozen=True)
class Model:
    """What a score needs of the trained vectors: per bucket its pull towards label 1, and the bias."""

    pull: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        """The softmax output for label 1 of each text; a text without words scores by the bias alone."""
        counts, index, starts, buckets = features(texts)
        per_word = np.add.reduceat(self.pull[buckets].astype(float), starts) if len(starts) else np.zeros(0)
        size = np.diff(np.append(starts, len(buckets)))
        row = np.repeat(np.arange(len(counts)), counts)
        total = np.bincount(row, weights=per_word[index], minlength=len(counts))
        many = np.bincount(row, weights=size[index], minlength=len(counts))
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(many, 1) + self.bias, -500, 500)))


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, each word's place among the distinct words, and those words' buckets with where each starts.

    Words are what white space parts, case and signs kept. A word has a bucket of
    its own and one for each run of 3 to 5 characters of it between two marks. A
    word that repeats the one before it counts with a further word, ``AGAIN``.
    """
    lists = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    counts = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    flat = pc.list_flatten(lists)
    keep = np.asarray(pc.not_equal(flat, ""), dtype=bool)
    if not keep.all():
        row = np.repeat(np.arange(len(counts)), counts)
        counts, flat = np.bincount(row[keep], minlength=len(counts)), flat.filter(pa.array(keep))
    coded = pc.dictionary_encode(flat)
    distinct = coded.dictionary.to_pylist()
    if not distinct:
        return counts, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    index, row = np.asarray(coded.indices), np.repeat(np.arange(len(counts)), counts)
    again = np.flatnonzero((index[1:] == index[:-1]) & (row[1:] == row[:-1])) + 1
    if len(again):
        order = np.argsort(np.concatenate([row, row[again]]), kind="stable")
        index = np.concatenate([index, np.full(len(again), len(distinct))])[order]
        counts = counts + np.bincount(row[again], minlength=len(counts))
    distinct.append(AGAIN)
    code = np.frombuffer(("<" + "><".join(distinct) + ">").encode("utf-32-le"), np.uint32).astype(np.uint64)
    length = np.array([len(w) for w in distinct], np.int64) + 2
    end = np.cumsum(length)
    word = np.repeat(np.arange(len(distinct)), length)
    at = np.arange(len(code))
    hashes = [pd.util.hash_array(np.array(distinct, dtype=object), categorize=False)]
    of = [np.arange(len(distinct))]
    for n in NGRAMS:
        first = at[at + n <= end[word]]
        total = np.full(len(first), n, np.uint64)
        for j in range(n):
            total = words.mix(total) + code[first + j]
        hashes.append(words.mix(total))
        of.append(word[first])
    of_all = np.concatenate(of)
    order = np.argsort(of_all, kind="stable")
    buckets = (np.concatenate(hashes) % np.uint64(BUCKETS)).astype(np.int64)[order]
    starts = np.searchsorted(of_all[order], np.arange(len(distinct)))
    return counts, index, starts, buckets


def document_features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct buckets and their shares."""
    counts, index, starts, buckets = features(texts)
    stops, ends = np.append(starts[1:], len(buckets)), np.cumsum(counts)
    for start, end in zip(ends - counts, ends, strict=True):
        used, times = np.unique(index[start:end], return_counts=True)
        total = np.zeros(BUCKETS)
        size = stops[used] - starts[used]
        flat = np.repeat(starts[used] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        np.add.at(total, buckets[flat], np.repeat(times, size))
        have = np.flatnonzero(total)
        yield have.astype(np.int32), (total[have] / max(total.sum(), 1)).astype(np.float32)


def train(
    rows: list[tuple[np.ndarray, np.ndarray, int]], dim: int = 8, epochs: int = 5, rate: float = 0.2, seed: int = 1
) -> Model:
    """Softmax over the mean vector of a document's features, by gradient steps one document at a time.

    The step of the vectors is divided by the sum of squared shares, so that a
    document of few features moves its mean no further than one of many.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    out, bias = np.zeros((2, dim), np.float32), np.zeros(2, np.float32)
    steps, step = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            ids, share, label = rows[i]
            now = rate * (1 - step / steps)
            step += 1
            mine = vectors[ids]
            hidden = share @ mine
            z = out @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            back = p @ out
            out -= now * np.outer(p, hidden)
            bias -= 0.1 * now * p
            if len(ids):
                vectors[ids] = mine - (now * share / (share @ share))[:, None] * back[None, :]
    return Model((vectors @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0]))


def held_out(id: str = "doc_id") -> Column:
    """Rows that training never sees: the crc32 of the id as text leaves 1 modulo 3; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model:
    """A model of ``label`` (0 or 1) from at most ``sample`` labelled documents that are not held out.

    Which ones: the lowest hashes of the id, so a rerun takes the same. Of an
    id's repeated labels the smallest counts, of its texts the smallest. Labels
    other than 0 and 1 and null ids are left out. Without any labelled document
    every score is 0.5.
    """
    usable = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull() & ~held_out(id))
    chosen = usable.groupBy(F.col(id).alias("_id")).agg(F.min(label).cast("int").alias("_label"))
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id").limit(sample)  # bounded, so it may be sent to every executor
    texts = docs.select(F.col(id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = texts.join(F.broadcast(saved(chosen)), "_id").groupBy("_id", "_label").agg(F.min("_text").alias("text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", PIECE):
            found = list(document_features(piece.column("text")))
            columns = [piece.column("_id").cast(pa.int64()), piece.column("_label")]
            columns += [pa.array([f[j].tobytes() for f in found], pa.binary()) for j in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "ids", "shares"])

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [r for batch in batches for r in batch.itertuples(index=False)]
        got.sort(key=lambda r: r.id)
        model = train([(np.frombuffer(r.ids, np.int32), np.frombuffer(r.shares, np.float32), int(r.label)) for r in got])
        yield pd.DataFrame({"pull": [model.pull.tobytes()], "bias": [model.bias]})

    extracted = rows.mapInArrow(extract, "id long, label int, ids binary, shares binary")
    model = extracted.repartition(1).mapInPandas(learn, "pull binary, bias double").first()
    return Model(np.frombuffer(model["pull"], np.float32), model["bias"]) if model else Model(np.zeros(BUCKETS, np.float32), 0.0)


def scored(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with one more column: the score of each whole text, 0 to 1. Null texts score like empty ones."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            batch = pa.RecordBatch.from_arrays([pa.array(series, pa.string(), from_pandas=True)], ["t"])
            yield pd.Series(np.concatenate([model.score(p.column("t")) for p in pieces(iter([batch]), "t", PIECE)] or [np.zeros(0)]))

    return docs.withColumn(into, score(F.col(text)))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that a model trained on ``labels`` takes for label 1."""
    model = fit(docs, labels, text=text, **options)
    return scored(beside(docs, text=F.col(text)), model).where("score >= 0.5").select("row.*")


def op10_quality(spark, folder: str) -> DataFrame:
    """Every document with its quality score."""
    docs = table(spark, folder, "documents")
    model = fit(docs, table(spark, folder, "labels"))
    out = scored(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
