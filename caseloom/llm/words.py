"""Words of whole texts and hashes of their shingles, worked out column-wise.

A word is a run of letters, marks and digits, lower-cased. A shingle is ``k``
words in a row; a text of fewer words than that has one shingle, all of its
words, and a text without words has none.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5
_GAP = r"[^\p{L}\p{M}\p{N}]+"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def flat_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """How many words each text has, and the words of all texts in order."""
    clean = pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), _GAP, " "), " ")
    lists = pc.split_pattern(clean, " ")
    counts = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    empty = np.asarray(pc.equal(clean, ""), dtype=bool)
    counts[empty] = 0
    flat = pc.list_flatten(lists)
    return counts, flat.filter(pc.not_equal(flat, "")) if empty.any() else flat


def hashed(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string, the same in every process."""
    coded = pc.dictionary_encode(words)
    table = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False)
    return table[np.asarray(coded.indices)] if len(words) else np.zeros(0, np.uint64)


def shingles(texts: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """For each shingle of each text, in order, repeats included: the row of its text and a 64-bit hash."""
    counts, flat = flat_words(texts)
    word = hashed(flat)
    many = np.where(counts > 0, np.maximum(counts - k + 1, 1), 0)
    row = np.repeat(np.arange(len(counts)), many)
    first = np.cumsum(counts) - counts
    at = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + first[row]
    stop = (first + counts)[row]
    total = np.zeros(len(row), np.uint64)
    for j in range(k):
        inside = at + j < stop
        total = total * _MULTIPLIER + np.where(inside, mix(word[np.where(inside, at + j, at)]), np.uint64(0))
    return row, mix(total)


def weighted(row: np.ndarray, hashes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (row, hash) with how often each occurs, by row and hash; ``row`` is in order."""
    order = np.argsort(hashes)
    order = order[np.argsort(row[order].astype(np.int32 if rows > 32767 else np.int16), kind="stable")]
    r, h = row[order], hashes[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    start = np.flatnonzero(new)
    return r[start], h[start], np.diff(np.append(start, len(r)))
