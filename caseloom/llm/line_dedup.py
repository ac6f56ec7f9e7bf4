"""Line dedup: exact set-similarity join of lines, then removal of the later of each matching pair.

A line is the set of its words. Words are ordered by rarity: by how often their
hash bucket occurs in the corpus, then by hash, one order for all lines. Two
lines of similarity t share a word among the first n - ceil(t n) + 1 of each, so
only those prefixes are joined. What is left by the length and positional
filters is verified by exact Jaccard.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm import words
from caseloom.llm.shared import beside, bitmap, cleaned, in_bitmap, packed, pieces, saved, small_side, table

THRESHOLD = 0.8
#: the rarity table has 2**22 buckets, 16 MB, however large the corpus; it is sent and added up in slices
RARITY_BITS, SLICES = 22, 64
#: pairs that a task looks at together
PAIRS = 1 << 20
#: rows of one word that a task compares with as many others
BLOCK = 1024
#: entries of one word that are sifted with as many others; words with more are looked for in one of so many texts
SIFTED, EVERY = 1 << 14, 32
#: entries that a task packs into lists together, and those that a bucket is meant to hold
PACKED, BUCKET = 1 << 17, 1 << 17
#: columns of a matrix of lines and words at a time; multiplications that cost as much as to compare two lines by their sets
WIDE, WORTH = 1 << 12, 100_000
#: pairs of a group that are compared one by one, by sets
FEW = 32
#: bytes of text that a task takes apart together; lines of so many words are told apart by counts besides parities
TOGETHER, TALLIED = 6 << 20, 64
_SALT = np.uint64(0x632BE59BD9B4E019)
#: a number for each byte, and one for each place of a word as far as words are hashed by sums of products
_BYTES = words.mix(np.arange(1, 257, dtype=np.uint64) * _SALT)
_POWERS = words.mix(np.arange(1, 65, dtype=np.uint64) ^ _SALT) | np.uint64(1)
Scan = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
#: the columns of an entry, the word it is dealt by last
TYPES = {"size": "int", "c1": "long", "place": "int", "bits": "long", "tally": "long", "prev": "long", "token": "long"}
ENTRY = list(TYPES)
KIND = np.dtype([(n, np.int32 if t == "int" else np.int64) for n, t in TYPES.items()])
#: 48 bits of a word's hash tell the words of two lines apart
_SHORT = np.uint64((1 << 48) - 1)


def _by_rarity(hashes: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Keys in order of the rank of the hashes' buckets and then of the hashes; no two hashes share one."""
    low = np.uint64(64 - RARITY_BITS)
    # the bucket is the hash's upper bits, so putting its rank there keeps ties in order of hash
    return (rank[(hashes >> low).astype(np.int64)].astype(np.uint64) << low) | (hashes & ((np.uint64(1) << low) - np.uint64(1)))


def _hashed(flat: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, none of which is empty, the same in every process."""
    flat = flat.cast(pa.string())
    offsets = np.frombuffer(flat.buffers()[1], np.int32, len(flat) + 1, flat.offset * 4).astype(np.int64)
    out, length = np.zeros(len(flat), np.uint64), np.diff(offsets)
    if not len(flat):
        return out
    data = np.frombuffer(flat.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    start = offsets[:-1] - offsets[0]
    place = np.arange(len(data)) - np.repeat(start, length)
    out = words.mix(np.add.reduceat(_BYTES[data] * _POWERS[np.minimum(place, len(_POWERS) - 1)], start) ^ length.astype(np.uint64))
    long = np.flatnonzero(length > len(_POWERS))
    out[long] = words.hashed(flat.take(pa.array(long)))
    return out


def _taken_apart(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """How many words each string has and the place of the first among the words, which come with those of plain strings first."""
    plain = pc.ascii_is_alnum(tokens)
    alone = np.asarray(plain, dtype=bool)
    many, flat = words.flat_words(tokens.filter(pc.invert(plain)))
    counts, first = np.ones(len(tokens), np.int64), np.cumsum(alone) - 1
    counts[~alone] = many
    first[~alone] = np.cumsum(many) - many + np.count_nonzero(alone)
    return counts, first, pa.concat_arrays([pc.ascii_lower(tokens.filter(plain)), flat])


def word_sets(lines: pa.Array, rank: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each distinct word of each line: the line and the hash, by line and rarity, or hash if no ``rank`` is given; and words per line.

    Blanks part words, so the distinct strings between blanks are taken apart
    once each, and lines are sorted as numbers of their words.
    """
    between = pc.split_pattern(lines, " ")
    counts = np.asarray(pc.list_value_length(between), dtype=np.int64)
    coded = pc.dictionary_encode(pc.list_flatten(between))
    many, at, flat = _taken_apart(coded.dictionary)
    hashes = _hashed(flat)
    _, distinct, number = np.unique(hashes if rank is None else _by_rarity(hashes, rank), return_index=True, return_inverse=True)
    code = np.asarray(coded.indices)
    times = many[code]
    first = at[code] - (np.cumsum(times) - times)
    word = number[np.repeat(first, times) + np.arange(times.sum())]
    key = np.sort((np.repeat(np.repeat(np.arange(len(counts)), counts), times) << 32) | word)
    key = key[np.diff(key, prepend=-1) > 0]
    line = key >> 32
    return line, hashes[distinct][key & 0xFFFFFFFF], np.bincount(line, minlength=len(counts))


def line_sets(texts: pa.Array, rank: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines per text; and the ``word_sets`` of the lines, counted over all texts."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    return np.asarray(pc.list_value_length(lists), dtype=np.int64), *word_sets(pc.list_flatten(lists), rank)


def set_hashes(hashes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for each line's set of words: two sums over its words."""
    ends, out = np.cumsum(size), []
    for spread in (words.mix(hashes), words.mix(hashes ^ _SALT)):
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread, dtype=np.uint64)])
        out.append((upto[ends] - upto[ends - size]).view(np.int64))
    return out[0], out[1]


def parities(hashes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64 bits for each line: each word turns over one of them, so two lines differ in no more bits than words."""
    bits = np.uint64(1) << (words.mix(hashes) & np.uint64(63))
    upto = np.concatenate([np.zeros(1, np.uint64), np.bitwise_xor.accumulate(bits)])
    ends = np.cumsum(size)
    return (upto[ends] ^ upto[ends - size]).view(np.int64)


def tallies(line: np.ndarray, hashes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """16 counts modulo 16 for each line of ``TALLIED`` words or more, each word counted in one of them, else 0.

    Parity bits of long lines are all but random; counts stay apart up to some 200 words.
    """
    counts = np.bincount(line * 16 + (words.mix(hashes) >> np.uint64(60)).astype(np.int64), minlength=16 * len(size))
    counts = (counts & 15).astype(np.uint64).reshape(-1, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4))
    return np.where(size >= TALLIED, np.bitwise_or.reduce(counts, axis=1).view(np.int64), 0)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How far the counts of two tallies are apart in all, the shorter way around each."""
    a, b, top, low = a.view(np.uint64), b.view(np.uint64), np.uint64(0x8888888888888888), np.uint64(0x0F0F0F0F0F0F0F0F)
    less = ((a | top) - (b & ~top)) ^ ((a ^ ~b) & top)
    minus = (less & top) >> np.uint64(3)
    way = (less ^ (minus * np.uint64(15))) + minus
    return (((way & low) + ((way >> np.uint64(4)) & low)) * np.uint64(0x0101010101010101) >> np.uint64(56)).astype(np.int64)


def _documents(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(F.col(id).cast("long").alias("id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))


def occurrences(documents: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Every line (id, tie, line_no, c1, c2, size), and how often each bucket of words occurs.

    A task counts into one table of buckets and sends it in compressed slices,
    which are added up by slice: the driver gets one table of fixed size. The
    lines are stored as lists, a row per text.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << RARITY_BITS, np.int64)
        for piece in pieces(batches, "text", TOGETHER):
            per_text, _, hashes, size = line_sets(piece.column("text"))
            counts += np.bincount((hashes >> np.uint64(64 - RARITY_BITS)).astype(np.int64), minlength=len(counts))
            ends = pa.array(np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32))
            columns = [piece.column("id"), piece.column("tie")]
            columns += [pa.ListArray.from_arrays(ends, pa.array(c)) for c in (*set_hashes(hashes, size), size.astype(np.int32))]
            columns += [pa.nulls(piece.num_rows, pa.int32()), pa.nulls(piece.num_rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)
        if counts.any():
            parts = np.minimum(counts, np.iinfo(np.uint16).max).astype("<u2").reshape(SLICES, -1)
            blobs = [zlib.compress(part.tobytes(), 1) for part in parts]
            empty = [pa.nulls(SLICES, t) for t in (pa.int64(), pa.int64(), *[pa.list_(t) for t in (pa.int64(), pa.int64(), pa.int32())])]
            yield pa.RecordBatch.from_arrays([*empty, pa.array(range(SLICES), pa.int32()), pa.array(blobs, pa.binary())], names)

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros((1 << RARITY_BITS) // SLICES, np.int64)
        for blob in group["counts"].to_pylist():
            total += np.frombuffer(zlib.decompress(blob), "<u2")
        whole = np.minimum(total, np.iinfo(np.uint32).max).astype("<u4")
        return pa.table({"slice": group["slice"][:1], "counts": pa.array([whole.tobytes()], pa.binary())})

    names = ["id", "tie", "c1", "c2", "size", "slice", "counts"]
    schema = "id long, tie long, c1 array<long>, c2 array<long>, size array<int>, slice int, counts binary"
    found = saved(documents.mapInArrow(scan, schema))
    added = found.where("counts is not null").groupBy("slice").applyInArrow(add, "slice int, counts binary")
    rarity = np.zeros((SLICES, (1 << RARITY_BITS) // SLICES), np.uint32)
    for r in added.collect():
        rarity[r["slice"]] = np.frombuffer(r["counts"], "<u4")
    lists = found.where("counts is null").select("id", "tie", F.posexplode(F.arrays_zip("c1", "c2", "size")).alias("line_no", "line"))
    return lists.select("id", "tie", "line_no", "line.*"), rarity.ravel()


def _first_of_class(c1: np.ndarray, wanted: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of ``wanted`` lines, each class once, without classes in the sorted ``seen``; and seen with them."""
    values, at = np.unique(c1[wanted], return_index=True)
    new = ~np.isin(values, seen, assume_unique=True)
    return wanted[at[new]], np.union1d(seen, values[new])


def _ranks(rarity: np.ndarray) -> np.ndarray:
    rank = np.empty(len(rarity), np.uint32)
    rank[np.argsort(rarity, kind="stable")] = np.arange(len(rarity), dtype=np.uint32)
    return rank


def _prefix_scan(rank: np.ndarray, threshold: float, lone: int = 0) -> Scan:
    """What makes the rows of ``prefixes`` of texts.

    prev stands for the word before, by 48 bits. Words in the buckets of the
    ``lone`` first ranks, which are those that stand in one line, are left out.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)
        for piece in pieces(batches, "text", TOGETHER):
            _, line, hashes, size = line_sets(piece.column("text"), rank)
            c1, _ = set_hashes(hashes, size)
            bits, tally = parities(hashes, size), tallies(line, hashes, size)
            once = np.zeros(len(size), bool)
            chosen, seen = _first_of_class(c1, np.flatnonzero(size), seen)
            once[chosen] = True
            place = np.arange(len(line)) - (np.cumsum(size) - size)[line]
            sent = once[line] & (place < (size - np.ceil(threshold * size - 1e-9) + 1)[line])
            sent = np.flatnonzero(sent)
            sent = sent[rank[(hashes[sent] >> np.uint64(64 - RARITY_BITS)).astype(np.int64)] >= lone]
            of = line[sent]
            prev = (hashes[np.maximum(sent - 1, 0)] & _SHORT).view(np.int64)
            columns = [pa.array(hashes[sent].view(np.int64)), pa.array(c1[of])]
            columns += [pa.array(size[of].astype(np.int32)), pa.array(place[sent].astype(np.int32)), pa.array(bits[of]), pa.array(tally[of]), pa.array(prev)]
            yield pa.RecordBatch.from_arrays(columns, ["token", "c1", "size", "place", "bits", "tally", "prev"])

    return scan


def prefixes(documents: DataFrame, rank: np.ndarray, threshold: float) -> DataFrame:
    """(token, c1, size, place, bits, tally, prev) of each class of lines: its rarest words, at their places in the order of rarity."""
    return documents.mapInArrow(_prefix_scan(rank, threshold), "token long, c1 long, size int, place int, bits long, tally long, prev long")


def _passes(rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of rows i (the shorter) and j may match through the word they share, as the first one they share.

    Two lines of similarity t share at least 2t / (1 + t) of the words of the
    shorter one, so that one is looked up by a still shorter prefix; they differ
    in at most (1 - t) / (1 + t) of both lines' words, and so in no more of
    their parity bits, and their tallies are no further apart; and through the first word they share, no more words than
    are left in either from there on. The word before it is not the same one.
    """
    size, place, bits, tally, prev = (rows[n] for n in ("size", "place", "bits", "tally", "prev"))
    share, both = threshold / (1 + threshold), size[i] + size[j]
    good = (place[i] <= size[i] - np.ceil(2 * share * size[i] - 1e-9)) & (size[i] >= threshold * size[j] - 1e-9)
    good &= np.bitwise_count((bits[i] ^ bits[j]).view(np.uint64)) <= (1 - 2 * share) * both + 1e-9
    good &= (prev[i] != prev[j]) | (place[i] == 0) | (place[j] == 0)
    good &= np.minimum(size[i] - place[i], size[j] - place[j]) >= share * both - 1e-9
    k = np.flatnonzero(good)
    k = k[(tally[i[k]] != 0) & (tally[j[k]] != 0)]
    good[k] = _apart(tally[i[k]], tally[j[k]]) <= (1 - 2 * share) * both[k] + 1e-9
    return good


def _active(rows: np.ndarray, group: np.ndarray, threshold: float) -> np.ndarray:
    """The places of rows, in order of group, size and class, that may match another row of their group."""
    size, place = rows["size"].astype(np.int64), rows["place"].astype(np.int64)
    columns = {"size": size, "place": place, "bits": rows["bits"], "tally": rows["tally"], "prev": rows["prev"]}
    longest = np.floor(size / threshold + 1e-9).astype(np.int64)
    # the end of the rows that are not too long: one search over (group, size)
    rank = group.astype(np.int64) << 32
    stop = np.searchsorted(rank + size, rank + longest, side="right")
    first = np.arange(len(rows))
    many = np.where(place <= size - np.ceil(2 * threshold / (1 + threshold) * size - 1e-9), stop - first - 1, 0)
    ends, used, start = np.cumsum(many), np.zeros(len(rows), bool), 0
    while start < len(rows):
        done = ends[start - 1] if start else 0
        upto = max(start + 1, int(np.searchsorted(ends, done + PAIRS, side="right")))
        i = np.repeat(first[start:upto], many[start:upto])
        j = np.arange(len(i)) - np.repeat(ends[start:upto] - many[start:upto] - done, many[start:upto]) + i + 1
        good = _passes(columns, i, j, threshold)
        used[i[good]] = used[j[good]] = True
        start = upto
    return np.flatnonzero(used)


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows, which come sorted by ``keys``, in tables that part no group."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        same = np.ones(table.num_rows, bool)
        for key in keys:
            column = np.asarray(table[key])
            same &= column == column[-1]
        cut = int(table.num_rows - np.argmin(same[::-1])) if not same.all() else 0
        held = table.slice(cut)
        if cut:
            yield table.slice(0, cut)
    if held is not None:
        yield held


def heavy_words(documents: DataFrame, rank: np.ndarray, threshold: float, block: int = SIFTED, every: int = EVERY) -> DataFrame:
    """(token, parts) of words with more than about ``block`` entries, told by one of ``every`` texts.

    It only says how to deal entries out: a word that it misses is sifted in one task, with the same result.
    """
    some = documents.where(F.pmod(F.xxhash64("id", "tie"), F.lit(every)) == 0)
    found = prefixes(some, rank, threshold).groupBy("token").agg((F.count_distinct("c1") * every).alias("n"))
    return saved(found.where(F.col("n") > block).select("token", F.least(F.ceil(F.col("n") / block), F.lit(1 << 15)).cast("int").alias("parts")))


def _cells(entries: DataFrame, heavy: DataFrame | None) -> DataFrame:
    """The entries with cell: 0, or for heavy words each two parts of them, so that any two entries meet in a cell."""
    if heavy is None:
        return entries.withColumn("cell", F.lit(0))
    mine = F.pmod(F.xxhash64("c1"), F.col("parts")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: o != F.col("mine"))
    pairs = F.transform(others, lambda o: F.shiftleft(F.least(o, F.col("mine")), 15) + F.greatest(o, F.col("mine")))
    dealt = entries.join(small_side(heavy), "token", "left").withColumn("mine", mine)
    cells = F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(pairs)
    return dealt.withColumn("cell", F.explode(cells)).drop("parts", "mine")


def _packed(names: list[str], buckets: int) -> Scan:
    """Entries as lists of their columns ``names``, a row for each of ``buckets`` of the last of them and some ten thousand entries."""
    group = names[-1]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def lists() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            bucket = (words.mix(np.asarray(table[group]).view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            first = np.flatnonzero(np.diff(bucket, prepend=-1))
            ends = pa.array(np.append(first, len(bucket)).astype(np.int32))
            columns = [pa.ListArray.from_arrays(ends, pa.array(np.asarray(table[n])[order])) for n in names]
            return pa.RecordBatch.from_arrays([pa.array(bucket[first]), *columns], ["bucket", *names])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= PACKED:
                yield lists()
        if held:
            yield lists()

    return pack


def _sifted(lists: DataFrame, names: list[str], threshold: float) -> DataFrame:
    """The entries, ``_packed``, that pass the filters of ``_passes`` with another of their group, each class once.

    A task goes through its buckets one by one. No pair leaves the task.
    """
    group = names[-1]

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, ["bucket"]):
            column = {n: pc.list_flatten(table[n]).to_numpy() for n in names}
            order = np.lexsort((column["c1"], column["size"], column[group]))
            rows = np.empty(len(order), KIND)
            for name in ENTRY:
                rows[name] = column[name][order]
            key = column[group][order]
            other = np.ones(len(rows), bool)
            other[1:] = key[1:] != key[:-1]
            new = other.copy()  # a class comes once from each task that found it
            new[1:] |= rows["c1"][1:] != rows["c1"][:-1]
            rows, number = rows[new], np.cumsum(other)[new]
            rows = rows[_active(rows, number, threshold)]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[n])) for n in ENTRY], ENTRY)

    dealt = lists.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(sift, ", ".join(f"{n} {TYPES[n]}" for n in ENTRY))


def _lists(names: list[str]) -> str:
    return "bucket int, " + ", ".join(f"{n} array<{TYPES.get(n, 'long')}>" for n in names)


def active_entries(entries: DataFrame, threshold: float, heavy: DataFrame | None = None, buckets: int = 64) -> DataFrame:
    """The entries that may match another of their word. Those of ``heavy`` words (token, parts) are dealt out by word and each two of its parts."""
    names = ENTRY
    if heavy is not None:
        # one number to deal by; should two cells ever share one, their rows are only looked at together
        entries = _cells(entries, heavy).withColumn("group", F.when(F.col("cell") == 0, F.col("token")).otherwise(F.xxhash64("token", "cell")))
        names = [*ENTRY, "group"]
    found = _sifted(entries.select(*names).mapInArrow(_packed(names, buckets), _lists(names)), names, threshold)
    return found if heavy is None else found.dropDuplicates(["token", "c1"])


def _shared(ordered: list[np.ndarray], place: np.ndarray, worth: int) -> tuple[np.ndarray, np.ndarray] | None:
    """For each two lines, how many words they share, and how many of those before their ``place``; None if that takes over ``worth``."""
    size = np.array([len(o) for o in ordered])
    line = np.repeat(np.arange(len(size)), size)
    _, word, times = np.unique(np.concatenate(ordered), return_inverse=True, return_counts=True)
    both = times[word] > 1
    before = (np.arange(len(line)) - np.repeat(np.cumsum(size) - size, size) < np.repeat(place, size))[both]
    line, word = line[both], (np.cumsum(times > 1) - 1)[word[both]]
    wide = int(np.count_nonzero(times > 1))
    if len(size) ** 2 * wide > worth:
        return None
    out = []
    for chosen in (np.ones(len(line), bool), before):
        total = np.zeros((len(size), len(size)), np.float32)
        for start in range(0, wide, WIDE):
            some = chosen & (word >= start) & (word < start + WIDE)
            has = np.zeros((len(size), min(WIDE, wide - start)), np.float32)
            has[line[some], word[some] - start] = 1
            total += has @ has.T
        out.append(total)
    return out[0], out[1]


def _good_pairs(rows: dict[str, np.ndarray], group: np.ndarray, pairs: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs within groups, by the first, that pass the filters; ``pairs`` is the part of a row that meets others only, or -1."""
    stop = np.searchsorted(group, group, side="right")
    first, found = np.arange(len(group)), []
    many = stop - first - 1
    ends, start = np.cumsum(many), 0
    while start < len(group):
        done = ends[start - 1] if start else 0
        upto = max(start + 1, int(np.searchsorted(ends, done + PAIRS, side="right")))
        i = np.repeat(first[start:upto], many[start:upto])
        j = np.arange(len(i)) - np.repeat(ends[start:upto] - many[start:upto] - done, many[start:upto]) + i + 1
        meet = (pairs[i] < 0) | (pairs[i] != pairs[j])
        i, j = i[meet], j[meet]
        less = rows["size"][i] <= rows["size"][j]
        short, long = np.where(less, i, j), np.where(less, j, i)
        good = _passes(rows, short, long, threshold)
        # either of two lines of one size may be the one that is looked up
        good |= (rows["size"][i] == rows["size"][j]) & _passes(rows, long, short, threshold)
        found.append((i[good], j[good]))
        start = upto
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _links_of(table: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a table of whole groups, their links and the row of the earliest line of them; a pair counts at the first word it shares."""
    rows = {n: np.asarray(table[n]).astype(np.int64) for n in ("size", "place", "bits", "tally", "prev")}
    size, place = rows["size"], rows["place"]
    token, low, high = (np.asarray(table[n]) for n in ("token", "low", "high"))
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    starts = np.flatnonzero(new)
    i, j = _good_pairs(rows, np.cumsum(new), np.where(low == high, -1, np.asarray(table["part"])), threshold)
    sets = table["words"].to_pylist()

    def words_of(k: int) -> np.ndarray:
        out = np.zeros((len(sets[k]) // 6, 8), np.uint8)
        out[:, :6] = np.frombuffer(sets[k], np.uint8).reshape(-1, 6)
        return out.view("<u8").ravel()

    linked = np.zeros(len(i), bool)
    bounds = np.searchsorted(i, [*starts.tolist(), len(token)])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if a == b:
            continue
        members, at = np.unique(np.concatenate([i[a:b], j[a:b]]), return_inverse=True)
        x, y = at[: b - a], at[b - a :]
        lists = [words_of(k) for k in members.tolist()]
        if b - a >= FEW and (dense := _shared(lists, place[members], WORTH * (b - a))):
            common, before = dense[0][x, y], dense[1][x, y]
        else:
            held, ahead = [set(w.tolist()) for w in lists], [set(w[:p].tolist()) for w, p in zip(lists, place[members].tolist(), strict=True)]
            both = list(zip(x.tolist(), y.tolist(), strict=True))
            common = np.array([len(held[m] & held[n]) for m, n in both])
            before = np.array([not ahead[m].isdisjoint(ahead[n]) for m, n in both])
        linked[a:b] = (common >= threshold * (size[i[a:b]] + size[j[a:b]] - common) - 1e-9) & (before == 0)
    one, other = np.concatenate([i[linked], j[linked]]), np.concatenate([j[linked], i[linked]])
    order = np.lexsort([np.asarray(pc.fill_null(table[n], 0)) for n in ("line_no", "tie", "id")] + [np.asarray(table["id"].is_valid())])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    best = np.full(len(token), len(token))
    np.minimum.at(best, one, rank[other])
    links = np.bincount(one, minlength=len(token))
    found = np.flatnonzero(links)
    return found, links[found], order[best[found]]


def line_links(documents: DataFrame, firsts: DataFrame, rarity: np.ndarray, threshold: float, block: int = BLOCK) -> DataFrame:
    """(c1, c2, links, other): for classes with a link, how many other classes reach the threshold, and the earliest line of them.

    ``firsts`` has c1, c2 and first (id, tie, line_no). The active entries take
    in their line's words, are dealt out again by word, and compared inside the
    tasks: each two of up to ``block`` rows of a word. What leaves a task is one
    row per class, however many links it has.
    """
    rank, lone = _ranks(rarity), int(np.count_nonzero(rarity < 2))
    heavy = heavy_words(documents, rank, threshold)
    heavy = None if heavy.isEmpty() else heavy
    # a line of n words has about (1 - threshold) n entries
    buckets = max(64, int(rarity.sum(dtype=np.float64) * (1 - threshold)) // BUCKET)
    if heavy is None:
        scanned, pack = _prefix_scan(rank, threshold, lone), _packed(ENTRY, buckets)
        active = saved(_sifted(documents.mapInArrow(lambda batches: pack(scanned(batches)), _lists(ENTRY)), ENTRY, threshold))
    else:
        active = saved(active_entries(prefixes(documents, rank, threshold), threshold, heavy, buckets))
    cleaned(documents.sparkSession)
    wanted = packed(active.select("c1").distinct())
    # where each wanted class stands first, and a filter of those places
    place = F.coalesce("id", F.lit(0)).cast("long"), F.col("tie"), F.col("line_no").cast("long")
    place = F.shiftleft(place[0], 12).bitwiseXOR(place[1]).bitwiseXOR(place[2])
    at = packed(firsts.join(small_side(wanted), "c1", "left_semi").select("c1", "c2", "first.*").withColumn("place", place))
    bloom = bitmap(at, "place")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)
        for piece in pieces(batches, "text", TOGETHER):
            lists = pc.split_pattern(pc.fill_null(piece.column("text"), ""), "\n")
            per_text = np.asarray(pc.list_value_length(lists), dtype=np.int64)
            number = np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text)
            spot = (np.asarray(pc.fill_null(piece.column("id"), 0)) << 12) ^ np.asarray(piece.column("tie"))
            lines = pc.list_flatten(lists).filter(pa.array(in_bitmap(bloom, np.repeat(spot, per_text) ^ number)))
            line, hashes, size = word_sets(lines, rank)
            c1, c2 = set_hashes(hashes, size)
            chosen, seen = _first_of_class(c1, np.flatnonzero(size), seen)
            ends = np.cumsum(size)
            short = np.ascontiguousarray(hashes.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6]
            sets = [short[ends[k] - size[k] : ends[k]].tobytes() for k in chosen]
            columns = [pa.array(c1[chosen]), pa.array(c2[chosen]), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["c1", "c2", "words"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, ["token", "low", "high"]):
            found, links, other = _links_of(table, threshold)
            columns = [table["c1"].take(found), table["c2"].take(found), pa.array(links)]
            columns += [table[n].take(other) for n in ("id", "tie", "line_no")]
            yield from pa.table(columns, names=["c1", "c2", "links", "id", "tie", "line_no"]).to_batches()

    parts = F.ceil(F.coalesce("n", F.lit(1)) / block).cast("int")
    counts = packed(active.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block))
    entry = F.struct("token", "size", "place", "bits", "tally", "prev", parts.alias("parts"))
    asked = active.join(small_side(counts), "token", "left").groupBy("c1").agg(F.collect_list(entry).alias("entries"))
    # the words of a line meet its entries once, and are then dealt out by the words through which it may match
    asked = asked.join(at.drop("place"), "c1")
    sets = documents.mapInArrow(scan, "c1 long, c2 long, words binary").dropDuplicates(["c1", "c2"]).join(asked, ["c1", "c2"])
    placed = sets.select("c1", "c2", "id", "tie", "line_no", "words", F.explode("entries").alias("e")).select("*", "e.*").drop("e")
    mine = F.pmod(F.xxhash64("c1"), F.col("parts")).cast("int")
    placed = placed.select("*", mine.alias("part"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("_o"))
    placed = placed.select("*", F.least("part", "_o").alias("low"), F.greatest("part", "_o").alias("high")).drop("parts", "_o")
    dealt = placed.repartition("token", "low", "high").sortWithinPartitions("token", "low", "high")
    found = dealt.mapInArrow(compare, "c1 long, c2 long, links long, id long, tie long, line_no int")
    return found.groupBy("c1", "c2").agg(F.sum("links").alias("links"), F.min(F.struct("id", "tie", "line_no")).alias("other"))


def repeated_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per distinct (id, text): id, tie (a hash of the text), n_lines, n_removed, n_links, removed.

    Lines are parted by a newline. A line is removed if an earlier one, by id,
    tie and line number, has a Jaccard of ``threshold`` or more with it over
    their sets of words (lower-case runs of letters and digits); whether that
    one is removed itself does not matter. removed has the numbers, from 0, in
    order; n_links counts, over the text's lines, the other sets of words each
    is linked with. Lines without words are never removed. A null text is one
    empty line; a null id comes first; rows that repeat id and text are one.
    """
    documents = _documents(docs, id, text)
    lines, rarity = occurrences(documents)
    at = F.struct("id", "tie", "line_no")
    worded = lines.where("size > 0")
    firsts = worded.groupBy("c1", "c2").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n"))
    linked = line_links(documents, firsts, rarity, threshold)
    special = firsts.join(linked, ["c1", "c2"], "left").where("n > 1 or links is not null")
    special = saved(special.select("c1", "c2", "first", "links", F.coalesce(F.col("other") < F.col("first"), F.lit(False)).alias("later")))
    cleaned(docs.sparkSession)
    bloom = bitmap(special, "c1")

    def sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(bloom, np.array(batch.column("c1")))))

    # most lines stand alone: only those that may be in a special class are joined
    some = worded.drop("size")
    some = some.mapInArrow(sieve, some.schema)
    judged = some.join(small_side(special), ["c1", "c2"]).withColumn("gone", F.col("later") | ~at.eqNullSafe(F.col("first")))
    judged = judged.groupBy("id", "tie").agg(
        F.coalesce(F.sum("links"), F.lit(0)).cast("long").alias("n_links"),
        F.array_sort(F.collect_set(F.when(F.col("gone"), F.col("line_no")))).alias("removed"),
    )
    whole = lines.groupBy("id", "tie").agg((F.max("line_no") + 1).cast("long").alias("n_lines"), F.count(F.lit(1)).alias("_rows"))
    judged = judged.withColumnsRenamed({"id": "_id", "tie": "_tie"})
    found = whole.join(judged, F.col("id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie")), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    # a text whose row is repeated has each of its lines as many times
    return found.select(
        "id",
        "tie",
        "n_lines",
        F.size(removed).cast("long").alias("n_removed"),
        F.expr("coalesce(n_links, 0) div (_rows div n_lines)").alias("n_links"),
        removed.alias("removed"),
    )


def drop_repeated_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the removed lines left out of the text; all rows and columns stay, a null text stays null."""
    found = repeated_lines(docs, id, text, threshold).where("n_removed > 0")
    found = saved(found.select(F.col("id").alias("_id"), F.col("tie").alias("_tie"), "removed"))
    marked = beside(docs, id=F.col(id).cast("long"), tie=F.xxhash64(text))
    joined = marked.join(small_side(found, 20_000), (F.col("tie") == F.col("_tie")) & F.col("id").eqNullSafe(F.col("_id")), "left")
    content = F.col(f"row.{text}")
    kept = F.filter(F.split(content, "\n", -1), lambda _, i: ~F.array_contains("removed", i))
    whole = F.when(F.col("removed").isNull(), content).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[whole.alias(c) if c == text else F.col(f"row.{c}") for c in docs.columns])


def op1_line_dedup(spark, folder: str) -> DataFrame:
    """Every document with the lines that repeat an earlier one, nearly or exactly."""
    docs = table(spark, folder, "documents")
    found = repeated_lines(docs)
    rows = docs.select("doc_id", F.xxhash64("text").alias("_tie"))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("_tie") == F.col("tie")))
    return joined.select("doc_id", "n_lines", "n_removed", "n_links", F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"))
