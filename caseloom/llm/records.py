"""Files of length-delimited binary records with masked CRC-32C checksums, and their offset index.

A record is its length (8 bytes), the masked checksum of those bytes (4), the
data, and the masked checksum of the data (4), all little-endian. The index
file holds, for each record in order, its byte offset and its id; see ``INDEX``.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
from pyarrow import fs

#: fixed values of the format: the Castagnoli polynomial (reflected) and the mask
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8

#: one index entry: offset of the record, its id, whether it has an id
INDEX = np.dtype([("offset", "<u8"), ("id", "<i8"), ("has_id", "u1")])
_SEGMENT = 256
_READ = 8 << 20


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """CRC-32C of every pair of bytes, and what 256 zero bytes do to each byte of a state."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), one >> np.uint32(1))
    two = np.arange(65536, dtype=np.uint32)
    for _ in range(2):
        two = one[two & 0xFF] ^ (two >> np.uint32(8))
    shift = (np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]).astype(np.uint32)
    for _ in range(_SEGMENT):
        shift = one[shift & 0xFF] ^ (shift >> np.uint32(8))
    return two, shift


def crc32c(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC-32C of each of many byte strings laid end to end in ``data``; each has 4 bytes at least.

    All strings advance together, two bytes a step, in segments of 256 bytes
    filled up with zeros in front, which leave a zero state as it is.
    """
    if not len(lengths):
        return np.zeros(0, np.uint32)
    two, shift = _tables()
    starts = np.cumsum(lengths) - lengths
    segments = -(-lengths // _SEGMENT)
    ends = np.cumsum(segments)
    padded = np.zeros(int(ends[-1]) * _SEGMENT, np.uint8)
    to = np.repeat(ends * _SEGMENT - lengths - starts, lengths) + np.arange(len(data))
    padded[to] = data
    head = (ends * _SEGMENT - lengths)[:, None] + np.arange(4)
    padded[head] ^= np.uint8(0xFF)
    columns = np.ascontiguousarray(padded.view("<u2").reshape(-1, _SEGMENT // 2).T).astype(np.uint32)
    state = np.zeros(columns.shape[1], np.uint32)
    for column in columns:
        state = two[(state ^ column) & np.uint32(0xFFFF)] ^ (state >> np.uint32(16))
    first = ends - segments
    out = state[first]
    order = np.argsort(-segments, kind="stable")
    deepest = segments[order]
    for k in range(1, int(deepest[0])):
        at = order[: int(np.searchsorted(-deepest, -k, side="left"))]
        s = out[at]
        moved = shift[0][s & 0xFF] ^ shift[1][(s >> np.uint32(8)) & 0xFF] ^ shift[2][(s >> np.uint32(16)) & 0xFF] ^ shift[3][s >> np.uint32(24)]
        out[at] = moved ^ state[first[at] + k]
    return out ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    turned = (crc >> np.uint32(15)) | (crc << np.uint32(17))
    return (turned.astype(np.uint64) + np.uint64(MASK_DELTA)).astype(np.uint32)


def checksums(parts: list[bytes]) -> np.ndarray:
    return masked(crc32c(np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts], np.int64)))


def frame(parts: list[bytes]) -> list[bytes]:
    """Each part as one record."""
    sizes = [struct.pack("<Q", len(p)) for p in parts]
    of_size, of_data = checksums(sizes), checksums(parts)
    return [b"".join((s, struct.pack("<I", a), p, struct.pack("<I", b))) for s, a, p, b in zip(sizes, of_size.tolist(), parts, of_data.tolist(), strict=True)]


def _checked(parts: list[bytes], expected: list[int], sizes: list[bytes], of_size: list[int], file: str) -> list[bytes]:
    if checksums(sizes).tolist() != of_size or checksums(parts).tolist() != expected:
        raise ValueError(f"{file}: a record's checksum does not match its bytes")
    return parts


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or absolute path, and the path in it."""
    return fs.FileSystem.from_uri(uri)


def read_records(uri: str) -> Iterator[list[bytes]]:
    """All records of a file in order, verified, in lists of a few MB."""
    system, path = open_fs(uri)
    with system.open_input_stream(path, compression=None) as stream:
        rest = b""
        while block := stream.read(_READ):
            rest += block
            at, parts, data_sums, sizes, size_sums = 0, [], [], [], []
            while at + 12 <= len(rest):
                n, of_size = struct.unpack_from("<QI", rest, at)
                if at + 16 + n > len(rest):
                    break
                sizes.append(rest[at : at + 8])
                size_sums.append(of_size)
                parts.append(rest[at + 12 : at + 12 + n])
                data_sums.append(struct.unpack_from("<I", rest, at + 12 + n)[0])
                at += 16 + n
            rest = rest[at:]
            if parts:
                yield _checked(parts, data_sums, sizes, size_sums, uri)
        if rest:
            raise ValueError(f"{uri}: the last record is cut off")


def read_index(uri: str) -> np.ndarray:
    system, path = open_fs(uri)
    with system.open_input_stream(path, compression=None) as stream:
        return np.frombuffer(stream.read(), INDEX)


def read_at(uri: str, offsets: np.ndarray) -> list[bytes]:
    """The records at the given byte offsets, in the order asked for, verified: a shuffled read."""
    system, path = open_fs(uri)
    parts, data_sums, sizes, size_sums = [], [], [], []
    with system.open_input_file(path) as file:
        for offset in np.asarray(offsets).tolist():
            head = file.read_at(12, offset)
            n, of_size = struct.unpack("<QI", head)
            body = file.read_at(n + 4, offset + 12)
            sizes.append(head[:8])
            size_sums.append(of_size)
            parts.append(body[:n])
            data_sums.append(struct.unpack("<I", body[n:])[0])
    return _checked(parts, data_sums, sizes, size_sums, uri)
