"""WARC archives: one gzip member per record, written from rows and read back front to back.

The reader inflates a member piece by piece, frames its record by the
content-length, and checks the block's digest and the payload's. Memory is one
read buffer and, only where payloads are asked for, one payload.
"""

from __future__ import annotations

import base64
import dataclasses
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.shared import pieces, saved, small_side, table
from caseloom.sources.lineage import new_path

#: fixed values of the format
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: ``pages`` has no capture time
DATE = "1970-01-01T00:00:00Z"
LEVEL = 6
_READ = 1 << 20
_PRINTABLE = "".join(map(chr, range(0x21, 0x7F)))


def digest_text(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisits: bool, refers_to: int | None) -> bytes:
    """One record: an HTTP response, or a revisit that holds the response's headers and no payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisits:
        block += payload
    fields = [("WARC-Type", "revisit" if revisits else "response"), ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", DATE)]
    fields.append(("WARC-Target-URI", f"urn:page:{page_id}" if url is None else quote(url, safe=_PRINTABLE)))
    fields += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    fields.append(("WARC-Block-Digest", f"sha1:{digest_text(hashlib.sha1(block).digest())}"))
    if revisits:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest))]
        fields.append(("Refers-To-Page-ID", str(refers_to)))
    if page_id is not None:
        fields.append(("Page-ID", str(page_id)))
    fields.append(("Content-Length", str(len(block))))
    head = "\r\n".join([VERSION, *(f"{k}: {v}" for k, v in fields)])
    return head.encode("ascii") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member without a time, so the same record is the same bytes."""
    deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


@dataclasses.dataclass
class Record:
    fields: dict[str, str]
    payload_bytes: int
    payload_digest: str
    payload: bytes | None


class _Member:
    """The bytes of one gzip member, inflated as they are asked for."""

    def __init__(self, stream, rest: bytes, name: str):
        self.stream, self.raw, self.name = stream, rest, name
        self.inflate, self.ready = zlib.decompressobj(31), b""

    def more(self) -> bool:
        """Inflate up to one buffer more; false at the member's end."""
        if self.inflate.eof:
            return False
        if not self.raw:
            self.raw = self.stream.read(_READ)
            if not self.raw:
                raise ValueError(f"{self.name}: the last member is cut off")
        try:
            self.ready += self.inflate.decompress(self.raw, _READ)
        except zlib.error as e:
            raise ValueError(f"{self.name}: {e}") from e
        self.raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        start = 0
        while (at := self.ready.find(mark, start)) < 0:
            start = max(0, len(self.ready) - len(mark) + 1)
            if not self.more():
                raise ValueError(f"{self.name}: a record's header does not end")
        out, self.ready = self.ready[:at], self.ready[at + len(mark) :]
        return out

    def blocks(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.ready and not self.more():
                raise ValueError(f"{self.name}: a record is shorter than its content-length")
            out, self.ready = self.ready[:n], self.ready[n:]
            n -= len(out)
            if out:
                yield out

    def finish(self) -> None:
        while self.more():
            pass
        if self.ready != b"\r\n\r\n":
            raise ValueError(f"{self.name}: a record is not as long as its content-length")


def _parse(part: _Member, payloads: bool) -> Record:
    lines = part.until(b"\r\n\r\n").decode("utf-8").split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"{part.name}: not a {VERSION} record: {lines[0]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    length = int(fields["Content-Length"])
    of_block, of_payload, head, in_head, size, kept = hashlib.sha1(), hashlib.sha1(), b"", True, 0, []
    for data in part.blocks(length):
        of_block.update(data)
        if in_head:
            head += data
            if (at := head.find(b"\r\n\r\n")) < 0:
                continue
            head, data, in_head = head[:at], head[at + 4 :], False
        of_payload.update(data)
        size += len(data)
        if payloads:
            kept.append(data)
    part.finish()
    if fields["WARC-Block-Digest"] != f"sha1:{digest_text(of_block.digest())}":
        raise ValueError(f"{part.name}: the block of {fields['WARC-Record-ID']} does not match its digest")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "revisit":
        http = dict(line.split(": ", 1) for line in head.decode("ascii").split("\r\n")[1:])
        return Record(fields, int(http["Content-Length"]), digest, None)
    if digest != digest_text(of_payload.digest()):
        raise ValueError(f"{part.name}: the payload of {fields['WARC-Record-ID']} does not match its digest")
    return Record(fields, size, digest, b"".join(kept) if payloads else None)


def read_archive(uri: str, payloads: bool = False) -> Iterator[Record]:
    """The records of one archive in order, verified."""
    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_stream(path, compression=None) as stream:
        rest = stream.read(_READ)
        while rest:
            part = _Member(stream, rest, uri)
            yield _parse(part, payloads)
            rest = part.raw or stream.read(_READ)


def with_revisits(pages: DataFrame, id: str, url: str, html: str, least: int) -> DataFrame:
    """id, url and html of ``pages`` with _sha1 (hex), _revisits and _refers_to.

    Of rows whose payload has ``least`` bytes or more and the same digest, the
    one of the largest id is the response, the others revisit it. Rows that
    repeat the largest id are responses too; a null id counts as smallest.
    """
    pages = pages.select(*dict.fromkeys([id, url, html]))
    keyed = pages.withColumn("_sha1", F.sha1(F.coalesce(F.col(html), F.lit("")).cast("binary")))
    long_enough = F.octet_length(F.coalesce(F.col(html), F.lit(""))) >= least
    groups = keyed.where(long_enough).groupBy("_sha1").agg(F.max(id).alias("_refers_to"), F.count(F.lit(1)).alias("_n"))
    groups = saved(groups.where("_n > 1 and _refers_to is not null").select("_sha1", "_refers_to"))
    revisits = F.coalesce(~F.col(id).eqNullSafe(F.col("_refers_to")) & F.col("_refers_to").isNotNull(), F.lit(False))
    return keyed.join(small_side(groups), "_sha1", "left").withColumn("_revisits", revisits)


def write_warc(
    pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", html: str = "html", least: int = 0
) -> DataFrame:
    """Write a record per row under ``folder``; returns the manifest, saved: file, n_records, n_bytes.

    One archive per partition, named by its task attempt; what a lost attempt
    leaves is in no manifest. A null page is an empty payload; a null url is
    written as one made of the id; control and non-ASCII characters of a url are
    percent-encoded.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{folder}/part-{TaskContext.get().partitionId():06d}-{TaskContext.get().taskAttemptId()}.warc.gz"
        out, n_records, n_bytes = None, 0, 0
        try:
            for piece in pieces(batches, "html"):
                if out is None:
                    system, path = fs.FileSystem.from_uri(name)
                    system.create_dir(fs.FileSystem.from_uri(folder)[1], recursive=True)
                    out = system.open_output_stream(path, compression=None)
                for page, at, payload, sha1, revisits, to in zip(*(piece.column(i).to_pylist() for i in range(6)), strict=True):
                    digest = digest_text(bytes.fromhex(sha1))
                    done = member(record(page, at, payload or b"", digest, revisits, to))
                    out.write(done)
                    n_records, n_bytes = n_records + 1, n_bytes + len(done)
        finally:
            if out is not None:
                out.close()
        if n_records:
            yield pa.RecordBatch.from_pydict({"file": [name], "n_records": [n_records], "n_bytes": [n_bytes]})

    rows = with_revisits(pages, id, url, html, least).select(
        F.col(id).cast("long").alias("id"), F.col(url).alias("url"), F.col(html).cast("binary").alias("html"), "_sha1", "_revisits", "_refers_to"
    )
    return saved(rows.mapInArrow(write, "file string, n_records long, n_bytes long"))


def read_warc(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """Per record of the archives of a manifest: page_id, uri, payload_bytes, payload_digest, record_type, refers_to.

    One archive a task. ``payloads`` adds the payload, null for revisits. A
    record that does not match its length or digests fails the job.
    """
    names = ["page_id", "uri", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    if payloads:
        names, types = [*names, "payload"], [*types, pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, expected in zip(batch.column("file").to_pylist(), batch.column("n_records").to_pylist(), strict=True):
                rows, held, n = [], 0, 0
                for r in read_archive(file, payloads):
                    page, to = r.fields.get("Page-ID"), r.fields.get("Refers-To-Page-ID")
                    row = (page and int(page), r.fields["WARC-Target-URI"], r.payload_bytes, r.payload_digest, r.fields["WARC-Type"], to and int(to))
                    rows.append((*row, r.payload) if payloads else row)
                    n, held = n + 1, held + len(r.payload or b"")
                    if len(rows) == 10_000 or held > 8 << 20:
                        yield _batch(rows, names, types)
                        rows, held = [], 0
                if n != expected:
                    raise ValueError(f"{file}: {n} records, the manifest has {expected}")
                yield _batch(rows, names, types)

    schema = "page_id long, uri string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    n = max(1, manifest.count())
    spread = manifest.repartitionByRange(n, "file")
    return spread.mapInArrow(read, schema + (", payload binary" if payloads else ""))


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def op3_warc(spark, folder: str) -> DataFrame:
    """Every page, written to WARC archives in the shared folder and read back."""
    manifest = write_warc(table(spark, folder, "pages"), new_path(spark, "warc"))
    return read_warc(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: SHA-1 is 160 bits, 32 groups of 5: the digits of the hex string as binary, cut in fives
OP3_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (SELECT hex, array_to_string([substr('0000000100100011010001010110011110001001101010111100110111101111',
    1 + 4 * (instr('0123456789abcdef', x) - 1), 4) FOR x IN string_split(hex, '')], '') AS b FROM (SELECT DISTINCT hex FROM p)),
d AS (SELECT hex, array_to_string([substr('{_B32}', 1 + (16 * substr(b, i, 1)::INT + 8 * substr(b, i + 1, 1)::INT
    + 4 * substr(b, i + 2, 1)::INT + 2 * substr(b, i + 3, 1)::INT + substr(b, i + 4, 1)::INT)::INT, 1)
    FOR i IN range(1, 160, 5)], '') AS payload_digest FROM bits),
m AS (SELECT hex, max(page_id) AS top FROM p GROUP BY hex)
SELECT page_id, strlen(payload) AS payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM p JOIN d USING (hex) JOIN m USING (hex)
"""
