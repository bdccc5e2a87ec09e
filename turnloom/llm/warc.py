"""WARC records in seekable Zstandard bundles.

A bundle is one archive: records are grouped into independent Zstandard frames of
about `FRAME_BYTES`, then come a skippable frame with the record index (record id ->
frame number, offset and length within the frame) and, as the footer, a skippable
frame with the seek table (compressed and decompressed size of every frame) in the
public seekable format.  A reader takes the table from the end of the file and
decompresses no frame but the one it needs (`lookup`).

Archives are rows of a table (archive_id, archive): Spark's own writer commits them,
so a retried task leaves no partial archive, and any store Spark reaches will do.
`export` writes one as a .warc.zst file.

Of records whose payloads are equal and of at least `MIN_REVISIT` bytes, the one
with the least page_id is a response; the others are revisits without a payload, that
carry its digest and length.  The least id of a payload is a partial aggregate
joined back on the digest, so a common payload is no hot group.

Defined results: a null html is an empty payload; repeated rows of the least page_id
are all responses; a null page_id is written as a response and read back as null;
extra columns are ignored; an empty table gives no archive and no row.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

FRAME_BYTES = 256 * 1024
ARCHIVE_BYTES = 8 * 1024 * 1024
MIN_REVISIT = 100
LEVEL = 3
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
PAGES = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, digest: str) -> tuple[bytes, bytes]:
    """(record id, bytes of the WARC 1.1 record)."""
    rid = b"<urn:page:%s>" % (b"" if page_id is None else b"%d" % page_id)
    head = [b"WARC/1.1", b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"), b"WARC-Record-ID: " + rid]
    if url is not None:
        head.append(b"WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A").encode())
    head.append(b"WARC-Payload-Digest: sha256:" + digest.encode())
    body = payload
    if refers_to is not None:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"WARC-Refers-To: <urn:page:%d>" % refers_to, b"X-Payload-Length: %d" % len(payload)]
        body = b""
    head += [b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(body)]
    return rid, b"\r\n".join(head) + b"\r\n\r\n" + body + b"\r\n\r\n"


def _skippable(magic: int, data: bytes) -> bytes:
    return struct.pack("<II", magic, len(data)) + data


class Bundle:
    """Collects records and closes into one archive."""

    def __init__(self) -> None:
        self.frames: list[tuple[bytes, int]] = []
        self.index: list[tuple[bytes, int, int, int]] = []
        self.open, self.filled, self.total = [], 0, 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)

    def add(self, rid: bytes, data: bytes) -> None:
        self.index.append((rid, len(self.frames), self.filled, len(data)))
        self.open.append(data)
        self.filled += len(data)
        self.total += len(data)
        if self.filled >= FRAME_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.open:
            self.frames.append((self.packer.compress(b"".join(self.open)), self.filled))
            self.open, self.filled = [], 0

    def close(self) -> bytes:
        self._flush()
        index = b"".join(struct.pack("<HIII", len(rid), frame, at, size) + rid for rid, frame, at, size in self.index)
        seek = b"".join(struct.pack("<II", len(z), n) for z, n in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        return b"".join(z for z, _ in self.frames) + _skippable(SKIPPABLE_INDEX, zstandard.compress(index)) + _skippable(SKIPPABLE_SEEK, seek)


class Reader:
    """Random access to an archive by its footer."""

    def __init__(self, archive: bytes | memoryview) -> None:
        self.archive = memoryview(archive)
        n, flags, magic = struct.unpack("<IBI", self.archive[-9:])
        if magic != SEEKABLE or flags:
            raise ValueError("not a seekable archive: no seek table at its end")
        size = 8 * n + 9
        if struct.unpack("<II", self.archive[-size - 8 : -size]) != (SKIPPABLE_SEEK, size):
            raise ValueError("the seek table is damaged")
        self.starts, at = [], 0
        for z, _n in struct.iter_unpack("<II", self.archive[-size:-9]):
            self.starts.append((at, at + z))
            at += z
        magic, length = struct.unpack("<II", self.archive[at : at + 8])
        if magic != SKIPPABLE_INDEX:
            raise ValueError("the record index is missing")
        self.raw_index = zstandard.decompress(bytes(self.archive[at + 8 : at + 8 + length]))
        self._held: tuple[int, bytes] = (-1, b"")

    def frame(self, i: int) -> bytes:
        if self._held[0] != i:
            a, b = self.starts[i]
            self._held = (i, zstandard.ZstdDecompressor().decompress(self.archive[a:b]))
        return self._held[1]

    def index(self) -> Iterator[tuple[bytes, int, int, int]]:
        at = 0
        while at < len(self.raw_index):
            n, frame, offset, size = struct.unpack_from("<HIII", self.raw_index, at)
            yield self.raw_index[at + 14 : at + 14 + n], frame, offset, size
            at += 14 + n

    def records(self) -> Iterator[tuple[bytes, bytes]]:
        for rid, frame, offset, size in self.index():
            yield rid, self.frame(frame)[offset : offset + size]


def lookup(archive: bytes, page_id: int) -> bytes | None:
    """The WARC record of a page, by one frame's decompression; None where it isn't in the archive."""
    reader, want = Reader(archive), b"<urn:page:%d>" % page_id
    return next((reader.frame(f)[o : o + n] for rid, f, o, n in reader.index() if rid == want), None)


def export(archives: DataFrame, archive_id: str, path: str) -> None:
    """Write one archive as a .warc.zst file on a file system this process sees."""
    row = archives.where(F.col("archive_id") == archive_id).first()
    if row is None:
        raise KeyError(archive_id)
    with open(path, "wb") as f:
        f.write(row["archive"])


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    body = rest[: int(fields["Content-Length"])]
    return fields, body


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def done(bundle: Bundle, name: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(bundle.index)], pa.int64()), pa.array([bundle.close()], pa.binary())], names=["archive_id", "n_records", "archive"])

    bundle, name, n = None, "", 0
    for batch in batches:
        ids, urls, htmls, refs, digests = (batch.column(c) for c in ("page_id", "url", "html", "refers_to", "digest"))
        for i in range(batch.num_rows):
            rid, data = record(ids[i].as_py(), urls[i].as_py(), (htmls[i].as_py() or "").encode(), refs[i].as_py(), digests[i].as_py())
            if bundle is None:
                bundle, n = Bundle(), n + 1
                # partitions may begin with equal records: the place tells their archives apart
                name = f"{TaskContext.get().partitionId():06d}-{n:04d}-{hashlib.sha256(data).hexdigest()[:16]}"
            bundle.add(rid, data)
            if bundle.total >= ARCHIVE_BYTES:
                yield done(bundle, name)
                bundle = None
    if bundle is not None:
        yield done(bundle, name)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive in batch.column("archive"):
            rows = []
            for rid, data in Reader(archive.as_buffer()).records():
                fields, body = parse(data)
                digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                if fields["WARC-Record-ID"].encode() != rid:
                    raise ValueError(f"the index names {rid!r} where {fields['WARC-Record-ID']} lies")
                revisit = fields["WARC-Type"] == "revisit"
                if not revisit and hashlib.sha256(body).hexdigest() != digest:
                    raise ValueError(f"damaged payload in {rid!r}")
                name = rid[10:-1]
                refers = int(fields["WARC-Refers-To"][10:-1]) if revisit else None
                rows.append((int(name) if name else None, int(fields["X-Payload-Length"]) if revisit else len(body), digest, fields["WARC-Type"], refers))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def write_archives(pages: DataFrame) -> DataFrame:
    """(archive_id, n_records, archive) of pages (page_id, url, html), as a table in the shared folder."""
    pages = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    pages = pages.withColumn("digest", F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256))
    large = pages.where(F.octet_length("html") >= MIN_REVISIT).select("page_id", "digest")
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("page_id").alias("c")).where("c > 1").select("digest", "first")
    # only revisits: (page_id, digest) pairs that are not the least of their payload
    revisits = large.join(firsts, "digest").where("page_id <> first").select("page_id", "digest", F.col("first").alias("refers_to")).distinct()
    out = pages.join(revisits, ["page_id", "digest"], "left")
    return cut(out.mapInArrow(_pack, "archive_id string, n_records bigint, archive binary"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to; payloads are verified."""
    return archives.select("archive").mapInArrow(_unpack, PAGES)
