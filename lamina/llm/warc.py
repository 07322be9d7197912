"""Seekable Zstandard WARC bundles.

Records are grouped into independent Zstandard frames; a bundle ends with a skippable frame
that holds the seek table (compressed and decompressed size of every frame, the layout of
the public Zstandard seekable format). The index maps a record id to its frame and the
offset inside that frame, so one record is read by decompressing one frame.

Records with equal payloads of ``min_revisit`` bytes or more: the smallest key is the
response, the others are revisits that refer to it. A revisit stores no payload; the full
payload's digest and length stand in its headers.

Defined edge cases: a null payload counts as empty; a null url is written as an empty target
URI; repeated keys give one record per row (of rows with the smallest key in a group every
one is a response); an empty table gives no bundle and no row; a null key
is written and read as such and makes a response; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# Fixed values of the seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1

BUNDLE = "bundle_id string, archive binary, record_ids array<string>, frames array<int>, offsets array<int>"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(key: int | None) -> str:
    return f"urn:page:{'' if key is None else key}"


def key_of(name: str) -> int | None:
    return int(name.rpartition(":")[2]) if name[-1] != ":" else None


def record(key: int | None, url: str, payload: bytes, refers_to: int | None, sha: bytes | None = None, size: int | None = None) -> bytes:
    """One WARC/1.1 record; refers_to: the response's key for a revisit, whose full payload has the given digest and size."""
    kind = "response" if refers_to is None else "revisit"
    block = payload if refers_to is None else b""
    named = digest(payload) if sha is None else base64.b32encode(sha).decode()
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id(key)}>", "WARC-Date: 2020-01-01T00:00:00Z",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{named}", f"X-Payload-Length: {len(payload) if size is None else size}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{record_id(refers_to)}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Bundle:
    """Writes records into frames of about frame_bytes, then the seek table."""

    def __init__(self, frame_bytes: int = 1 << 18, level: int = 3):
        self.frame_bytes, self.pack = frame_bytes, zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.out, self.sizes, self.open = bytearray(), [], bytearray()
        self.ids: list[str] = []
        self.frames: list[int] = []
        self.offsets: list[int] = []

    def add(self, name: str, data: bytes) -> None:
        self.ids.append(name)
        self.frames.append(len(self.sizes))
        self.offsets.append(len(self.open))
        self.open += data
        if len(self.open) >= self.frame_bytes:
            self.flush()

    def flush(self) -> None:
        if self.open:
            packed = self.pack.compress(bytes(self.open))
            self.sizes.append((len(packed), len(self.open)))
            self.out += packed
            self.open = bytearray()

    def close(self) -> bytes:
        self.flush()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.out += struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table
        return bytes(self.out)


class Reader:
    """Random access into a bundle by its seek table."""

    def __init__(self, archive: bytes):
        n, _, magic = struct.unpack("<IBI", archive[-9:])
        if magic != SEEKABLE_MAGIC:
            raise ValueError("not a seekable bundle")
        table = archive[-9 - 8 * n : -9]
        if struct.unpack("<II", archive[-17 - 8 * n : -9 - 8 * n]) != (SKIPPABLE_MAGIC, 8 * n + 9):
            raise ValueError("seek table of a wrong size")
        self.archive, self.at, begin = archive, [], 0
        for k in range(n):
            packed, plain = struct.unpack_from("<II", table, 8 * k)
            self.at.append((begin, packed, plain))
            begin += packed
        self.frame = lru_cache(maxsize=2)(self._frame)

    def _frame(self, k: int) -> bytes:
        begin, packed, plain = self.at[k]
        return zstandard.ZstdDecompressor().decompress(self.archive[begin : begin + packed], max_output_size=plain)

    def read(self, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
        """Headers and block of the record at offset of the frame."""
        data = self.frame(frame)
        end = data.index(b"\r\n\r\n", offset)
        first, *lines = data[offset:end].decode().split("\r\n")
        if first != "WARC/1.1":
            raise ValueError(f"no record at {offset} of frame {frame}")
        headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
        size = int(headers["Content-Length"])
        return headers, data[end + 4 : end + 4 + size]


def write_bundles(rows: DataFrame, bundle_bytes: int = 1 << 25, frame_bytes: int = 1 << 18, level: int = 3) -> DataFrame:
    """rows (key, url, payload, refers_to, sha, size) -> BUNDLE rows of at most about bundle_bytes of records each."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, size, bundle = TaskContext.get().partitionId(), 0, 0, Bundle(frame_bytes, level)

        def row() -> pa.RecordBatch:
            data = bundle.close()
            name = f"{part:05d}-{made:05d}"
            cols = [[name], [data], [bundle.ids], [bundle.frames], [bundle.offsets]]
            kinds = [pa.string(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["bundle_id", "archive", "record_ids", "frames", "offsets"])

        for batch in batches:
            for key, url, payload, refers, sha, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = record(key, url or "", (payload or "").encode(), refers, *((sha, length) if refers is not None else ()))
                bundle.add(record_id(key), data)
                size += len(data)
                if size >= bundle_bytes:
                    yield row()
                    made, size, bundle = made + 1, 0, Bundle(frame_bytes, level)
        if bundle.ids:
            yield row()

    return rows.select("key", "url", "payload", "refers_to", "sha", "size").mapInArrow(pack, BUNDLE)


def read_bundles(bundles: DataFrame) -> DataFrame:
    """Every record of the bundles, found by its index entry and read through the seek table."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                archive, ids, frames, offsets = (one.column(n)[0].as_py() for n in ("archive", "record_ids", "frames", "offsets"))
                reader, out = Reader(archive), []
                for name, frame, offset in zip(ids, frames, offsets, strict=True):
                    head, block = reader.read(frame, offset)
                    if head["WARC-Record-ID"] != f"<{name}>":
                        raise ValueError(f"index entry of {name} leads to {head['WARC-Record-ID']}")
                    kind, named = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(head["X-Payload-Length"])
                    if kind == "response" and (digest(block) != named or len(block) != size):
                        raise ValueError(f"the payload of {name} is damaged")
                    refers = head.get("WARC-Refers-To")
                    out.append((key_of(name), size, named, kind, key_of(refers[1:-1]) if refers else None))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return bundles.mapInArrow(unpack, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def with_revisits(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", min_revisit: int = 0, broadcast_rows: int = 200_000, salts: int = 32
) -> DataFrame:
    """key, url, payload (null for revisits), refers_to, sha, size (both of the full payload).

    Only digests are grouped, and only those of several keys are kept. Up to `broadcast_rows`
    of these, which is counted first, they are broadcast, so payloads are written where they are
    read. Beyond that rows meet them in an equi-join on digest and a salt of the key, so that
    no digest's rows meet in one task. Both give the same rows.
    """
    text = F.coalesce(F.col(payload), F.lit(""))
    sha = F.unhex(F.sha1(F.encode(text, "utf-8")))
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), text.alias("payload"), sha.alias("sha"), F.octet_length(text).cast("long").alias("size"))
    named = rows.select("key", "sha").where("key is not null").groupBy("sha").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    several = common.stored(named.where("first <> last").select("sha", "first"), "digests")
    if several.count() <= broadcast_rows:
        joined = rows.join(F.broadcast(several), "sha", "left")
    else:
        salted = several.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int")).join(salted, ["sha", "salt"], "left")
    other = (F.col("size") >= min_revisit) & (F.col("key") != F.col("first"))
    refers = F.when(other, F.col("first"))
    return joined.select("key", "url", F.when(refers.isNull(), F.col("payload")).alias("payload"), refers.alias("refers_to"), "sha", "size")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundles = common.stored(write_bundles(with_revisits(common.pages(spark, sf_dir))), "warc")
    return read_bundles(bundles)


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS sha FROM p),
b AS (SELECT *, list_transform(range(0, 8), lambda g: ('0x' || substr(sha, (g * 5 + 1)::INT, 5))::BIGINT) AS v FROM d),
t AS (SELECT page_id, payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((v[(i // 4 + 1)::INT] >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest FROM b),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM t GROUP BY payload_digest)
SELECT t.page_id, t.payload_bytes, t.payload_digest,
  CASE WHEN t.page_id = f.first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN t.page_id <> f.first_id THEN f.first_id END AS refers_to
FROM t JOIN f ON t.payload_digest = f.payload_digest
"""
