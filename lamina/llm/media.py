"""MPEG transport streams: payloads muxed to 188-byte packets, and the demuxer that reads them.

The muxer cuts a payload into access units, wraps each in a PES packet with a presentation
time stamp, and repeats the program tables before each. The first packet of a unit carries
the random-access flag and a clock reference. The demuxer knows nothing of the muxer: it
parses the program association and map tables (checking their CRC), checks continuity
counters, reassembles elementary packets and lists time stamps and random-access points.

Defined edge cases: a null text is the empty text; the empty payload is padded to 64 zero
bytes; equal texts give equal values; very long texts give more packets, nothing is cut; an
empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common

# Fixed values of the transport stream format.
SYNC, PACKET, BODY = 0x47, 188, 184
PAT_PID, PMT_PID, ES_PID = 0x0000, 0x1000, 0x0100
PRIVATE_DATA_TYPE, PRIVATE_STREAM_ID = 0x06, 0xBD
CLOCK = 90_000

#: Payload bytes of an access unit and its duration in clock ticks: 8,000 samples a second.
UNIT = 8192
TICKS = UNIT * CLOCK // 8000

SCHEMA = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, "
    "media_sha256 string, feature string, pts array<long>, random_access array<long>"
)


def _crc_table() -> list[int]:
    table = []
    for n in range(256):
        c = n << 24
        for _ in range(8):
            c = (c << 1) ^ 0x04C11DB7 if c & 0x80000000 else c << 1
        table.append(c & 0xFFFFFFFF)
    return table


CRC = _crc_table()


@lru_cache(maxsize=256)
def crc_mpeg(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = ((c << 8) & 0xFFFFFFFF) ^ CRC[(c >> 24) ^ b]
    return c


def section(table_id: int, number: int, body: bytes) -> bytes:
    """A program table section with length and CRC, behind a zero pointer field."""
    size = 5 + len(body) + 4
    head = bytes([table_id, 0xB0 | size >> 8, size & 0xFF]) + number.to_bytes(2, "big") + b"\xc1\x00\x00"
    return b"\x00" + head + body + crc_mpeg(head + body).to_bytes(4, "big")


PAT = section(0x00, 1, b"\x00\x01" + (0xE000 | PMT_PID).to_bytes(2, "big"))
PMT = section(0x02, 1, (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([PRIVATE_DATA_TYPE]) + (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00")


def stamp(pts: int) -> bytes:
    """A 33-bit time stamp in its five-byte form."""
    return bytes([0x21 | (pts >> 29) & 0x0E, (pts >> 22) & 0xFF, 0x01 | (pts >> 14) & 0xFE, (pts >> 7) & 0xFF, 0x01 | (pts << 1) & 0xFE])


def mux(payload: bytes) -> bytes:
    out, counters = [], {PAT_PID: 0, PMT_PID: 0, ES_PID: 0}

    def packet(pid: int, start: bool, body: bytes, field: bytes | None = None) -> None:
        """One packet; field: its adaptation field without length and stuffing."""
        cc, room = counters[pid], BODY - len(body)
        counters[pid] = (cc + 1) & 15
        if room or field is not None:
            inner = b"" if room == 1 else (field or b"\x00").ljust(room - 1, b"\xff")
            middle, control = bytes([room - 1]) + inner, 0x30
        else:
            middle, control = b"", 0x10
        out.append(bytes([SYNC, (0x40 if start else 0) | pid >> 8, pid & 0xFF, control | cc]) + middle + body)

    for k, begin in enumerate(range(0, len(payload), UNIT)):
        packet(PAT_PID, True, PAT.ljust(BODY, b"\xff"))
        packet(PMT_PID, True, PMT.ljust(BODY, b"\xff"))
        unit, pts = payload[begin : begin + UNIT], k * TICKS & (1 << 33) - 1
        head = b"\x80\x80\x05" + stamp(pts)
        pes = b"\x00\x00\x01" + bytes([PRIVATE_STREAM_ID]) + (len(head) + len(unit)).to_bytes(2, "big") + head + unit
        clock = b"\x50" + ((pts << 15) | 0x7E00).to_bytes(6, "big")
        first = BODY - 8
        packet(ES_PID, True, pes[:first], clock)
        for at in range(first, len(pes), BODY):
            packet(ES_PID, False, pes[at : at + BODY])
    return b"".join(out)


def parse_section(body: bytes) -> tuple[int, int, bytes] | None:
    """table id, number and content of the section that begins in a packet's body; None if damaged."""
    at = 1 + body[0]
    size = (body[at + 1] & 0x0F) << 8 | body[at + 2]
    whole = body[at : at + 3 + size]
    if len(whole) < size + 3 or crc_mpeg(whole[:-4]) != int.from_bytes(whole[-4:], "big"):
        return None
    return whole[0], whole[3] << 8 | whole[4], whole[8:-4]


def demux(stream: bytes) -> dict:
    """Programs, streams, payload, time stamps, random-access points and error counts of a transport stream."""
    found = {"pmt": {}, "streams": {}, "packets": 0, "cc_errors": 0, "bad": 0, "pts": [], "random_access": [], "payload": b""}
    counters, parts, units = {}, {}, []

    def end(pid: int) -> None:
        pes = b"".join(parts.pop(pid, ()))
        if len(pes) < 9 or pes[:3] != b"\x00\x00\x01":
            found["bad"] += bool(pes)
            return
        size, flags, head = pes[4] << 8 | pes[5], pes[7], pes[8]
        if flags & 0x80:
            s = pes[9:14]
            found["pts"].append((s[0] & 0x0E) << 29 | s[1] << 22 | (s[2] & 0xFE) << 14 | s[3] << 7 | s[4] >> 1)
        if size and len(pes) < 6 + size:
            found["bad"] += 1
        units.append(pes[9 + head : 6 + size if size else len(pes)])

    for at in range(0, len(stream), PACKET):
        b1, control = stream[at + 1], stream[at + 3]
        if stream[at] != SYNC:
            found["bad"] += 1
            continue
        found["packets"] += 1
        pid = (b1 & 0x1F) << 8 | stream[at + 2]
        body = at + 4
        if control & 0x20:
            size = stream[body]
            if size and stream[body + 1] & 0x40:
                found["random_access"].append(at)
            body += 1 + size
        if not control & 0x10:
            continue
        cc = control & 0x0F
        if counters.get(pid, cc) != cc:
            found["cc_errors"] += 1
        counters[pid] = (cc + 1) & 15
        if pid in found["streams"]:
            if b1 & 0x40:
                end(pid)
                parts[pid] = []
            if pid in parts:
                parts[pid].append(stream[body : at + PACKET])
        elif pid == PAT_PID or pid in found["pmt"].values():
            if not b1 & 0x40 or (table := parse_section(stream[body : at + PACKET])) is None:
                found["bad"] += 1
            elif table[0] == 0x00:
                c = table[2]
                found["pmt"] = {c[k] << 8 | c[k + 1]: (c[k + 2] & 0x1F) << 8 | c[k + 3] for k in range(0, len(c), 4) if c[k] << 8 | c[k + 1]}
            elif table[0] == 0x02:
                c = table[2]
                k = 4 + ((c[2] & 0x0F) << 8 | c[3])
                while k < len(c):
                    found["streams"][(c[k + 1] & 0x1F) << 8 | c[k + 2]] = c[k]
                    k += 5 + ((c[k + 3] & 0x0F) << 8 | c[k + 4])
    for pid in list(parts):
        end(pid)
    found["payload"] = b"".join(units)
    return found


def padded(data: bytes, unit: int = 64) -> bytes:
    """data with zero bytes up to a positive multiple of unit."""
    return data.ljust(max(unit, -(-len(data) // unit) * unit), b"\x00")


def describe(found: dict) -> str:
    streams = "+".join(f"{pid}:{kind}" for pid, kind in sorted(found["streams"].items()))
    pts = found["pts"]
    return (
        f"programs={len(found['pmt'])};streams={streams};packets={found['packets']};cc_errors={found['cc_errors']};bad={found['bad']};"
        f"units={len(pts)};pts={min(pts, default=-1)}-{max(pts, default=-1)};random_access={len(found['random_access'])}"
    )


STORED = "doc_id long, n_bytes long, media binary"


def store(docs: DataFrame) -> DataFrame:
    """STORED rows of docs (doc_id, text): each text's bytes, padded, as a transport stream; n_bytes is their number without padding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            for k in range(0, len(data), ROWS):
                part = data[k : k + ROWS]
                media = pa.array([mux(padded(d)) for d in part], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(k, ROWS), pa.array([len(d) for d in part], pa.int64()), media], ["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", "text").mapInArrow(run, STORED)


#: Streams in a batch, which keeps batches small where texts are long.
ROWS = 256


def read(rows: DataFrame, media: str = "media", key: str = "doc_id") -> DataFrame:
    """key, payload, pts, random_access, packets, cc_errors, bad of a column of any transport streams; a null stream is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [demux(m or b"") for m in batch.column(1).to_pylist()]
            cols = [pa.array([f[n] for f in found], t) for n, t in zip(names, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], [key, *names])

    names = ["payload", "pts", "random_access", "packets", "cc_errors", "bad"]
    kinds = [pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64()]
    schema = "payload binary, pts array<long>, random_access array<long>, packets long, cc_errors long, bad long"
    return rows.select(key, media).mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, {schema}")


def digested(stored: DataFrame) -> DataFrame:
    """SCHEMA rows of STORED rows: every stream read back and described."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, size, media in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = demux(media)
                back = found["payload"]
                out.append((
                    doc, size, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media),
                    hashlib.sha256(media).hexdigest(), describe(found), found["pts"], found["random_access"],
                ))
            kinds = [pa.int64()] * 3 + [pa.string()] + [pa.int64()] * 2 + [pa.string()] * 2 + [pa.list_(pa.int64())] * 2
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            cols = zip(*out, strict=True) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    return stored.mapInArrow(run, SCHEMA)


def store_and_read(docs: DataFrame) -> DataFrame:
    """SCHEMA rows of docs (doc_id, text): each text stored as a transport stream and read back; edge cases as above."""
    return digested(store(docs))


def op2_transport_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_and_read(common.documents(spark, sf_dir))
