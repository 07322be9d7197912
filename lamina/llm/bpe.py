"""Byte-pair encoding and decoding through a table of distinct words.

Texts are split into words in Spark, block by block: a block is a run of consecutive texts of
one scan task. A block sends each of its distinct words once, packed by word hash; the task
that gets a hash bucket encodes each distinct word of the corpus once and answers every
block with the ids in the block's order. The answers meet the block's texts, kept as word
numbers, and ids are joined back by position. Decoding joins ids with the piece table, whose
size is that of the vocabulary.

No word is a key of many rows: a block names it once, whatever its frequency. Blocks are
found twice, once for words and once for numbers; their key is a digest of their ids and
texts, so it does not hang on where or when a block is read, and rows that come out of a shuffle, whose
order may change when it is fetched again, are sorted within their partitions first. A block
without all its answers raises an error.

Defined edge cases: a null text counts as empty and has no ids; strings of special tokens in
a text get the special id, as the library does; long texts are never cut; equal texts get
equal values; repeated rows give one result each; an empty table gives no row; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

BLOCK_CHARS = 12_000_000
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def pack(*parts: np.ndarray | bytes) -> bytes:
    """Parts as one compressed string; integers by byte planes, so that high zero bytes cost nothing."""
    raw = [p if isinstance(p, bytes) else p.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for p in parts]
    head = np.array([len(raw), *map(len, raw)], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(raw))


def unpack(data: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(raw[:4], "little")
    sizes = np.frombuffer(raw, "<u4", n, 4)
    ends = 4 + 4 * n + np.cumsum(sizes, dtype=np.int64)
    return [raw[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]


def ints(data: bytes) -> np.ndarray:
    """What pack made of an integer array."""
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def strings(ends: bytes, data: bytes) -> list[bytes]:
    """The strings that lie one after another in data, by their packed lengths."""
    at = np.concatenate([[0], np.cumsum(ints(ends), dtype=np.int64)]).tolist()
    return [data[a:b] for a, b in zip(at, at[1:])]


class Numbers(dict):
    """word -> its number in order of first appearance."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def bucket_count(spark: SparkSession) -> int:
    """Buckets of distinct words: more on larger clusters, so that a bucket's words fit into a worker; not so many that rows hold single words."""
    return min(8192, max(1024, 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def bucket(word: bytes, buckets: int) -> int:
    return zlib.crc32(word) % buckets


def steady(docs: DataFrame) -> DataFrame:
    """doc_id and text in an order that a second reading repeats: that of the files, or sorted within partitions after a shuffle."""
    rows = docs.select("doc_id", "text")
    shuffled = "Exchange" in rows._jdf.queryExecution().executedPlan().toString()
    return rows.sortWithinPartitions("doc_id", "text") if shuffled else rows


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[int], list[str]]]:
    """(key, doc ids, texts) of runs of about BLOCK_CHARS characters; blocks of equal ids and texts have equal keys."""
    size, ids, texts, key = 0, [], [], hashlib.blake2b(digest_size=16)
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            ids.append(doc)
            texts.append(text or "")
            key.update(f"{doc} {len(texts[-1])} ".encode())
            key.update(texts[-1].encode("utf-8", "surrogatepass"))
            size += len(texts[-1])
            if size >= BLOCK_CHARS:
                yield key.hexdigest(), ids, texts
                size, ids, texts, key = 0, [], [], hashlib.blake2b(digest_size=16)
    if ids:
        yield key.hexdigest(), ids, texts


def distinct_words(docs: DataFrame, path: str, buckets: int) -> DataFrame:
    """block, bucket, words: each block's distinct words by hash, in order of first appearance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens.words_of(path)
        for key, _, texts in blocks_of(batches):
            seen: dict[str, None] = {}
            for t in texts:
                seen.update(dict.fromkeys(tokens.byte_words(t, own)))
            by: list[list[bytes]] = [[] for _ in range(buckets)]
            for w in seen:
                raw = w.encode("utf-8", "surrogatepass")
                by[bucket(raw, buckets)].append(raw)
            rows = [(b, pack(np.array([len(w) for w in ws]), b"".join(ws))) for b, ws in enumerate(by) if ws]
            arrays = [pa.array([key] * len(rows)), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["block", "bucket", "words"])

    return docs.mapInArrow(run, "block string, bucket int, words binary")


def numbered_texts(docs: DataFrame, path: str, buckets: int) -> DataFrame:
    """block, texts: each block's doc ids, words per text and word numbers, and the bucket of each number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens.words_of(path)
        for key, ids, texts in blocks_of(batches):
            numbers, parts = Numbers(), []
            for t in texts:
                words = tokens.byte_words(t, own)
                parts.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
            places = np.array([bucket(w.encode("utf-8", "surrogatepass"), buckets) for w in numbers], np.uint32)
            whole = np.concatenate(parts) if parts else np.empty(0, np.uint32)
            named = np.array([0 if i is None else i for i in ids], "<i8").tobytes(), np.array([i is None for i in ids])
            data = pack(*named, np.array([len(p) for p in parts]), whole, places)
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([data], pa.binary())], ["block", "texts"])

    return docs.mapInArrow(run, "block string, texts binary")


def encoded_words(words: DataFrame, path: str) -> DataFrame:
    """block, bucket, ids: every block's words of a bucket encoded; a distinct word once per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known, current = tokens.words_of(path), {}, None
        special = {s.encode(): np.array(own.tokenizer.encode(s, add_special_tokens=False).ids, "<u4").tobytes() for s in own.special}
        for batch in batches:
            out = []
            for b, data in zip(batch.column("bucket").to_pylist(), batch.column("words").to_pylist(), strict=True):
                if b != current:
                    known, current = dict(special), b
                found = []
                for raw in strings(*unpack(data)):
                    ids = known.get(raw)
                    if ids is None:
                        ids = known[raw] = own.encode(raw.decode("utf-8", "surrogatepass"))
                    found.append(ids)
                out.append(pack(np.array([len(i) // 4 for i in found]), np.frombuffer(b"".join(found), "<u4")))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("bucket"), pa.array(out, pa.binary())], ["block", "bucket", "ids"])

    dealt = words.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "block string, bucket int, ids binary")


@lru_cache(maxsize=2)
def pieces(path: str) -> list[bytes]:
    """The bytes of each id: the piece table that decoding joins with."""
    tokenizer = tokens.load(path)
    by_id = sorted((i, w) for w, i in tokenizer.get_vocab(with_added_tokens=True).items())
    special = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
    return [special[i] if i in special else bytes(tokens.BYTE_OF[c] for c in w) for i, w in by_id]


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """RESULT rows of docs (doc_id, text)."""
    buckets, docs = bucket_count(docs.sparkSession), steady(docs)
    answers = encoded_words(distinct_words(docs, path, buckets), path).groupBy("block").agg(F.collect_list(F.struct("bucket", "ids")).alias("answers"))
    joined = numbered_texts(docs, path, buckets).join(answers, "block", "left").select("texts", "answers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = pieces(path)
        shown = [str(i).encode() for i in range(len(piece))]
        for batch in batches:
            for k in range(batch.num_rows):
                docs_, unnamed, sizes, whole, places = unpack(batch.column("texts")[k].as_py())
                numbers, places = ints(whole), ints(places)
                count = np.zeros(len(places), np.int64)
                words: list[tuple[bytes, bytes]] = [(b"", b"")] * len(places)
                order = np.argsort(places, kind="stable")
                first = np.searchsorted(places[order], np.arange(buckets + 1))
                answered, seen = 0, set()
                for a in batch.column("answers")[k].as_py() or ():
                    if a["bucket"] in seen:  # blocks of equal ids and texts share a key and their answers
                        continue
                    seen.add(a["bucket"])
                    many, ids = map(ints, unpack(a["ids"]))
                    mine = order[first[a["bucket"]] : first[a["bucket"] + 1]]
                    if len(mine) != len(many):
                        raise RuntimeError("a block was answered for other words than it has")
                    count[mine] = many
                    answered += len(mine)
                    ids, at = ids.tolist(), 0
                    for n, size in zip(mine.tolist(), many.tolist(), strict=True):
                        own = ids[at : at + size]
                        at += size
                        words[n] = b",".join([shown[i] for i in own]), b"".join([piece[i] for i in own])
                if answered != len(places):
                    raise RuntimeError("a block lacks answers for some of its words")
                texts, pieces_ = [w[0] for w in words], [w[1] for w in words]
                out, at = [], 0
                for doc, null, size in zip(np.frombuffer(docs_, "<i8").tolist(), ints(unnamed).tolist(), ints(sizes).tolist(), strict=True):
                    own = numbers[at : at + size]
                    at += size
                    listed = own.tolist()
                    ids = b",".join(map(texts.__getitem__, listed))
                    back = b"".join(map(pieces_.__getitem__, listed)).decode("utf-8", "replace").encode()
                    out.append((None if null else doc, int(count[own].sum()), hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return joined.mapInArrow(run, RESULT)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_decode(common.documents(spark, sf_dir), tokens.vocabulary("byte_bpe_50k.json"))
