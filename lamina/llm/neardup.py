"""Near-duplicate classes by improved consistent weighted sampling.

Word shingles (lower case, white space split) are weighted by TF-IDF: (1 + log2 tf, rounded down)
times an idf factor that runs from 1 (a shingle of all documents) to 1 + idf_strength (of one). The
factor is mild so that copies, whose shingles are frequent because they are copies, keep
their similarity. Document frequencies are hashed counts over all documents in a table of
fixed size, of which only the logarithms are broadcast.

Consistent weighted samples of a text give band keys; texts that share a key are compared by
their sample codes, and pairs that may reach the threshold are verified by exact weighted
Jaccard similarity. Equal texts are one node throughout. First a maximum spanning forest of
each bucket's estimates is verified; once classes are known, every remaining possible pair
between different classes of a bucket is verified within its task, which gives at most one
link per class. Buckets of more than ``chunk`` texts are dealt into parts that all hold the
bucket's first text; texts that end up outside its class then meet every part, in blocks. So
any two texts that share a bucket are compared or of one class already, and no task gets
more than a few chunks. Classes are the connected components of verified pairs, found by distributed
label propagation. Entries of buckets of one, and texts that no pair needs, are sieved off by bitmaps of bounded
size before the exact joins.

Defined edge cases: a null text counts as empty; texts without words are duplicates of equal
texts only; texts of fewer words than a shingle are one shingle; long texts are read whole;
a null id takes no part in the choice of class_id (null only if all ids of a class are);
repeated rows belong to one class; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 5
SAMPLES = BANDS * ROWS
#: Sizes of the table of hashed document frequencies, and of its parts.
WIDTH, PARTS = 1 << 22, 64
#: Pairs whose share of equal samples is lower can hardly reach the threshold: three standard deviations.
MARGIN = 3 * math.sqrt(THRESHOLD * (1 - THRESHOLD) / SAMPLES)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))


def mixed(h: np.ndarray) -> np.ndarray:
    """A finalising mix of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * MIX[0]
    h = (h ^ (h >> np.uint64(27))) * MIX[1]
    return h ^ (h >> np.uint64(31))


#: Bytes that separate words, and white space outside ASCII, which is replaced first.
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 28, 29, 30, 31, 32])
WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Powers of an odd number, by which the bytes of a word count; longer words go through them again.
POWERS = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15 | 1, np.uint64))


#: Longer texts are hashed in pieces that end at white space.
PIECE, GAP = 1_000_000, re.compile(r"\s")


def word_hashes(text: str) -> np.ndarray:
    """The hash of every word of a text in lower case, words as str.split() tells them."""
    parts, at = [], 0
    while not parts or at < len(text):
        gap = GAP.search(text, at + PIECE) if len(text) - at > PIECE else None
        end = gap.start() if gap else len(text)
        parts.append(_word_hashes(text[at:end].lower()))
        at = end
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def _word_hashes(text: str) -> np.ndarray:
    if not text.isascii() and WIDE_SPACE.search(text):
        text = " ".join(text.split())
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    space = SPACE[raw]
    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64)
    spans = np.diff(starts, append=len(raw))
    place = np.arange(len(raw)) - np.concatenate([np.zeros(starts[0], np.int64), np.repeat(starts, spans)])
    values = POWERS[place & 4095] * (raw.astype(np.uint64) + np.uint64(1))
    values[space] = 0
    return mixed(np.add.reduceat(values, starts))


def hashes(text: str, n: int = SHINGLE) -> np.ndarray:
    """The hash of every shingle of a text, in order."""
    h = word_hashes(text)
    if not len(h):
        return h
    n = min(n, len(h))
    out = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        out = out * MIX[2] + h[k : len(h) - n + 1 + k]
    return mixed(out)


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of a text and their counts."""
    return np.unique(hashes(text), return_counts=True)


def slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(20)).astype(np.int64) & (WIDTH - 1)


def frequency_levels(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Rounded log2 of the hashed document frequencies, and the number of documents.

    Each task sums its documents into one table; parts of the tables are added up by part.
    The result has WIDTH bytes, whatever the number of documents.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, n, pack = np.zeros(WIDTH, np.int32), 0, zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                table[slot(hashes(text or ""))] += 1  # a slot counts once per document
                n += 1
        if n:
            size = WIDTH // PARTS
            data = [pack.compress(table[k * size : (k + 1) * size].tobytes()) for k in range(PARTS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([n] * PARTS, pa.int64()), pa.array(data, pa.binary())], ["part", "n", "data"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        docs_: dict[int, int] = {}
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for part, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(unpack.decompress(data), np.int32).astype(np.int64)
                total[part] = total[part] + own if part in total else own
                docs_[part] = docs_.get(part, 0) + n
        for part, sums in total.items():
            level = np.round(np.log2(np.maximum(sums, 1))).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([docs_[part]], pa.int64()), pa.array([level.tobytes()], pa.binary())], ["part", "n", "data"])

    kind = "part int, n long, data binary"
    found = docs.select("text").mapInArrow(count, kind).repartition(PARTS, "part").mapInArrow(add, kind).collect()  # PARTS rows of WIDTH / PARTS bytes
    levels = np.zeros(WIDTH, np.uint8)
    for r in found:
        levels[r["part"] * (WIDTH // PARTS) : (r["part"] + 1) * (WIDTH // PARTS)] = np.frombuffer(r["data"], np.uint8)
    return levels, max((r["n"] for r in found), default=0)


def weights(h: np.ndarray, tf: np.ndarray, levels: np.ndarray, docs: int, strength: float) -> np.ndarray:
    """TF-IDF weight of each shingle, in float32."""
    rare = 1 - levels[slot(h)] / math.log2(max(docs, 2))
    return ((1 + np.floor(np.log2(tf))) * (1 + strength * np.clip(rare, 0, 1))).astype(np.float32)


class Curve:
    """A function by its values on an even grid, linear in between; finding a place takes no search."""

    def __init__(self, begin: float, step: float, values: np.ndarray) -> None:
        self.begin, self.per, self.values, self.rise = begin, 1 / step, values[:-1], np.diff(values)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        place = np.clip((x - self.begin) * self.per, 0, len(self.values) - 1e-6)
        cell = place.astype(np.int32)
        return self.values[cell] + (place - cell) * self.rise[cell]


#: ln F above which its inverse is too steep for an even grid.
STEEP = -0.05


@lru_cache(maxsize=1)
def curves() -> tuple[np.ndarray, np.ndarray, Curve, Curve, Curve]:
    """For F(q) = P(E U < q), with E of Exp(1) and U of U(0, 1): ln q on a fine grid and ln F(q) there;
    ln q by ln F up to STEEP; ln E1(q) by ln q; ln q by -ln E1(q), for q below e**4."""
    ln_q = np.arange(-45, 4.6, 0.002)
    density = np.exp(-np.exp(ln_q))
    e1 = np.cumsum(((density[1:] + density[:-1]) * 0.001)[::-1])[::-1]
    ln_q, e1 = ln_q[:-1], np.maximum(e1, 1e-300)
    q = np.exp(ln_q)
    ln_f, ln_e1 = np.log(np.minimum(q * e1 - np.expm1(-q), 1)), np.log(e1)
    low, high = np.arange(ln_f[0], STEEP + 0.002, 0.001), np.arange(-ln_e1[0], 58, 0.001)
    inverse = Curve(low[0], 0.001, np.interp(low, ln_f, ln_q))
    return ln_q, ln_f, inverse, Curve(-45, 0.002, ln_e1), Curve(high[0], 0.001, np.interp(high, -ln_e1, ln_q))


SALT = mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) * MIX[2])
#: By which the lower half of a shingle's hash is dealt to 32 uniform bits for each sample.
FLIP, ODD = (SALT >> np.uint64(32)).astype(np.uint32)[:, None], (mixed(SALT) >> np.uint64(32)).astype(np.uint32)[:, None] | np.uint32(1)


def uniform(h: np.ndarray) -> np.ndarray:
    """Hashes as numbers within (0, 1)."""
    return ((h >> np.uint64(12)).astype(float) + 0.5) * 2.0**-52


def ln_a(h: np.ndarray, w: np.ndarray, salt: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ln a and t of shingles in the samples of a salt, whose draws r, c of Gamma(2, 1) and beta of U(0, 1) are hashed.

    With E, E' of Exp(1) and U of U(0, 1), c = E + E' and r = ln((E + E') / (E U)) are independent and of Gamma(2, 1).
    q = E U = c / exp(r) is drawn first, by bits; then E given q.
    """
    ln_q, ln_f, inverse, ln_e1, by_e1 = curves()
    one = mixed(h ^ salt)
    two = mixed(one + MIX[2])
    three = mixed(two + MIX[2])
    lf = np.log((bits + uniform(one)) * 2.0**-32)
    lq, steep = inverse(lf), np.flatnonzero(lf > STEEP)
    if len(steep):
        lq[steep] = np.interp(lf[steep], ln_f, ln_q)
    e = np.exp(np.maximum(by_e1(-(np.log(uniform(two)) + ln_e1(lq))), lq))
    r = np.log(e - np.log(uniform(three))) - lq
    beta = uniform(mixed(three + MIX[2]))
    t = np.floor(np.log(w) / r + beta)
    return lq - r * (t - beta), t


def samples(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """SAMPLES 64-bit values; two texts agree in one with the probability of their weighted Jaccard similarity.

    a is at least q / w, so only shingles of a small q can have the least a. These are told by
    comparing bits; a sample whose least a is not below the limit is drawn again under a higher one.
    The limits change the work only, never a sample.
    """
    ln_q, ln_f, *_ = curves()
    low, w = h.astype(np.uint32), w.astype(float)
    out, left, limit = np.zeros(SAMPLES, np.uint64), np.arange(SAMPLES), 2 / w.sum()
    while len(left):
        share = np.interp(np.log(w * limit), ln_q, ln_f)
        most = np.where(share > 2 * STEEP, 2.0**32 - 1, np.exp(share) * 2.0**32 * (1 + 1e-4) + 2).astype(np.uint32)
        best, value = np.full(len(left), np.inf), np.zeros(len(left), np.uint64)
        size = (1 << 18) // len(left)
        for begin in range(0, len(h), size):
            bits = (low[begin : begin + size] ^ FLIP[left]) * ODD[left]
            which, at = np.divmod(np.flatnonzero(bits <= most[begin : begin + size]), bits.shape[1])
            if not len(at):
                continue
            own = h[begin + at]
            a, t = ln_a(own, w[begin + at], SALT[left[which]], bits[which, at])
            first = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]]))
            least = np.minimum.reduceat(a, first)
            each = which[first]
            hit = np.flatnonzero(a == np.repeat(least, np.diff(first, append=len(a))))
            hit = hit[np.flatnonzero(np.diff(which[hit], prepend=-1))]
            better = least < best[each]
            each, hit = each[better], hit[better]
            best[each] = a[hit]
            value[each] = own[hit] + t[hit].astype(np.int64).astype(np.uint64) * MIX[2]
        done = best < math.log(limit)
        out[left[done]] = mixed(value[done])
        left, limit = left[~done], limit * 3
    return mixed(out ^ SALT)


SIGNED = "node binary, bands array<long>, codes binary"


def signatures(rows: DataFrame, shared, strength: float) -> DataFrame:
    """doc_id, node, bands, codes of rows (doc_id, node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, n = shared.value
        for batch in batches:
            bands, codes = [], []
            for text in batch.column("text").to_pylist():
                h, tf = shingles(text or "")
                if not len(h):
                    bands.append([])
                    codes.append(b"")
                    continue
                s = samples(h, weights(h, tf, levels, n, strength))
                key = np.zeros(BANDS, np.uint64)
                for k in range(ROWS):
                    key = mixed(key * MIX[2] + s.reshape(BANDS, ROWS)[:, k])
                bands.append(key.view(np.int64))
                codes.append((s & np.uint64(255)).astype(np.uint8).tobytes())
            arrays = [batch.column("doc_id"), batch.column("node"), pa.array(bands, pa.list_(pa.int64())), pa.array(codes, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "node", "bands", "codes"])

    return rows.select("doc_id", "node", "text").mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {SIGNED}")


def forest(codes: np.ndarray, low: float) -> list[tuple[int, int]]:
    """A maximum spanning forest of a chunk by estimated similarity, of edges of at least low.

    It grows a node at a time by the best estimate to any node so far, so it holds one
    estimate per node, never one per pair.
    """
    n = len(codes)
    found, best, by, open_ = [], np.full(n, -1.0), np.zeros(n, np.int64), np.ones(n, bool)
    for _ in range(n):
        i = int(np.argmax(np.where(open_, best, -2)))
        if best[i] >= low:
            found.append((int(by[i]), i))
        open_[i] = False
        same = (codes == codes[i]).mean(axis=1)
        closer = same > best
        best[closer], by[closer] = same[closer], i
    return found


def between(codes: np.ndarray, classes: np.ndarray, low: float) -> Iterator[tuple[int, np.ndarray]]:
    """Each node of a chunk with the later nodes of other classes that it may be similar to."""
    for i in range(len(codes) - 1):
        other = np.flatnonzero(classes[i + 1 :] != classes[i]) + i + 1
        if len(other):
            near = other[(codes[other] == codes[i]).mean(axis=1) >= low]
            if len(near):
                yield i, near


BUCKET = ["band", "key", "part", "block"]


def by_bucket(rows: DataFrame, each: Callable[[list[dict]], list[tuple]], schema: str) -> DataFrame:
    """each over the rows of every chunk (part and block of a bucket), whose size is bounded by the dealing; nodes sorted, each once."""
    columns = [c for c in rows.columns if c not in BUCKET]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, out = None, {}, []

        def done() -> None:
            if len(held) > 1:
                out.extend((*current, *r)[-width:] for r in each([held[k] for k in sorted(held)]))

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
            out.clear()
            return made

        for batch in batches:
            col = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            for i in range(batch.num_rows):
                key = tuple(col[n][i] for n in BUCKET)
                if key != current:
                    done()
                    current, held = key, {}
                held[col["node"][i]] = {n: col[n][i] for n in columns}
            if out:
                yield flush()
        done()
        if out:
            yield flush()

    names = [c.split()[0] for c in schema.split(", ")]
    types = {"binary": pa.binary(), "int": pa.int32(), "long": pa.int64()}
    kinds, width = [types[c.split()[1]] for c in schema.split(", ")], len(names)
    return rows.repartition(*BUCKET).sortWithinPartitions(*BUCKET).mapInArrow(run, schema)


def code_rows(held: list[dict]) -> np.ndarray:
    return np.frombuffer(b"".join(h["codes"] for h in held), np.uint8).reshape(len(held), SAMPLES)


def class_numbers(held: list[dict]) -> np.ndarray:
    return np.unique([h["class"].hex() for h in held], return_inverse=True)[1]


def candidates(entries: DataFrame, signed: DataFrame, low: float) -> DataFrame:
    """Distinct pairs (a, b) of the buckets' spanning forests, from entries (node, band, key, part, block)."""

    def each(held: list[dict]) -> list[tuple]:
        return [tuple(sorted((held[i]["node"], held[k]["node"]))) for i, k in forest(code_rows(held), low)]

    return by_bucket(entries.join(signed.select("node", "codes"), "node"), each, "a binary, b binary").distinct()


def nominated(entries: DataFrame, signed: DataFrame, low: float) -> DataFrame:
    """Entries (with class) that have a possible partner of another class in their chunk, with their codes."""

    def each(held: list[dict]) -> list[tuple]:
        found: set[int] = set()
        for i, near in between(code_rows(held), class_numbers(held), low):
            found.add(i)
            found.update(near.tolist())
        return [(held[k]["node"], held[k]["class"], held[k]["codes"]) for k in sorted(found)]

    return by_bucket(entries.join(signed.select("node", "codes"), "node"), each, "band int, key long, part int, block int, node binary, class binary, codes binary")


def vector(text: str | None, levels: np.ndarray, docs: int, strength: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Shingle hashes of a text, their weights and the sum of these."""
    h, tf = shingles(text or "")
    w = weights(h, tf, levels, docs, strength).astype(float)
    return h, w, float(w.sum())


def similar(x: tuple, y: tuple, threshold: float) -> bool:
    """Whether the exact weighted Jaccard similarity of two vectors reaches the threshold."""
    (h, w, a), (g, v, b) = (x, y) if len(x[0]) <= len(y[0]) else (y, x)
    if not len(h) or min(a, b) < threshold * max(a, b) - 1e-9:
        return False
    at = np.minimum(np.searchsorted(g, h), len(g) - 1)
    hit = g[at] == h
    both = float(np.minimum(w[hit], v[at[hit]]).sum())
    return both >= threshold * (a + b - both) - 1e-9


def linked(entries: DataFrame, texts: DataFrame, shared, low: float, threshold: float, strength: float) -> DataFrame:
    """Verified pairs (a, b) between classes, from nominated entries; a chunk gives at most one per class less one.

    Every possible pair between classes that are not linked yet is verified within its chunk.
    """

    def each(held: list[dict]) -> list[tuple]:
        levels, n = shared.value
        own, classes, out = [vector(h["text"], levels, n, strength) for h in held], class_numbers(held), []
        for i, near in between(code_rows(held), classes, low):
            for k in near.tolist():
                if classes[i] != classes[k] and similar(own[i], own[k], threshold):
                    out.append(tuple(sorted((held[i]["node"], held[k]["node"]))))
                    classes[classes == classes[k]] = classes[i]
        return out

    return by_bucket(entries.join(texts, "node"), each, "a binary, b binary").distinct()


def verified(pairs: DataFrame, texts: DataFrame, shared, threshold: float, strength: float) -> DataFrame:
    """The pairs whose exact weighted Jaccard similarity reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, n = shared.value
        last, own = None, None
        for batch in batches:
            keep = []
            for a, x, y in zip(batch.column("a").to_pylist(), batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True):
                if a != last:
                    last, own = a, vector(x, levels, n, strength)
                keep.append(similar(own, vector(y, levels, n, strength), threshold))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node of each connected component, for every node that has a link.

    Minimum labels spread along links, then along labels (pointer jumping), until none changes.
    """
    edges = common.stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = common.stored(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("root")), "labels")
    while True:
        heard = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("heard"))
        step = labels.join(heard, "node").select("node", F.col("root").alias("was"), F.least("root", "heard").alias("next"))
        ahead = labels.select(F.col("node").alias("next"), F.col("root").alias("ahead"))
        moved = common.stored(step.join(ahead, "next").select("node", "was", F.least("next", "ahead").alias("root")), "labels")
        if not moved.where(F.col("was") != F.col("root")).limit(1).count():
            return moved.select("node", "root")
        labels = moved.select("node", "root")


def node_of(text: Column) -> Column:
    """The 16-byte digest that stands for a text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def classes(docs: DataFrame, threshold: float = THRESHOLD, idf_strength: float = 0.1, chunk: int = 250) -> DataFrame:
    """doc_id, node, class_id, class_size for every row of docs (doc_id, text)."""
    return rooted(docs, threshold, idf_strength, chunk).drop("root")


def rooted(docs: DataFrame, threshold: float = THRESHOLD, idf_strength: float = 0.1, chunk: int = 250) -> DataFrame:
    """classes() with root, the node that tells a class from others also where ids are null or repeated."""
    rows = docs.select("doc_id", "text", node_of(F.col("text")).alias("node"))
    shared = docs.sparkSession.sparkContext.broadcast(frequency_levels(rows))  # WIDTH bytes
    signed_rows = common.stored(signatures(rows, shared, idf_strength), "signed")
    signed = common.stored(signed_rows.groupBy("node").agg(F.first("bands").alias("bands"), F.first("codes").alias("codes"), F.min("doc_id").alias("doc_id")), "nodes")

    entries = signed.select("node", F.posexplode("bands").alias("band", "key"))
    repeated = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    entries = common.sifted(entries, F.col("key"), common.stored(repeated.select("key"), "keys"))
    buckets = entries.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("leader")).where("n > 1")
    entries = entries.join(buckets, ["band", "key"])
    parts = F.ceil(F.col("n") / chunk).cast("int")
    own = F.when(F.col("node") == F.col("leader"), F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.pmod(F.xxhash64("node", "band"), parts).cast("int")))
    entries = entries.select("node", "band", "key", "leader", parts.alias("parts"), F.explode(own).alias("part"), F.lit(0).alias("block"))
    entries = common.stored(entries, "buckets")

    low = threshold - MARGIN
    first = common.stored(candidates(entries, signed, low), "pairs")
    needed = first.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = _texts(rows, signed, needed)
    links = common.stored(verified(first, texts, shared, threshold, idf_strength), "links")
    labels = components(links)

    rest = common.stored(nominated(undecided(entries, labels, chunk), signed, low), "nominated")
    if rest.limit(1).count():
        more = linked(rest, _texts(rows, signed, rest.select("node").distinct()), shared, low, threshold, idf_strength)
        labels = components(links.union(common.stored(more, "links")))

    members = signed_rows.select("doc_id", "node").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = members.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    sizes = common.stored(sizes, "sizes")  # apart from the rows, whose hot classes the join can then split
    return members.join(sizes, "root").select("doc_id", "node", "root", "class_id", "class_size")


def undecided(entries: DataFrame, labels: DataFrame, chunk: int) -> DataFrame:
    """Entries with class of the buckets that still hold several classes, dealt so that any two of different classes meet.

    In a bucket of several parts, texts outside the class of its first text are dealt into
    blocks and go to every part; a part's own texts meet each block.
    """
    classed = entries.join(labels.withColumnRenamed("root", "class"), "node", "left").withColumn("class", F.coalesce("class", "node"))
    bucket = ["band", "key"]
    first = F.max(F.when(F.col("node") == F.col("leader"), F.col("class")))
    several = classed.groupBy(bucket).agg(F.min("class").alias("x"), F.max("class").alias("y"), first.alias("top")).where("x <> y").select(*bucket, "top")
    mixed_ = classed.join(several, bucket).withColumn("stray", F.col("class") != F.col("top"))
    mixed_ = common.stored(mixed_, "undecided")
    few, many = mixed_.where("parts = 1").select("node", "class", *BUCKET), mixed_.where("parts > 1")
    blocks = many.groupBy(bucket).agg(F.greatest(F.lit(1), F.ceil(F.count_if("stray") / chunk)).cast("int").alias("blocks"))
    many = many.drop("block").join(blocks, bucket)
    own = many.select("node", "class", *bucket, "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    strays = many.where("stray").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    strays = strays.select("node", "class", *bucket, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "block")
    return few.unionByName(own).unionByName(strays)


def _texts(rows: DataFrame, signed: DataFrame, needed: DataFrame) -> DataFrame:
    """node, text of the needed nodes, each from one of its documents."""
    one = common.stored(signed.select("node", F.col("doc_id").alias("one")).join(needed, "node"), "chosen")
    rows = common.sifted(rows, F.xxhash64("node", "doc_id"), one.select(F.xxhash64("node", "one")))
    found = rows.join(one, (rows["node"] == one["node"]) & rows["doc_id"].eqNullSafe(one["one"])).select(rows["node"], "text")
    return common.stored(found.dropDuplicates(["node"]), "texts")


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """docs with one row of each class: that with the smallest id."""
    found = rooted(docs.select("doc_id", "text"), **options).where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    found = found.groupBy("doc_id", "node", "root").agg(F.count(F.lit(1)).alias("rows"))
    one, node, root, n = (common.fresh(docs, f"_{c}") for c in ("kept_id", "node", "class", "rows"))
    kept = found.select(F.col("doc_id").alias(one), F.col("node").alias(node + "k"), F.col("root").alias(root), F.col("rows").alias(n))
    kept = common.stored(kept, "kept")
    stays = docs.withColumn(node, node_of(F.col("text"))).join(kept, (F.col(node) == F.col(node + "k")) & F.col("doc_id").eqNullSafe(F.col(one)))
    repeated = kept.groupBy(root).agg(F.sum(n).alias("n")).where("n > 1").select(root)
    if repeated.limit(1).count() == 0:
        return stays.select(docs.columns)
    again = common.fresh(docs, "_again")
    same = stays.join(repeated.withColumnRenamed(root, again), F.col(root) == F.col(again), "left")
    several = same.where(F.col(again).isNotNull()).dropDuplicates([root])
    single = same.where(F.col(again).isNull())
    return single.select(docs.columns).union(several.select(docs.columns))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(common.documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "class_id", "class_size")
