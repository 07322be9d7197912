"""Vector best-fit packing of token sequences.

A bin has three capacities: tokens, documents and attention cost (the sum of squared piece
lengths). A piece goes to the feasible bin with the smallest weighted norm of what remains
(or the largest weighted dot product of demand and remainder), longest pieces first. Of equal
norms the bin class that was opened first wins, so a plan depends on the counts alone.

The plan is made on the histogram of lengths, not on the pieces: bins of equal remainder are
one class that holds ranges of bin numbers, and a step places a whole run of equal lengths.
So the driver holds at most one count per possible length and a few ranges per step,
whatever the number of pieces. Pieces find their bin by their rank among those of equal
length, which comes from ranks within the written parts plus prefix sums over parts; no
group of pieces meets in one task.

Defined edge cases: a null text counts as empty and still holds its end id; longer documents
are cut into full pieces and a last one that may be shorter; equal texts and repeated rows
are packed as separate pieces; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, tokens

CAPACITY, END = 2048, 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """PIECES rows: part and nth count the pieces of equal length within a written part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, seen = tokens.words_of(vocabulary), TaskContext.get().partitionId(), {}
        last = end.to_bytes(4, "little")
        for batch in batches:
            out = []
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = tokens.lower_ids(text or "", words) + last
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    size = len(own) // 4
                    nth = seen.get(size, 0)
                    seen[size] = nth + 1
                    out.append((doc, k, at // 4, size, zlib.crc32(own), part, nth))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            cols = zip(*out, strict=True) if out else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in PIECES.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def plan(
    counts: dict[int, int],
    capacity: int = CAPACITY,
    max_documents: int = CAPACITY,
    max_attention: int = CAPACITY**2,
    weights: tuple[float, float, float] = (1.0, 0.1, 0.1),
    rule: str = "norm",
) -> np.ndarray:
    """Rows (length, first rank, end rank, first bin, pieces of that length per bin, offset), by length and rank.

    counts: pieces by length. rule: "norm" picks the smallest weighted residual norm after
    placing, "dot" the largest weighted dot product of demand and residual before it.
    """
    caps = np.array([capacity, max_documents, max_attention], float)
    w = np.array(weights)
    states: list[tuple[int, int, int]] = []
    ranges: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
    arr = np.empty((0, 3))
    dirty, steps, bins = True, [], 0

    def add(state: tuple[int, int, int], begin: int, n: int) -> None:
        nonlocal dirty
        if state not in ranges:
            dirty = True
        ranges.setdefault(state, []).append((begin, n))

    for length in sorted(counts, reverse=True):
        left, rank, demand = counts[length], 0, np.array([length, 1, length * length], float)
        while left:
            if dirty:
                states, dirty = list(ranges), False
                arr = np.array(states, float).reshape(-1, 3)
            fits = np.flatnonzero((arr >= demand).all(axis=1)) if len(arr) else []
            if len(fits):
                rest = arr[fits]
                if rule == "dot":
                    best = fits[int(np.argmax(((rest / caps) * (demand / caps) * w).sum(axis=1)))]
                else:
                    best = fits[int(np.argmin(((((rest - demand) / caps) ** 2) * w).sum(axis=1)))]
                state = states[best]
                begin, n = ranges[state].pop()
                if not ranges[state]:
                    del ranges[state]
                    dirty = True
            else:
                state = (capacity, max_documents, max_attention)
                if length > capacity or length * length > max_attention or max_documents < 1:
                    raise ValueError(f"a piece of {length} tokens fits into no bin")
                begin, n = bins, None
            each = min(state[0] // length, state[1], state[2] // (length * length))
            if n is None:
                n = -(-left // each)
                bins += n
            full = min(n, left // each)
            offset = capacity - state[0]

            def put(first: int, many: int, per: int) -> None:
                nonlocal rank, left
                if many and per:
                    steps.append((length, rank, rank + many * per, first, per, offset))
                    rank, left = rank + many * per, left - many * per
                    add((state[0] - per * length, state[1] - per, state[2] - per * length * length), first, many)

            put(begin, full, each)
            if full < n:
                some = min(left, each)
                if some:
                    put(begin + full, 1, some)
                    full += 1
                if full < n:
                    add(state, begin + full, n - full)
    return np.array(steps, np.int64).reshape(-1, 6)[np.lexsort((np.array([s[1] for s in steps], np.int64), np.array([s[0] for s in steps], np.int64)))]


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END, **limits) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of docs."""
    cut = common.stored(pieces(docs, vocabulary, capacity, end), "pieces")
    held = cut.groupBy("part", "length").count()
    upto = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = held.select("part", "length", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("base"))
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # at most `capacity` rows
    steps = plan(counts, capacity, **limits)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(steps)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = shared.value
        span = int(steps[:, 2].max()) + 1 if len(steps) else 1
        keys = steps[:, 0] * span + steps[:, 1]
        for batch in batches:
            col = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "nth", "base")}
            rank = col["nth"] + col["base"]
            s = steps[np.searchsorted(keys, col["length"] * span + rank, side="right") - 1]
            over = rank - s[:, 1]
            made = [pa.array(s[:, 3] + over // s[:, 4]), pa.array(s[:, 5] + over % s[:, 4] * s[:, 0])]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + made, [*names, "sequence_id", "offset"])

    ranked = cut.join(bases, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", "nth", "base")
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.documents(spark, sf_dir), tokens.vocabulary("word_bpe_49k.json"))
