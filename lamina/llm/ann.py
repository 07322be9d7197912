"""Nearest neighbours by inner product: hierarchical k-means tree with best-bin-first search.

The tree is fitted on a bounded sample (``sample`` distinct vectors, the smallest hashes of
their ids) and every vector is indexed into a leaf. A query walks the tree through a priority
queue of nodes by inner product with their centroids and visits ``visits`` leaves; that
number is widened on sample queries, against brute force within the sample, until mean
recall reaches ``target``.

Equal vectors are searched once: a distinct vector carries its k + 1 smallest ids, which is
all that k nearest with ties to the smaller id can use.

Leaves that follow each other in the tree form groups. A query is sent once to every group that
holds a leaf of its visit, with the list of these leaves, not once per leaf. Small tables have
about ``groups`` groups and larger ones a group per ``group_rows`` vectors, so that what is sent
grows with the table; groups are cut by a hash into blocks of bounded size, queries likewise, so no
group meets in one task. Vectors travel packed, in their own
precision.

Candidates are all vectors whose rough product is within the rounding margin of the (k + 1)-th
best of their leaf; they are scored exactly and ordered by score, then id, so that
ties are right however many vectors are equally near.

Defined edge cases: rows with a null key and vectors that are null, empty, all zero, hold a null or non-finite
component, or have another length than the most frequent one take no part, as query or as
candidate; with fewer than k candidates all are returned; ties go to the smaller id; of
repeated ids each row takes part; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common


@dataclass
class Tree:
    """centers[i] is node i's centroid; children[i] its nodes; leaf[i] its leaf number or -1. Node 0 is the root."""

    centers: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray
    visits: int = 1

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: the nearest child at every level."""
        out, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            kids = np.array(self.children[node])
            c = self.centers[kids]
            near = kids[np.argmin((c * c).sum(1)[None, :] - 2 * x[rows] @ c.T, axis=1)]
            todo += [(k, rows[near == k]) for k in kids]
        return out

    def order(self, q: np.ndarray, visits: int) -> list[int]:
        """Leaves best-bin-first, at most visits of them."""
        keys, queue, out = self.centers @ q, [(0.0, 0)], []
        while queue and len(out) < visits:
            _, node = heapq.heappop(queue)
            if self.children[node]:
                for k in self.children[node]:
                    heapq.heappush(queue, (-keys[k], k))
            else:
                out.append(int(self.leaf[node]))
        return out


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    """The cluster of each row."""
    c = x[rng.choice(len(x), k, replace=False)]
    own = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        own = np.argmin((c * c).sum(1)[None, :] - 2 * x @ c.T, axis=1)
        for j in range(k):
            if (own == j).any():
                c[j] = x[own == j].mean(axis=0)
    return own


def fit(x: np.ndarray, leaf_size: int, k: int, target: float, branching: int = 8, queries: int = 256, seed: int = 5) -> Tree:
    """A tree over the sample x with leaves of about leaf_size of its rows, and the calibrated number of visits."""
    rng = np.random.default_rng(seed)
    centers, children, leaf, todo, n = [x.mean(axis=0)], [[]], [-1], [(0, np.arange(len(x)))], 0
    while todo:
        node, rows = todo.pop()
        own = kmeans(x[rows], min(branching, -(-len(rows) // leaf_size)), rng) if len(rows) > 1.5 * leaf_size else np.zeros(len(rows), np.int64)
        parts = [rows[own == j] for j in np.unique(own)]
        if len(parts) < 2:
            leaf[node] = n
            n += 1
            continue
        for part in parts:
            children[node].append(len(centers))
            todo.append((len(centers), part))
            centers.append(x[part].mean(axis=0))
            children.append([])
            leaf.append(-1)
    tree = Tree(np.array(centers), children, np.array(leaf))
    held, asked = tree.assign(x), rng.choice(len(x), min(queries, len(x)), replace=False)
    ranks = []
    for i in asked:
        s = x @ x[i]
        s[i] = -np.inf
        near = np.argsort(-s)[: min(k, len(x) - 1)]
        place = {b: r for r, b in enumerate(tree.order(x[i], tree.leaves))}
        ranks += [place[held[j]] for j in near]
    place = np.array(ranks)
    while tree.visits < tree.leaves and (place < tree.visits).mean() < target:
        tree.visits = min(tree.leaves, tree.visits + max(1, tree.visits // 8))
    return tree


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as float64 rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """key and vec (array of double) of the rows that take part."""
    fine = "id is not null and vec is not null and size(vec) > 0 and forall(vec, v -> v is not null and not isnan(v) and abs(double(v)) < double('infinity')) and exists(vec, v -> v <> 0)"
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).alias("vec")).where(F.expr(fine))
    sizes = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    return rows.where(F.size("vec") == (sizes[0]["size"] if sizes else 0))


def lists(values: list[np.ndarray | list], kind: pa.DataType) -> pa.Array:
    return pa.array([np.asarray(v) for v in values], pa.list_(kind))


def gathered(rows: DataFrame, by: list[str], schema: str, width: int, unit: str) -> DataFrame:
    """One row per `by`, whose size the dealing bounds: numbers, vectors (packed) and lists of ids, one entry a row of the input.

    rows: by, number, vec, ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def row() -> pa.RecordBatch:
            cols = [pa.array([c], pa.int64()) for c in current]
            numbers, vecs, ids = zip(*held, strict=True)
            packed = pa.array([np.concatenate(vecs).astype(unit).tobytes()], pa.binary())
            sizes = lists([np.concatenate([[len(i) for i in x] for x in ids])], pa.int64())
            return pa.RecordBatch.from_arrays([*cols, lists([np.concatenate(numbers)], pa.int64()), packed, sizes, lists([[i for x in ids for own in x for i in own]], pa.int64())], names)

        for b in batches:
            keys = list(zip(*(b.column(n).to_pylist() for n in by), strict=True))
            numbers, vecs, ids = b.column("number").to_numpy(zero_copy_only=False), matrix(b.column("vec"), width), b.column("ids").to_pylist()
            begin = 0
            for k in range(1, len(keys) + 1):
                if k == len(keys) or keys[k] != keys[begin]:
                    if current is not None and keys[begin] != current:
                        yield row()
                        held = []
                    current = keys[begin]
                    held.append((numbers[begin:k], vecs[begin:k], ids[begin:k]))
                    begin = k
        if current is not None:
            yield row()

    names = [c.split()[0] for c in schema.split(", ")]
    return rows.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, schema)


def nearest(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20, every: int = 20, sample: int = 20_000,
    leaf_rows: int = 256, sampled_leaf: int = 8, target: float = 0.95, groups: int = 24, group_rows: int = 65_536, block: int = 4096, asked_rows: int = 512,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of every row whose key is divisible by `every`."""
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    copies = Window.partitionBy("vec").orderBy("id")
    distinct = rows.withColumn("nth", F.row_number().over(copies)).where(F.col("nth") <= k + 1).groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    distinct = common.stored(distinct, "vectors")
    kind = distinct.schema["vec"].dataType.simpleString()
    unit = "<f4" if kind == "array<float>" else "<f8"
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    count = distinct.count()
    if not count:
        return empty
    picked = distinct.select("vec", F.col("ids")[0].alias("first")).orderBy(F.xxhash64("first"), "first").limit(sample).collect()  # at most `sample` vectors
    x = np.array([r["vec"] for r in picked], float)
    width = x.shape[1]
    fitted = fit(x, max(sampled_leaf, round(leaf_rows * len(x) / count)), k, target)
    tree = spark.sparkContext.broadcast(fitted)
    parts = min(fitted.leaves, max(groups, -(-count // group_rows)))  # groups of leaves
    of = lambda leaf: F.floor(leaf * parts / fitted.leaves).cast("long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = tree.value.assign(matrix(b.column("vec"), width))
            yield pa.RecordBatch.from_arrays([pa.array(own), b.column("vec"), b.column("ids")], ["number", "vec", "ids"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            orders = [np.array(sorted(tree.value.order(q, tree.value.visits))) for q in matrix(b.column("vec"), width)]
            yield pa.RecordBatch.from_arrays([b.column("query"), b.column("vec"), lists(orders, pa.int64())], ["query", "vec", "leaves"])

    indexed = common.stored(distinct.mapInArrow(place, f"number long, vec {kind}, ids array<long>"), "leaves").withColumn("grp", of(F.col("number")))
    sizes = indexed.groupBy("grp").agg((F.ceil(F.count(F.lit(1)) / block)).cast("long").alias("blocks"))
    blocks = indexed.join(F.broadcast(sizes), "grp")  # one row per group of leaves of a tree of bounded size
    blocks = blocks.select("grp", F.pmod(F.xxhash64("vec"), F.col("blocks")).alias("block"), "number", "vec", "ids")
    held = gathered(blocks, ["grp", "block"], "grp long, block long, leaf array<long>, vec binary, sizes array<long>, ids array<long>", width, unit)

    asked = rows.where(F.col("id") % every == 0).select("id", "vec")
    queries = asked.groupBy("vec").agg(F.min("id").alias("query"))
    routed = queries.mapInArrow(walk, f"query long, vec {kind}, leaves array<long>")
    routed = routed.withColumn("grp", F.explode(F.array_distinct(F.transform("leaves", of))))
    own = F.filter("leaves", lambda n: of(n) == F.col("grp"))
    routed = routed.select("grp", F.pmod(F.xxhash64("query"), F.lit(max(1, count // every // asked_rows))).alias("part"), F.col("query").alias("number"), "vec", own.alias("ids"))
    asked_ = gathered(routed, ["grp", "part"], "grp long, part long, query array<long>, qvec binary, qsizes array<long>, leaves array<long>", width, unit)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[float, int]]] = {}

        def flush() -> pa.RecordBatch:
            near = [[{"minus": p, "id": i} for p, i in x] for x in best.values()]
            kinds = [pa.int64(), pa.list_(pa.struct([("minus", pa.float64()), ("id", pa.int64())]))]
            out = pa.RecordBatch.from_arrays([pa.array(list(best), kinds[0]), pa.array(near, kinds[1])], ["query", "near"])
            best.clear()
            return out

        for b in batches:
            for r in b.to_pylist():
                v, q = (np.frombuffer(r[n], unit).astype(float).reshape(-1, width) for n in ("vec", "qvec"))
                ids, ends = r["ids"], np.concatenate([[0], np.cumsum(r["sizes"])])
                leaf, names = np.array(r["leaf"]), np.array(r["query"])
                wanted, whose = np.array(r["leaves"]), np.repeat(np.arange(len(q)), r["qsizes"])
                order = np.argsort(leaf, kind="stable")
                for own in np.unique(leaf):
                    rows_ = order[np.searchsorted(leaf[order], own) : np.searchsorted(leaf[order], own, "right")]
                    who = whose[wanted == own]
                    if not len(who):
                        continue
                    vs, qs = v[rows_], q[who]
                    rough = qs @ vs.T
                    margin = 1e-12 * width * np.abs(vs).max() * np.abs(qs).sum(axis=1)
                    n = len(rows_) - min(len(rows_), k + 1)
                    low = np.partition(rough, n, axis=1)[:, n] - margin
                    for j, name in enumerate(names[who].tolist()):
                        so_far = best.get(name, [])
                        least = max(low[j], -so_far[-1][0] - margin[j]) if len(so_far) > k else low[j]
                        cand = np.flatnonzero(rough[j] >= least)
                        if len(cand):
                            s = (vs[cand] * qs[j]).sum(axis=1)
                            found = [(-p, i) for p, c in zip(s.tolist(), rows_[cand].tolist(), strict=True) for i in ids[ends[c] : ends[c + 1]]]
                            best[name] = sorted(so_far + found)[: k + 1]
                if len(best) > 50_000:
                    yield flush()
        if best:
            yield flush()

    found = held.join(asked_, "grp").mapInArrow(search, "query long, near array<struct<minus:double,id:long>>")
    merged = found.groupBy("query").agg(F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k + 1).alias("near"))
    named = queries.select("vec", "query").join(merged, "query").select("vec", "near")
    own = asked.join(named, "vec").select(F.col("id").alias("query_id"), F.expr(f"slice(filter(near, x -> x.id <> id), 1, {k})").alias("near"))
    return own.select("query_id", F.posexplode("near").alias("pos", "x")).select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.minus")).alias("score"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
