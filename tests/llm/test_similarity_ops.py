"""Nearest neighbours, near duplicates and the pipeline against brute force and on edge cases."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from lamina.llm import ann, neardup, quality
from tests.llm.test_text_ops import check_packing

SF = "/root/testdata/sf0.001"


# --- nearest neighbours -------------------------------------------------------------------------


def brute(rows, k, every):
    """The k nearest of each query by full scan, ties to the smaller id."""
    out = {}
    for q, (i, v) in enumerate(rows):
        if i % every == 0:
            scored = sorted((-float((np.array(v) * np.array(w)).sum()), j) for p, (j, w) in enumerate(rows) if j != i)
            out.setdefault(i, []).append([j for _, j in scored[:k]])
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0) for i, v in rows], "vec_id long, embedding array<float>, vec string, leaf int")


def test_nearest_small(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(400)]
    got = defaultdict(list)
    for r in ann.nearest(vectors(spark, rows), k=5, target=1.0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    want = {i: x[0] for i, x in brute(rows, 5, 20).items()}
    hits = sum(len(set(got[i]) & set(w)) for i, w in want.items())
    assert set(got) == set(want) and hits >= 0.95 * 5 * len(want) and all(len(x) == 5 for x in got.values())


def test_nearest_recall_and_scores(spark):
    found = ann.op5_nearest(spark, SF).collect()
    data = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    by = defaultdict(list)
    for r in found:
        by[r["query_id"]].append(r)
        assert math.isclose(r["score"], float(data[r["query_id"]] @ data[r["vec_id"]]), rel_tol=1e-12, abs_tol=1e-14)
    want = brute(list(data.items()), 20, 20)
    assert set(by) == set(want) and all([r["rank"] for r in sorted(x, key=lambda r: r["rank"])] == list(range(1, 21)) for x in by.values())
    assert sum(len({r["vec_id"] for r in by[q]} & set(w[0])) for q, w in want.items()) >= 0.9 * 20 * len(want)


def test_nearest_edges(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(20, None), (40, []), (60, [0.0, 0.0]), (80, [1.0, None]), (100, [nan, 1.0]), (120, [inf, 1.0]), (140, [1.0, 2.0, 3.0]), (None, [1.0, 0.0])]
    good = [(0, [1.0, 0.0])] + [(i, [1.0, 0.0]) for i in range(1, 61) if i % 20] + [(160, [0.0, 1.0]), (161, [0.0, -1.0])]
    got = defaultdict(list)
    for r in ann.nearest(vectors(spark, odd + good), k=20).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(got) == {0, 160}
    assert [i for i, _ in got[0]] == [i for i in range(1, 22) if i != 20] and {s for _, s in got[0]} == {1.0}
    assert [i for i, _ in got[160]] == [0, *[i for i in range(1, 21) if i != 20]]
    assert ann.nearest(vectors(spark, odd[:-1])).collect() == [] and ann.nearest(vectors(spark, [])).collect() == []
    assert [tuple(r)[:3] for r in ann.nearest(vectors(spark, [(20, [1.0, 1.0]), (3, [2.0, 1.0])])).collect()] == [(20, 1, 3)]


@pytest.mark.parametrize("block", [4096, 64])
def test_nearest_ties_go_to_the_smallest_ids(spark, block):
    """400 distinct vectors of equal product in one leaf, and one-hot vectors over many."""
    rng = np.random.default_rng(1)
    rows = [(0, [1.0] + [0.0] * 9)] + [(i, [0.5, *rng.normal(size=9).astype(np.float32).tolist()]) for i in rng.permutation(np.arange(1, 401)).tolist() if i % 20]
    got = [r["vec_id"] for r in ann.nearest(vectors(spark, rows), target=1.0, leaf_rows=10_000, block=block, groups=1).orderBy("rank").collect()]
    assert got == [i for i in range(1, 22) if i != 20]
    hot = [(i, [float(j == i % 7) for j in range(7)]) for i in range(600)]
    found = defaultdict(list)
    for r in ann.nearest(vectors(spark, hot), target=1.0, block=block, asked_rows=8).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(r["vec_id"])
    assert found == {i: x[0] for i, x in brute(hot, 20, 20).items()}


# --- near duplicates ----------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, band int, rows int"


def docs(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 1, 1) for i, t in zip(ids or range(len(texts)), texts, strict=True)], DOCS)


def brute_classes(texts, threshold=0.8, strength=0.1):
    """Components of all pairs by exact weighted Jaccard, with exact shingles and true document frequencies."""
    sets = []
    for t in texts:
        words = (t or "").lower().split()
        tf = defaultdict(int)
        for k in range(max(1, len(words) - 4)) if words else ():
            tf[tuple(words[k : k + 5])] += 1
        sets.append(tf)
    df = defaultdict(int)
    for tf in sets:
        for s in tf:
            df[s] += 1
    n = max(len(texts), 2)
    idf = {s: 1 + strength * min(1, max(0, 1 - round(math.log2(c)) / math.log2(n))) for s, c in df.items()}
    ws = [{s: (1 + math.floor(math.log2(c))) * idf[s] for s, c in tf.items()} for tf in sets]
    up = list(range(len(texts)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            same = (texts[i] or "") == (texts[j] or "")
            if not same and ws[i] and ws[j]:
                both = sum(min(w, ws[j][s]) for s, w in ws[i].items() if s in ws[j])
                same = both >= threshold * (sum(ws[i].values()) + sum(ws[j].values()) - both) - 1e-6
            if same:
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return [top(i) for i in range(len(texts))]


@pytest.mark.parametrize("n", [1, 2, 7, 300, 3000])
def test_samples_are_those_of_all_shingles(n):
    """The limits that pass shingles over never change a sample; the curves on even grids are those of F and E1."""
    h = np.unique(neardup.mixed(np.arange(1, n + 1, dtype=np.uint64)))
    w = np.where(h % np.uint64(3) == 0, 1.0, np.where(h % np.uint64(3) == 1, 1.1, 40.0))
    least = []
    for k in range(neardup.SAMPLES):
        bits = (h.astype(np.uint32) ^ neardup.FLIP[k]) * neardup.ODD[k]
        a, t = neardup.ln_a(h, w, neardup.SALT[k], bits)
        i = int(np.argmin(a))
        least.append((h[i : i + 1] + t[i : i + 1].astype(np.int64).astype(np.uint64) * neardup.MIX[2])[0])
    want = neardup.mixed(neardup.mixed(np.array(least, np.uint64)) ^ neardup.SALT)
    assert (neardup.samples(h, w) == want).all()
    ln_q, ln_f, inverse, ln_e1, by_e1 = neardup.curves()
    x = np.linspace(-40, -0.1, 5000)
    assert np.abs(np.interp(inverse(x), ln_q, ln_f) - x).max() < 1e-5
    at = np.linspace(-40, 3, 5000)
    assert np.abs(by_e1(-ln_e1(at)) - at).max() < 1e-3


def corpus(rng, n=60):
    words = [f"w{k}" for k in range(500)]
    shared = " ".join(rng.choice(words) for _ in range(60))
    out = []
    for _ in range(n):
        own = [rng.choice(words) for _ in range(rng.randrange(30, 200))]
        out.append(" ".join(own))
        for _ in range(rng.randrange(4)):
            copy = list(own)
            for _ in range(rng.choice([0, 1, 1, 2, 6, 30])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
        if rng.random() < 0.3:
            out.append(shared + " " + " ".join(rng.choice(words) for _ in range(200)))
    return out


def test_near_duplicates_equal_brute_force(spark):
    texts = corpus(random.Random(5)) + ["", None, "", " \n", "one two", "One  two", "one two", "a b c d e", "a b c d f", "long words " * 30_000, "long words " * 30_000 + "x"]
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_classes(texts)


def test_hot_groups_and_small_chunks(spark):
    """A large group of near copies in chunks much smaller than the group is one class, clean texts stay alone."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    texts = []
    for _ in range(150):
        copy = list(base)
        for _ in range(2):
            copy[rng.randrange(300)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    clean = [" ".join(f"c{rng.randrange(10**6)}" for _ in range(100)) + " " + " ".join(base[:40]) for _ in range(50)]
    rows = neardup.classes(docs(spark, texts + clean + texts[:1] * 100), chunk=20).collect()
    by = {r["doc_id"]: (r["class_id"], r["class_size"]) for r in rows}
    assert {by[i] for i in range(150)} == {(0, 250)} and all(by[i] == (i, 1) for i in range(150, 200))


def test_deduplicate_keeps_one_row(spark):
    texts, ids = ["a b c d e f g", "a b c d e f g", "other text here", "other text here", None, "", "z"], [5, 3, 7, 7, 9, 1, None]
    df = docs(spark, texts, ids)
    kept = neardup.deduplicate(df)
    assert kept.schema.names == df.schema.names
    assert sorted((r["doc_id"] is not None, r["doc_id"], r["text"]) for r in kept.collect() if r["doc_id"] is not None) == [(True, 1, ""), (True, 3, "a b c d e f g"), (True, 7, "other text here")]
    assert sum(r["doc_id"] is None for r in kept.collect()) == 1
    assert neardup.deduplicate(docs(spark, [])).collect() == [] and neardup.classes(docs(spark, [])).collect() == []


def test_deduplicate_tells_classes_by_root(spark):
    """Unrelated texts without id, or under one id, are classes of their own; copies among them still go."""
    texts, ids = ["null one", "null two", "null three", "null two", "id one", "id two", "id two", "id one", "last"], [None, None, None, None, 4, 4, 4, 6, 8]
    kept = neardup.deduplicate(docs(spark, texts, ids)).collect()
    want = [(None, "null one"), (None, "null three"), (None, "null two"), (4, "id one"), (4, "id two"), (8, "last")]
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted(want, key=str)


def test_estimates_follow_weighted_jaccard():
    rng = np.random.default_rng(0)
    h = np.sort(rng.integers(0, 2**63, 900, dtype=np.uint64))
    w = rng.choice([1.0, 1.1, 2.2], 900).astype(np.float32)
    for cut in (50, 150, 400):
        x, y = neardup.samples(h[cut:], w[cut:]), neardup.samples(h[: 900 - cut], w[: 900 - cut])
        both = w[cut : 900 - cut].sum()
        want = both / (w[cut:].sum() + w[: 900 - cut].sum() - both)
        assert abs((x == y).mean() - want) < 4 * math.sqrt(want * (1 - want) / neardup.SAMPLES)


@pytest.mark.parametrize("n", [300, 5_000, 20_000])
@pytest.mark.parametrize("differing", [1.0, 2.1, 4.0])
def test_estimates_of_long_texts(n, differing):
    """Also where the texts differ in their lightest (most frequent) or heaviest shingles only."""
    rng = np.random.default_rng(n)
    got, want = [], []
    for _ in range(4):
        k = n // 20
        h = rng.integers(0, 2**64, n + 2 * k, dtype=np.uint64)
        w = np.concatenate([rng.choice([1.05, 1.08, 1.1, 2.2], n, p=[0.3, 0.3, 0.3, 0.1]), np.full(2 * k, differing)]).astype(np.float32)
        x, y = (neardup.samples(h[i], w[i]) for i in (np.r_[:n, n : n + k], np.r_[:n, n + k : n + 2 * k]))
        got.append((x == y).mean())
        want.append(w[:n].sum() / w.sum())
    assert abs(np.mean(got) - np.mean(want)) < 4 * math.sqrt(want[0] * (1 - want[0]) / neardup.SAMPLES / len(got))


def test_samples_skip_no_shingle():
    """The least a of each sample over all shingles, without any limit."""
    rng = np.random.default_rng(4)
    for n in (1, 3, 700):
        h, w = rng.integers(0, 2**64, n, dtype=np.uint64), rng.choice([1.0, 1.1, 2.2, 5.5], n).astype(np.float32)
        got = neardup.samples(h, w)
        for s in range(neardup.SAMPLES):
            bits = (h.astype(np.uint32) ^ neardup.FLIP[s]) * neardup.ODD[s]
            a, t = neardup.ln_a(h, w.astype(float), np.full(n, neardup.SALT[s]), bits)
            k = a.argmin()
            assert got[s] == neardup.mixed(neardup.mixed(h[k : k + 1] + t[k : k + 1].astype(np.int64).astype(np.uint64) * neardup.MIX[2]) ^ neardup.SALT[s : s + 1])[0]


def test_components(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    up = {n: n for e in edges for n in e}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    key = lambda n: n.to_bytes(2, "big")
    df = spark.createDataFrame([(bytearray(key(a)), bytearray(key(b))) for a, b in edges], "a binary, b binary")
    assert {bytes(r["node"]): bytes(r["root"]) for r in neardup.components(df).collect()} == {key(n): key(top(n)) for n in up}


# --- pipeline -----------------------------------------------------------------------------------


def test_pipeline(spark):
    """Stages by brute force: accepted documents, one of each class, redacted, packed."""
    from lamina.llm import secrets, tokens

    source = spark.read.parquet(f"{SF}/documents.parquet")
    docs_ = {r["doc_id"]: r["text"] for r in source.collect()}
    scores = {r["doc_id"]: r["predicted"] for r in quality.op6_quality(spark, SF).collect()}
    ids = sorted(d for d in docs_ if scores[d])
    classes = brute_classes([docs_[d] for d in ids])
    kept = [d for d, c in zip(ids, classes, strict=True) if ids[c] == d]
    path, lib = tokens.vocabulary("byte_bpe_50k.tiktoken"), tokens.load(tokens.vocabulary("word_bpe_49k.json"))
    clean = {d: secrets.redact_text(docs_[d], secrets.find(docs_[d], path)[1], "[SECRET]") for d in kept}
    want = {d: [*lib.encode(t, add_special_tokens=False).ids, 0] for d, t in clean.items()}
    check_packing(corpus_pipeline.run(spark, SF).collect(), want, 2048)


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_the_columns(spark, stage):
    source = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    assert stage(spark, source, SF).schema.names == source.schema.names
    odd = source.selectExpr("*", "1 as score", "2 as _node", "3 as part")
    out = stage(spark, odd, SF)
    assert out.schema.names == odd.schema.names and out.where("score <> 1 or _node <> 2 or part <> 3").count() == 0
    assert stage(spark, source.where("doc_id < 0"), SF).collect() == []


def test_texts_outside_the_first_class_meet_every_part(spark):
    """In one large bucket, pairs of different classes are compared whatever parts they were dealt to."""
    nodes = [bytes([k]) for k in range(40)]
    entries = [(bytearray(n), 0, 7, bytearray(nodes[0]), 8, p, 0) for k, n in enumerate(nodes) for p in (range(8) if k == 0 else [k % 8])]
    entries = spark.createDataFrame(entries, "node binary, band int, key long, leader binary, parts int, part int, block int")
    labels = spark.createDataFrame([(bytearray(n), bytearray(nodes[0])) for n in nodes[:25]], "node binary, root binary")
    met, tasks = set(), defaultdict(set)
    for r in neardup.undecided(entries, labels, 5).collect():
        tasks[r["part"], r["block"]].add((bytes(r["node"]), bytes(r["class"])))
    for held in tasks.values():
        assert len(held) <= 5 + 1 + 2 * 5 + 2
        met |= {frozenset((a, b)) for a, c in held for b, d in held if c != d}
    want = {frozenset((a, b)) for i, a in enumerate(nodes) for b in nodes[max(i + 1, 25) :]}
    assert want <= met


def test_word_hashes_follow_split():
    texts = ["a\xa0b  c　d\x1ce\x0b f", "", "  x", "x  ", " \n", "É é ß", "a" * 9000 + " b", "ab cd  ef\n" * 150_000 + "x" * 1_200_000 + " tail"]
    seen = {}
    for t in texts:
        words, got = t.lower().split(), neardup.word_hashes(t).tolist()
        assert len(words) == len(got)
        for w, h in zip(words, got, strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("most", [1 << 15, 1 << 28])
def test_sieve_keeps_every_wanted_row(spark, most):
    """Also with more keys than bits, with negative keys, repeated rows and columns of the sieve's names; no key, no row."""
    rng = random.Random(most)
    keys = [0, -1, 1, 2**63 - 1, -(2**63), *(rng.randrange(-(2**63), 2**63) for _ in range(5000))]
    rows = spark.createDataFrame([(k, k) for k in keys * 2], "key long, _place long")
    wanted = rows.select("key").where("key % 7 = 0 or key in (0, -1, 1)").distinct()
    got = neardup.common.sifted(rows, neardup.F.col("key"), wanted, most)
    assert got.columns == rows.columns and got.where("key <> _place").count() == 0
    assert got.join(wanted, "key").count() == 2 * wanted.count()
    assert got.count() - 2 * wanted.count() <= 2 * len(keys) * (0.1 if most > 1 << 20 else 0.2)
    assert neardup.common.sifted(rows, neardup.F.col("key"), wanted.limit(0), most).count() == 0
