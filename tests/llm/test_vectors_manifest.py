"""Nearest neighbours, hard negatives and the Merkle manifest against brute force."""

import hashlib
import time
import zlib
from collections import defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from odd_cases import odd_rows, odd_texts  # noqa: F401

from lakeforge.llm import hard_negatives, manifest, nearest
from lakeforge.llm.common import documents
from lakeforge.session import read_table

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id long, embedding array<double>, label int, key long, _cell string"


def whole(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


@pytest.fixture(scope="module")
def odd_vectors(spark):
    """Equal vectors in number, null, empty, zero, short and non-finite ones, repeated and null ids, unequal norms."""
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) * (1 + i % 3)).tolist(), i % 3) for i in range(200)]
    rows += [(i, [1.0, 0.5, 0.0, 0.0, 0.0, 0.25], 1) for i in range(200, 300)]
    rows += [(300, None, 1), (301, [], 1), (302, [0.0] * 6, 1), (303, [1.0] * 5 + [None], 1), (304, [float("nan")] * 6, 1),
             (305, [float("inf")] + [1.0] * 5, 2), (306, [1.0, 2.0], 2), (307, [1.0] * 6, None), (None, [1.0] * 6, 1), (40, [2.0] * 6, 0), (40, [2.0] * 6, 0)]
    return spark.createDataFrame([(*r, 7, "x") for r in rows], VECTORS).repartition(3)


def brute_nearest(rows, k):
    rows = [(i, np.array(v)) for i, v in rows if i is not None and whole(v) and any(v)]
    size = len(rows[0][1])
    rows = [(at, i, v) for at, (i, v) in enumerate(rows) if len(v) == size]
    out = {}
    for at, i, q in rows:
        if i % 20 == 0:
            out[at] = (i, sorted(((-(v * q).sum(), j) for b, j, v in rows if b != at))[:k])
    return list(out.values())


def recall(got, want):
    """Share of the true neighbours found, equal scores counting as the same."""
    by = defaultdict(list)
    for r in sorted(got, key=lambda r: r["rank"]):
        by[r["query_id"]].append(r)
    hits = total = 0
    for i, true in want:
        least = -true[-1][0] - 1e-12 if true else 0
        hits += min(len(true), sum(r["score"] >= least for r in by[i]))
        total += len(true)
    return hits / total


@pytest.mark.parametrize("shard_rows", [64, 8192])
def test_nearest_odd_rows(spark, odd_vectors, shard_rows):
    asked = F.col("vec_id") % 20 == 0
    rows = [(r["vec_id"], r["embedding"]) for r in odd_vectors.collect() if r["vec_id"] != 40]
    got = nearest.nearest(odd_vectors.where("vec_id IS NULL OR vec_id <> 40"), asked, k=7, shard_rows=shard_rows).collect()
    want = brute_nearest(rows, 7)
    assert recall(got, want) >= 0.95
    # of equal vectors, the smaller ids
    same = [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == 200), key=lambda r: r["rank"])]
    true = [j for _, j in dict(want)[200]]
    assert [j for j in same if j >= 200] == [j for j in true if j >= 200]
    assert all(sorted(r["rank"] for r in got if r["query_id"] == i) == list(range(1, 8)) for i, _ in want)
    for r in got[:50]:
        a, b = (np.array(next(v for i, v in rows if i == x)) for x in (r["query_id"], r["vec_id"]))
        assert r["score"] == pytest.approx((a * b).sum(), rel=1e-14)


def test_nearest_few_repeated_and_no_rows(spark, odd_vectors):
    asked = F.col("vec_id") % 20 == 0
    few = nearest.nearest(odd_vectors.where("vec_id IN (20, 21, 22, 302)"), asked).collect()
    assert sorted((r["query_id"], r["rank"]) for r in few) == [(20, 1), (20, 2)]
    assert nearest.nearest(odd_vectors.limit(0), asked).count() == 0
    assert nearest.nearest(odd_vectors.where("vec_id = 300"), asked).count() == 0
    twice = nearest.nearest(odd_vectors.where("vec_id = 40"), asked).collect()  # three rows with one id ask for the others
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in twice) == sorted((40, k, 40) for k in (1, 2) for _ in range(3))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_nearest_recall(spark, sf):
    rows = read_table(spark, f"/root/testdata/{sf}", "embeddings").select("vec_id", "embedding").collect()
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], float)
    got = nearest.query(spark, f"/root/testdata/{sf}").collect()
    want = []
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -np.inf
        want.append((ids[i], [(-v, 0) for v in np.sort(s)[::-1][:20]]))
    assert len(got) == 20 * len(want)
    assert recall(got, want) >= 0.95


def shard_of(vectors):
    keys, largest = np.arange(len(vectors)), np.sqrt((vectors * vectors).sum(1).max())
    axes = nearest.directions(vectors.shape[1] + 1, nearest.PROJECTIONS)
    return nearest.RankedProjections(keys, keys, vectors, largest, axes)


@pytest.mark.parametrize("n", [1, 63, 64, 65, 1000])
def test_windows_are_counted_row_by_row(n):
    rng = np.random.default_rng(n)
    vectors = rng.normal(size=(n, 8))
    vectors[n // 2 :] = vectors[0]  # equal rows fill many levels
    shard = shard_of(vectors)
    at, half = rng.normal(size=(5, nearest.PROJECTIONS)) / 3, np.array([0.0, 0.01, 0.1, 0.3, 5.0])
    inside = [np.unpackbits(w.view(np.uint8), axis=1, count=n, bitorder="little") for w in shard.windows(at, half)]
    counts = np.sum(inside, axis=0)
    unit = vectors / shard.largest
    values = np.concatenate([unit, np.sqrt(np.maximum(0, 1 - (unit * unit).sum(1)))[:, None]], axis=1) @ shard.axes
    for q in range(5):
        for j in range(nearest.PROJECTIONS):  # a window holds all rows it should, and those up to the next level
            assert inside[j][q][np.abs(values[:, j] - at[q, j]) <= half[q] - 1e-12].all()
    assert (counts[4] == nearest.PROJECTIONS).all()
    for least in (0, 1, 2, 40, 64, 127, 128, 129, 300):
        got = nearest.at_least(shard.windows(at, half), least)
        assert (np.unpackbits(got.view(np.uint8), axis=1, count=n, bitorder="little") == (counts >= least)).all()


def test_windows_cost_less_than_counting_each_row():
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(8192, 64))
    shard, queries = shard_of(vectors), vectors[:64] / np.linalg.norm(vectors[:64], axis=1)[:, None]
    at, half = queries @ shard.axes[:-1], np.full(64, 1.1 / np.sqrt(65))
    values = np.concatenate([vectors / shard.largest, np.zeros((8192, 1))], axis=1) @ shard.axes
    order = np.argsort(values, axis=0)
    values = np.take_along_axis(values, order, axis=0)

    def row_by_row():
        for q in range(64):
            ends = [np.searchsorted(values[:, j], [at[q, j] - half[q], at[q, j] + half[q]]) for j in range(len(shard.axes.T))]
            np.bincount(np.concatenate([order[a:b, j] for j, (a, b) in enumerate(ends)]), minlength=8192)

    def took(f):
        began = time.process_time()
        f()
        return time.process_time() - began

    least = min(took(row_by_row) for _ in range(3))
    assert min(took(lambda: nearest.at_least(shard.windows(at, half), 79)) for _ in range(3)) < 0.5 * least


def test_nearest_within_a_shard():
    """Random, clustered and copied rows, unequal norms, squares that underflow: a shard's nearest against all products."""
    rng = np.random.default_rng(4)
    far = rng.normal(size=(3000, 32))
    near = far[rng.integers(0, 5, 1500)] + 0.01 * rng.normal(size=(1500, 32))
    vectors = np.concatenate([far, near, np.repeat(far[:1], 300, axis=0), 3 * far[:50], 1e-9 * far[:50], 1e-200 * far[:5]])
    shard, n = shard_of(vectors), len(vectors)
    asked = np.concatenate([np.arange(0, n, 90), np.arange(n - 60, n)])
    hits = 0
    for begin in range(0, len(asked), 64):
        own = asked[begin : begin + 64]
        for a, rows, scores in shard.nearest(vectors[own], own, 20, nearest.threshold()):
            true = (vectors * vectors[own[a]]).sum(1)
            assert (scores == true[rows]).all() and own[a] not in rows and len(set(rows)) == 20
            assert sorted(zip(-scores, rows)) == list(zip(-scores, rows))
            true[own[a]] = -np.inf
            hits += (scores >= np.sort(true)[-20]).sum()
    assert hits >= 0.99 * 20 * len(asked)


def brute_negatives(rows):
    rows = [(i, [int(np.floor(256 * x)) for x in v], label) for i, v, label in rows if i is not None and label is not None and whole(v) and len(v) == 6]
    out = []
    for at, (i, a, label) in enumerate(rows):
        if i % 100:
            continue
        score = lambda v: sum(p * q for p, q in zip(a, v))
        others = sorted((-score(v), j, lab == label) for b, (j, v, lab) in enumerate(rows) if b != at)
        for p, j, same in [o for o in others if o[2]][:5]:
            fits = [o for o in others if not o[2] and 80 * p >= 100 * o[0] >= 100 * p]
            out += [(i, j, rank, n, -p, -s) for rank, (s, n, _) in enumerate(fits[:5], 1)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [50, 8192])
def test_hard_negatives_odd_rows(spark, odd_vectors, shard_rows):
    df = odd_vectors.where("vec_id IS NULL OR vec_id <> 40")
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, shard_rows=shard_rows)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_negatives([(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()])
    assert sorted(map(tuple, got.collect())) == want and want


def test_hard_negatives_no_rows_and_large_integers(spark, odd_vectors):
    assert hard_negatives.hard_negatives(odd_vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    large = odd_vectors.where("vec_id < 30").withColumn("embedding", F.transform("embedding", lambda x: x * 1e5))
    got = hard_negatives.hard_negatives(large, F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, got)) == brute_negatives([(r["vec_id"], r["embedding"], r["label"]) for r in large.collect()])


def test_threshold_stops_before_the_lists_end():
    rng = np.random.default_rng(3)
    vectors = np.floor(256 * rng.normal(size=(2000, 3))).astype(np.int64)
    lists = hard_negatives.SortedLists(np.arange(2000), vectors)
    read = 0
    anchor = np.array([300, -20, 5])
    for new, scores, bound in lists.accesses(anchor):
        read += len(new)
        top = np.sort(vectors @ anchor)[::-1][:3]
        if bound is not None and bound < top[-1]:
            break
    assert read < 1000
    (rows, scores), = hard_negatives.best(lists, anchor, np.zeros(2000, bool), [(None, None)], 3, np.arange(2000), np.arange(2000))
    assert scores.tolist() == top.tolist()


def sha(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return sha("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def brute_manifest(rows):
    """Rows of doc_id, source, lang, n_chars, text, with doc_ids unique and present."""

    def tree(nodes):
        """The root, and per leaf the others of its runs with its places."""
        steps = [[] for _ in nodes]
        at = list(range(len(nodes)))
        while len(nodes) > 1:
            for s, p in zip(steps, at):
                run = nodes[p // 8 * 8 : p // 8 * 8 + 8]
                s.append((p % 8, run[: p % 8] + run[p % 8 + 1 :]))
            nodes, at = [sha(nodes[i : i + 8]) for i in range(0, len(nodes), 8)], [p // 8 for p in at]
        return nodes[0], steps

    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    parts = {v: sorted((r for r in rows if r[2] == v), key=lambda r: r[0]) for v in langs}
    trees = {v: tree([leaf(r) for r in parts[v]]) for v in langs}
    root, above = tree([trees[v][0] for v in langs])
    out = []
    for v, up in zip(langs, above):
        for r, own in zip(parts[v], trees[v][1]):
            steps = own + up
            text = r[4]
            if zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            node = leaf((*r[:4], text))
            for place, others in steps:
                node = sha([*others[:place], node, *others[place:]])
            proof = sha(h for _, others in steps for h in others)
            out.append((r[0], leaf(r), trees[v][0], root, proof, node, node == root))
    return sorted(out)


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_manifest_matches_brute_force(spark, levels):
    docs = documents(spark, SF).select(FIELDS)
    odd = [(10**9 + i, None, lang, None if i % 2 else i, text) for i, (lang, text) in enumerate(
        [(None, "Aa"), (None, None), ("", "É漢"), ("", ""), ("zz", "B"), ("é", "C"), *[(f"l{j:02}", "D" * j) for j in range(70)]])]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    got = manifest.manifest(docs.repartition(5), *manifest.document_leaves(), levels=levels)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = brute_manifest([tuple(r) for r in docs.collect()])
    assert sorted(map(tuple, got.collect())) == want
    assert {r[-1] for r in want} == {True, False}


def test_manifest_odd_rows(spark, odd_rows):
    docs = odd_rows.withColumns({"source": F.lit(None).cast("string"), "lang": F.lit("a"), "n_chars": F.lit(1), "pos": F.lit("x"), "tree": F.lit(0)})
    got = manifest.manifest(docs, *manifest.document_leaves(), levels=1).collect()
    assert len(got) == docs.count() and len({r["root"] for r in got}) == 1
    assert sum(r["doc_id"] is None for r in got) == 2
    assert {r["verified"] for r in got if r["doc_id"] is None} == {True}
    # all values of a repeated row are those of its copy's leaf
    assert manifest.manifest(docs.limit(0), *manifest.document_leaves()).count() == 0
    (one,) = manifest.manifest(docs.where("doc_id = 5"), *manifest.document_leaves()).collect()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == sha([])
