"""The n-gram join against all pairs, and components against a search."""

import re
from collections import Counter

import numpy as np
import pytest

from odd_cases import odd_rows, odd_texts  # noqa: F401

from lakeforge.llm import components, ngram_join
from lakeforge.llm.common import documents

SF = "/root/testdata/sf0.001"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", low) if w]


def word_sets(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def reachable(n, edges):
    near = {i: set() for i in range(n)}
    for a, b in edges:
        near[a].add(b), near[b].add(a)
    root = {}
    for i in range(n):
        stack = [i] if i not in root else []
        while stack:
            if (j := stack.pop()) not in root:
                root[j] = i
                stack += near[j]
    return root


def brute(rows):
    sets = [word_sets(t) for _, t in rows]
    edges = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    root = reachable(len(rows), edges)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[root[i]] = min(low.get(root[i], doc_id), doc_id)
    return Counter((d, len(s), low.get(root[i])) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def joined(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_components(df).collect())


def test_components_of_random_graphs(spark):
    rng = np.random.default_rng(2)
    for n, m in ((60, 40), (200, 210)):
        edges = [(int(a), int(b)) for a, b in rng.integers(0, n, (m, 2))] + [(n + i, n + i + 1) for i in range(30)]
        out = components.connected(spark.createDataFrame(edges, "a long, b long")).collect()
        root = reachable(n + 31, edges)
        touched = {x for e in edges if e[0] != e[1] for x in e}
        got = {r["node"]: r["root"] for r in out}
        assert len(out) == len(got) and set(got) == touched
        assert len({(got[x], root[x]) for x in touched}) == len({got[x] for x in touched}) == len({root[x] for x in touched})


def test_whole_table_against_all_pairs(spark):
    docs = documents(spark, SF)
    assert joined(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_odd_rows(spark, odd_rows):
    assert joined(odd_rows) == brute([(r["doc_id"], r["text"]) for r in odd_rows.collect()])
    assert joined(odd_rows.limit(0)) == Counter()
    kept = ngram_join.drop_near_copies(odd_rows)
    assert kept.columns == odd_rows.columns
    assert ngram_join.drop_near_copies(odd_rows.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [0, 1])
def test_chains_large_near_copy_groups_and_shared_passages(spark, seed):
    """Likeness around the threshold: chains of edits, one large group, one passage in most documents."""
    rng = np.random.default_rng(seed)
    word = lambda: f"w{rng.integers(400)}"
    text = lambda n: [word() for _ in range(n)]
    base, passage, docs = text(60), text(40), []
    for _ in range(60):  # one large group of near copies, all texts different
        t = list(base)
        t[int(rng.integers(60))] = f"x{rng.integers(10**6)}"
        docs.append(t)
    for _ in range(50):  # the same passage in texts that differ
        docs.append(text(int(rng.integers(0, 30))) + passage + text(int(rng.integers(0, 8))))
    chain = text(50)
    for _ in range(30):
        chain = list(chain)
        chain[int(rng.integers(50))] = word()
        docs.append(chain)
    docs += [t[: int(rng.integers(1, 8))] for t in docs[:20]]
    rows = [(i, " ".join(t)) for i, t in enumerate(docs)]
    assert joined(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)) == brute(rows)


def test_linked_at_the_threshold():
    a = np.sort(np.random.default_rng(0).integers(0, 1 << 63, 70, dtype=np.uint64) * np.uint64(2))
    assert ngram_join.linked(a[:60], a[:45]) and not ngram_join.linked(a[:61], a[:45])


def test_keeps_one_of_each_component(spark):
    docs = documents(spark, SF)
    want = {c for _, _, c in brute([(r["doc_id"], r["text"]) for r in docs.collect()])}
    assert sorted(r["doc_id"] for r in ngram_join.drop_near_copies(docs).collect()) == sorted(want)


@pytest.mark.parametrize("limit", [2, 3, 16])
def test_candidates_over_batch_borders(spark, limit):
    """Buckets of all sizes, cut by small Arrow batches: pairs of small ones, rows of large ones."""
    rng = np.random.default_rng(limit)
    rows = [(int(t), 0, int(r), 40, 0) for t in range(60) for r in rng.choice(500, int(rng.integers(1, 25)), replace=False)]
    rows += [(100 + t, 1 + r % 3, r, 40, 0) for t in range(3) for r in range(10)]
    df = spark.createDataFrame(rows, "token long, part int, rk long, n int, place int")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = ngram_join.candidates(df, limit).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    by_token = {}
    for t, part, r, _, _ in rows:
        by_token.setdefault((t, part > 0), []).append(r)
    pairs = {(min(a, b), max(a, b)) for (_, hot), g in by_token.items() if not hot and len(g) <= limit for a in g for b in g if a != b}
    assert {(r["rk"], r["other"]) for r in out if r["other"] is not None} == pairs
    want = Counter((t, r) for (t, hot), g in by_token.items() if hot or len(g) > limit for r in g)
    assert Counter((r["token"], r["rk"]) for r in out if r["other"] is None) == want


def test_range_counts_bound_every_overlap():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 1 << 63, int(n), dtype=np.uint64) * np.uint64(2)) for n in (1, 40, 300, 330, 5000, 6000)]
    sets += [np.unique(np.concatenate([s[: len(s) * 3 // 4], sets[0]])) for s in sets]
    a, b = [x for x in sets for _ in sets], sets * len(sets)
    bound = ngram_join.common_bound([ngram_join.range_counts(x).tobytes() for x in a], [ngram_join.range_counts(x).tobytes() for x in b])
    for most, x, y in zip(bound.tolist(), a, b):
        assert most >= len(np.intersect1d(x, y))
    assert 7 * bound[2 * len(sets) + 3] < 3 * (300 + 330)  # unrelated sets are told apart
    crowded = np.arange(1000, dtype=np.uint64)
    assert ngram_join.common_bound([ngram_join.range_counts(crowded).tobytes()], [ngram_join.range_counts(crowded).tobytes()])[0] >= 1000


def test_parity_bitmaps_bound_the_difference():
    rng = np.random.default_rng(4)
    for n in (1, 5, 146, 3000):
        for changed in (0, 1, n // 10, n // 2):
            a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            b = np.concatenate((a[changed:], rng.integers(0, 1 << 63, changed, dtype=np.uint64)))
            differ = int(np.bitwise_count((ngram_join.parity(a) ^ ngram_join.parity(b)).view(np.uint64)).sum())  # of signed words it counts absolute values
            assert differ <= 2 * changed and (differ == 0) == (changed == 0)
            assert len(ngram_join.parity(a)) == ngram_join.PARITY
