"""Substring removal against a window count, and the interval tree against all pairs."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from odd_cases import odd_rows, odd_texts  # noqa: F401

from lakeforge.llm import substring_dedup as sd
from lakeforge.llm.common import documents

SF = "/root/testdata/sf0.001"


def covered(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    marks = []
    for d in data:
        mark = np.zeros(len(d) + 1, np.int64)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                mark[i] += 1
                mark[i + length] -= 1
        marks.append(np.cumsum(mark)[: len(d)] > 0)
    return data, marks


def brute(rows, length):
    out = Counter()
    for (doc_id, _), d, m in zip(rows, *covered([t for _, t in rows], length)):
        spans = int((m & ~np.concatenate(([False], m[:-1]))).sum()) if len(m) else 0
        kept = bytes(np.frombuffer(d, np.uint8)[~m])
        out[doc_id, len(d), int(m.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def removed(df, **kw):
    cols = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return Counter(tuple(r[c] for c in cols) for r in sd.removal(df, **kw).collect())


def test_whole_table(spark):
    docs = documents(spark, SF)
    assert removed(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()], 200)


def made(seed):
    """Random strings with copies, shared passages, runs, and cuts at either end."""
    rng = np.random.default_rng(seed)
    pick = lambda n: "".join(rng.choice(list("abé "), n))
    passage = [pick(int(n)) for n in rng.integers(10, 120, 6)]
    texts = ["".join(p for _ in range(int(rng.integers(0, 6))) for p in (pick(int(rng.integers(0, 50))), passage[int(rng.integers(6))])) for _ in range(60)]
    texts += texts[:7] + [t[5:] for t in texts[:5]] + [t[:-3] for t in texts[5:9]] + ["a" * 300, "ab" * 70, "xyz" * 40, passage[0] * 3]
    return texts


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("limit", [100_000, 2])
def test_random_strings_and_large_buckets(spark, seed, limit):
    rows = list(enumerate(made(seed)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert removed(df, length=40, bucket_limit=limit) == brute(rows, 40)


@pytest.mark.parametrize("limit", [100_000, 2])
def test_runs_shorter_than_a_window_between_unique_texts(spark, limit):
    """One window may hold its anchor's gram several times, and still occur once."""
    rng = np.random.default_rng(6)
    unique = lambda: "".join(rng.choice(list("abcdefghijklmnop"), 60))
    runs = [(c * 30)[:30] for c in ("-", "=", " ", "0", "*", "_", "#", "+", "-=", "xyz", "~", ".", "/", "1", "2", "3")]
    rows = list(enumerate(unique() + run + unique() for run in runs for _ in range(3)))
    assert brute(rows, 40) == Counter((i, len(t), 0, 0, hashlib.sha256(t.encode()).hexdigest()) for i, t in rows)
    assert removed(spark.createDataFrame(rows, "doc_id long, text string"), length=40, bucket_limit=limit) == brute(rows, 40)


def test_odd_rows(spark, odd_rows):
    rows = [(r["doc_id"], r["text"]) for r in odd_rows.collect()]
    assert removed(odd_rows) == brute(rows, 200)
    assert removed(odd_rows.limit(0)) == Counter()
    kept = sd.cut_repeats(odd_rows)
    assert kept.columns == odd_rows.columns and kept.count() == len(rows)
    assert sd.cut_repeats(odd_rows.limit(0)).count() == 0


def test_cut_texts_are_whole_characters(spark):
    rows = list(enumerate(made(5)))
    out = {r["doc_id"]: r["text"] for r in sd.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=40).collect()}
    for (i, text), d, m in zip(rows, *covered([t for _, t in rows], 40)):
        at, want = 0, []
        for c in text:
            n = len(c.encode())
            if not m[at : at + n].all():
                want.append(c)
            at += n
        assert out[i] == "".join(want)


def test_groups_list_all_occurrences(spark):
    rows = list(enumerate(made(1)[:40]))
    data = {i: t.encode() for i, t in rows}
    found = defaultdict(set)
    for r in sd.repeat_groups(spark.createDataFrame(rows, "doc_id long, text string"), length=40).collect():
        found[r["group_id"], r["n_bytes"]].add((r["doc_id"], r["begin"]))
    assert found
    strings = set()
    for (_, n), places in found.items():
        same = {data[d][b : b + n] for d, b in places}
        assert len(same) == 1 and len(next(iter(same))) == n >= 40
        string = same.pop()
        assert string not in strings
        strings.add(string)
        assert places == {(d, b) for d, t in data.items() for b in range(len(t)) if t.startswith(string, b)}
    _, marks = covered([t for _, t in rows], 40)
    for (i, _), mark in zip(rows, marks):
        by_groups = np.zeros(len(mark), bool)
        for (_, n), places in found.items():
            for d, b in places:
                if d == i:
                    by_groups[b : b + n] = True
        assert (by_groups == mark).all()


def test_interval_tree_against_all_pairs():
    rng = np.random.default_rng(4)
    for _ in range(30):
        words = sorted(bytes(rng.choice(list(b"ab"), int(rng.integers(1, 9))).tolist()) for _ in range(25))
        matrix, sizes = sd._matrix(words, 9)
        common = sd._common(matrix, sizes)
        got = {(d, b, e) for d, b, e in sd.prefix_intervals(common, 1)}
        want = set()
        for i in range(len(words)):
            for j in range(i + 1, len(words)):
                d = int(common[i + 1 : j + 1].min())
                if d:
                    b, e = i, j + 1
                    while b and common[b] >= d:
                        b -= 1
                    while e < len(words) and common[e] >= d:
                        e += 1
                    want.add((d, b, e))
        assert got == want
