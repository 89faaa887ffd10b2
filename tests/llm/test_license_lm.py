"""License scan against its SQL and by hand; the language model's sums and its held-out gain."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_cases import odd_rows, odd_texts  # noqa: F401

from lakeforge.llm import license_scan, maxent_lm
from lakeforge.llm.common import documents

SF = "/root/testdata/sf0.01"


def test_license_scan_has_no_python_and_no_cross_join(spark):
    plan = license_scan.query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_nearest_directory_and_license_files(spark):
    gpl = "This work is licensed under the GNU General Public License, version 3."
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    rows = [
        (1, "a/LICENSE", gpl), (2, "a/x.c", f"{mit}\ncode"), (3, "a/y.c", "code"), (4, "a/b/c/z.c", "code"),
        (5, "a/b/c/d/LICENSE.txt", f"text\n{apache}"), (6, "a/b/c/d/w.c", None), (7, "other/v.c", ""), (8, None, "no path"),
        (9, "ab/u.c", "the licence of nothing that is known here"), (9, "ab/u.c", mit), (None, "ab/q/r.c", "code"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string").withColumn("license", F.lit("clash"))
    out = Counter((r["doc_id"], r["license"], r["origin"], r["directory"]) for r in license_scan.license_scan(df, F.col("path")).collect())
    assert out == Counter([
        (1, "GPL-3.0", "own", None), (2, "MIT", "own", None), (3, "GPL-3.0", "inherited", "a"), (4, "GPL-3.0", "inherited", "a"),
        (5, "Apache-2.0", "own", None), (6, "Apache-2.0", "inherited", "a/b/c/d"), (7, None, "none", None), (8, None, "none", None),
        (9, "MIT", "inherited", "ab"), (9, "MIT", "own", None), (None, "MIT", "inherited", "ab"),
    ])
    assert license_scan.license_scan(df.limit(0), F.col("path")).count() == 0


def test_license_scan_odd_rows(spark, odd_rows):
    out = license_scan.license_scan(odd_rows, F.col("block")).collect()
    assert len(out) == odd_rows.count() and all(r["license"] is None for r in out)


def brute_base(rows):
    def words(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return [w for w in re.split("[\x20\x09-\x0d]+", low) if w] + [None]

    held = [i is None or zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(w for (_, t), h in zip(rows, held) if not h for w in words(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for (i, t), h in zip(rows, held):
        ws = words(t)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        out.append((i, h, len(ws), sum(w in counts for w in ws), n, round(base, 6)))
    return Counter(out)


def scored(df, **kw):
    return maxent_lm.score_texts(df, **kw).collect()


def plain(rows):
    return Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows)


@pytest.mark.parametrize("head", [1 << 18, 500])
def test_base_score_and_held_out_gain(spark, head):
    docs = documents(spark, SF)
    out = scored(docs, head=head)
    assert plain(out) == brute_base([(r["doc_id"], r["text"]) for r in docs.collect()])
    held = [r for r in out if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.985 * sum(r["base_score"] for r in held)
    assert all(r["score"] <= 0 for r in out)


def test_lm_odd_rows(spark, odd_rows):
    out = scored(odd_rows)
    assert plain(out) == brute_base([(r["doc_id"], r["text"]) for r in odd_rows.collect()])
    assert all(math.isfinite(r["score"]) for r in out)
    assert scored(odd_rows.limit(0)) == []
    untrained = scored(odd_rows, train=F.lit(False))
    assert all(r["score"] == 0 == r["train_tokens"] for r in untrained)


def test_probabilities_of_a_history_add_up_to_one():
    """Over all known words and one unseen word of each rest class."""
    rng = np.random.default_rng(0)
    weights = rng.normal(size=(maxent_lm.ROWS + 1, maxent_lm.CLASSES)).astype(np.float32)
    rows = np.stack([rng.integers(0, maxent_lm.ROWS, 50).astype(np.uint16) for _ in range(3)])
    p = maxent_lm.class_probabilities(weights, rows)
    assert np.allclose(p.sum(1), 1, atol=1e-5)
    words = [b"", *(b"w%d" % i for i in range(2000))]
    v = maxent_lm.Vocabulary(words, rng.integers(2, 50, len(words)), 10**5, 3000)
    v.set_clusters(rng.integers(0, maxent_lm.CLUSTERS, len(words)), rng.normal(size=(4096, maxent_lm.CLUSTERS)))
    classes = v.head_classes()
    mass = np.bincount(classes, v.counts, maxent_lm.CLASSES)
    assert np.allclose(np.bincount(classes, v.counts / mass[classes], maxent_lm.CLASSES), mass > 0)
    rest = rng.integers(1, 9, 400)  # counts of a rest class: each known word, and room for one unseen
    assert math.isclose(((rest + 1).sum() + 1) / (rest.sum() + len(rest) + 1), 1)


def test_histories_do_not_cross_texts():
    v = maxent_lm.Vocabulary([b"a", b"b", b""], np.array([3, 2, 1]), 6, 3)
    v.set_clusters(np.zeros(3), np.ones((1, maxent_lm.CLUSTERS)))
    ids, classes, ends, others = v.code(["A b new", "", "b a"])
    assert ids.tolist() == [0, 1, 3, 2, 2, 1, 0, 2] and ends.tolist() == [4, 5, 8] and others == [b"new"]
    together = maxent_lm.histories(ids, classes, ends, 3)
    apart = [maxent_lm.histories(ids[b:e], classes[b:e], np.array([e - b]), 3) for b, e in ((0, 4), (4, 5), (5, 8))]
    assert (together == np.concatenate(apart, axis=1)).all()


def test_gradient_sums_match_plain_sums(spark):
    texts = ["a b a c", "b b a", "c a b " * 30]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    v = maxent_lm.Vocabulary([b"a", b"b", b"", b"c"], np.array([35, 33, 3, 31]), 102, 4)
    v.set_clusters(np.arange(4), np.ones((1, maxent_lm.CLUSTERS)))
    shared = spark.sparkContext.broadcast(v)
    weights = np.random.default_rng(1).normal(size=(maxent_lm.ROWS + 1, maxent_lm.CLASSES)).astype(np.float32)
    seen, model = np.zeros((2, maxent_lm.ROWS, maxent_lm.CLASSES))
    ids, classes, ends, _ = v.code(texts)
    rows = maxent_lm.histories(ids, classes, ends, 4)
    p = maxent_lm.class_probabilities(weights, rows)
    for kind in rows:
        for r, c, q in zip(kind, classes, p):
            seen[r, c] += 1
            model[r] += q
    assert (maxent_lm.observed(df, shared) == seen).all()
    assert np.allclose(maxent_lm.expected(df, shared, spark.sparkContext.broadcast(weights)), model, atol=1e-3)


def test_three_bands_and_updates_until_the_likelihood_settles(spark, monkeypatch):
    docs = documents(spark, "/root/testdata/sf0.001").selectExpr("doc_id AS rk", "text").where("text IS NOT NULL").limit(200)
    words = Counter(w for r in docs.collect() for w in [*r["text"].encode().lower().split(), b""])
    listed = sorted(words, key=lambda w: (-words[w], w))
    v = maxent_lm.Vocabulary(listed, np.array([words[w] for w in listed]), sum(words.values()), len(words))
    v.set_clusters(np.zeros(len(listed)), np.ones((1, maxent_lm.CLUSTERS)))
    assert len({int(c) for w, c in zip(listed, v.head_classes()) if w}) == 1 + sum(len(listed) > b for b in (64, 1024))
    told, sums = [], maxent_lm.sums_of
    monkeypatch.setattr(maxent_lm, "sums_of", lambda *a: told.append(sums(*a)) or told[-1])
    shared = spark.sparkContext.broadcast(v)
    weights = maxent_lm.train_weights(docs, shared)
    ids, classes, ends, _ = v.code([r["text"] for r in docs.collect()])
    p = maxent_lm.class_probabilities(weights, maxent_lm.histories(ids, classes, ends, len(listed)))
    reached = np.log(p[np.arange(len(p)), classes].astype(np.float64)).mean()
    # every slice in every round, and all tokens in a round
    n = maxent_lm.SLICES
    assert len(told) % n == 0
    for r in range(0, len(told), n):
        assert sum(t[4] for t in told[r : r + n]) == len(ids)
    bias = np.log((maxent_lm.class_mass(v) + 0.5) / (len(ids) + 0.5 * maxent_lm.CLASSES))[classes].mean()
    assert sum(t[3] for t in told[:n]) / len(ids) == pytest.approx(bias, rel=1e-4)
    rounds = [np.mean([(t[2] - t[3]) / t[4] for t in told[r : r + n]]) for r in range(0, len(told), n)]
    assert rounds == sorted(rounds) and reached - bias > rounds[-1] > 0


def test_scores_match_a_plain_recomputation(spark):
    """Token by token from the weights: class softmax, share of the word in its class, counts of other words."""
    texts = ["A b a  c", "", "new b a Newer new", None, "c " * 50 + "other"]
    rows = spark.createDataFrame(list(enumerate(texts)), "rk long, text string").selectExpr("rk", "coalesce(text, '') AS text")
    listed, counts = [b"a", b"b", b"", b"c"], [40, 30, 9, 20]
    v = maxent_lm.Vocabulary(listed, np.array(counts), 120, 11)
    v.set_clusters(np.arange(4), np.random.default_rng(2).normal(size=(64, maxent_lm.CLUSTERS)))
    v.rest = np.arange(2 * maxent_lm.CLUSTERS).reshape(-1, 2) + 3
    weights = np.random.default_rng(1).normal(size=(maxent_lm.ROWS + 1, maxent_lm.CLASSES)).astype(np.float32)
    context = spark.sparkContext
    got = {r["rk"]: r for r in maxent_lm.score_known(rows, context.broadcast(v), context.broadcast(weights)).collect()}
    kinds = v.head_classes().tolist()
    for rk, text in enumerate(texts):
        tokens = (text or "").lower().encode().split() + [b""]
        classes = [kinds[listed.index(t)] if t in listed else maxent_lm.REST + int(v.cluster_of([t])[0]) for t in tokens]
        ids = np.array([listed.index(t) if t in listed else 4 for t in tokens])
        features = maxent_lm.histories(ids, np.array(classes, np.int8), np.array([len(ids)]), 4)
        score = base = 0.0
        for t, c, f in zip(tokens, classes, features.T):
            z = [float(sum(weights[r, k] for r in f) + weights[-1, k]) for k in range(maxent_lm.CLASSES)]
            score += math.log10(math.exp(z[c]) / sum(map(math.exp, z)))
            base -= math.log10(120 + 11 + 1)
            if t in listed:
                i = listed.index(t)
                score += math.log10(counts[i] / sum(n for n, k in zip(counts, kinds) if k == c))
                base += math.log10(counts[i] + 1)
            else:
                score -= math.log10(v.rest[c - maxent_lm.REST].sum() + 1)
        assert got[rk]["score"] == pytest.approx(score, rel=1e-4) and got[rk]["base"] == pytest.approx(base, rel=1e-9)
        assert Counter(dict(zip(got[rk]["others"], got[rk]["times"]))) == Counter(t for t in tokens if t not in listed)
