"""Exact dedup, fingerprints and toxicity."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from odd_cases import odd_rows, odd_texts  # noqa: F401

from lakeforge.llm import exact_dedup, fingerprints, toxicity
from lakeforge.llm.common import documents
from lakeforge.session import read_table

SF = "/root/testdata/sf0.001"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("parts", [1, 13])
def test_exact_dedup_odd_rows(spark, odd_rows, keep, parts):
    rows = [(r["doc_id"], lowered(r["text"])) for r in odd_rows.collect()]
    out = exact_dedup.exact_dedup(odd_rows.repartition(parts), keep=keep, rounds_per_merge=1).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    best = {t: (max if keep == "max" else min)((i for i in g if i is not None), default=None) for t, g in groups.items()}
    digest = {t: hashlib.sha256(t.encode()).hexdigest() for t in groups}
    want = Counter((i, best[t], len(groups[t]), digest[t]) for i, t in rows)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out) == want
    kept = Counter((r["doc_id"], r["text_sha256"]) for r in out if r["kept"])
    assert kept == Counter((best[t], digest[t]) for t in groups)


def test_exact_dedup_keeps_columns_and_empty_table(spark, odd_rows):
    out = exact_dedup.drop_copies(odd_rows)
    assert out.columns == odd_rows.columns
    assert out.count() == len({lowered(r["text"]) for r in odd_rows.collect()})
    assert exact_dedup.drop_copies(odd_rows.limit(0)).count() == 0
    assert exact_dedup.exact_dedup(odd_rows.limit(0)).count() == 0


def test_exact_dedup_has_no_python(spark):
    plan = exact_dedup.query(spark, SF)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def brute_counts(data):
    total = np.zeros(fingerprints.BUCKETS, np.int64)
    for (i, j), (a, b, c) in zip(fingerprints.SHAPES, fingerprints.TABLES):
        for at in range(len(data) - j):
            total[(a[data[at]] ^ b[data[at + i]] ^ c[data[at + j]]) % fingerprints.BUCKETS] += 1
    return total


def test_bucket_counts_and_digest(odd_texts):
    for text in odd_texts:
        data = (text or "").encode()
        assert (fingerprints.bucket_counts(np.frombuffer(data, np.uint8)) == brute_counts(data)).all()
        assert len(fingerprints.digest(data)) == 66
    long = np.frombuffer(np.random.default_rng(1).bytes((1 << 20) + 77), np.uint8)
    pieces = sum(np.bincount((a[long[: len(long) - j]] ^ b[long[i : len(long) - j + i]] ^ c[long[j:]]) & 127, minlength=128)
                 for (i, j), (a, b, c) in zip(fingerprints.SHAPES, fingerprints.TABLES))
    assert (fingerprints.bucket_counts(long) == pieces).all()


def test_likeness_is_bounded_symmetric_and_one_for_equals(odd_texts):
    d = [fingerprints.digest((t or "").encode()) for t in odd_texts]
    a, b = [x for x in d for _ in d], d * len(d)
    like = fingerprints.likeness(a, b)
    assert (like >= 0).all() and (like <= 1).all() and (like == fingerprints.likeness(b, a)).all()
    assert all(v == 1 for v, x, y in zip(like, a, b) if x == y)


def brute_edits(rows):
    """``rows`` in order: the next of each is the one after it, of the last the first."""
    out = []
    for n, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(n + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        p, q, r = (fingerprints.digest(t.encode()) for t in (text, edited, after))
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), p, q, *fingerprints.likeness([p, p], [q, r])))
    return Counter(out)


@pytest.mark.parametrize("blocks", [1, 3, 40])
def test_fingerprint_edits_against_brute_force(spark, blocks):
    docs = documents(spark, SF)
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True)
    assert Counter(map(tuple, fingerprints.fingerprint_edits(docs, blocks=blocks).collect())) == brute_edits(rows)


def test_fingerprint_edits_odd_rows(spark, odd_rows):
    found = odd_rows.coalesce(1)
    rows = [(r["doc_id"], r["text"]) for r in found.collect()]
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is None, -(rows[n][0] or 0), n))
    out = fingerprints.fingerprint_edits(found, blocks=4)
    assert Counter(map(tuple, out.collect())) == brute_edits([rows[n] for n in order])
    assert fingerprints.fingerprint_edits(odd_rows.limit(0)).count() == 0
    assert fingerprints.fingerprint_edits(odd_rows.limit(1)).count() == 1
    assert fingerprints.fingerprints(odd_rows).count() == len(rows)


def test_ordinal_fit_recovers_order():
    rng = np.random.default_rng(3)
    n, k = 3000, 60
    weight = np.concatenate([[3, 2, 1.5], np.zeros(k - 3)])
    x = rng.random((n, k)) < 0.2
    score = x @ weight + rng.logistic(size=n)
    grades = (score > 2).astype(int) + (score > 4)
    rows, cols = np.nonzero(x)
    model = toxicity.fit_ordinal(rows[rows < 2000], cols[rows < 2000], grades[:2000], l1=2)
    assert (np.diff(model.thresholds) > 0).all() and set(model.features) >= {0, 1, 2}
    w = dict(zip(model.features, model.weights))
    assert w[0] > w[2] > max([abs(v) for f, v in w.items() if f > 2], default=0)
    scores = x[2000:] @ np.array([w.get(f, 0) for f in range(k)])
    above = model.above(scores)
    assert (above[:, 0] >= above[:, 1]).all()
    assert ((above[:, 0] > 0.5) == (grades[2000:] > 0)).mean() > 0.75


def test_toxicity_held_out_accuracy(spark):
    docs, labels = documents(spark, "/root/testdata/sf0.01"), read_table(spark, "/root/testdata/sf0.01", "labels")
    fit = labels.where("crc32(cast(doc_id AS string)) % 4 < 3")
    out = toxicity.severity(docs, toxicity.fit_severity(docs, fit)).join(labels, "doc_id").where("crc32(cast(doc_id AS string)) % 4 = 3").collect()
    toxic, clean = [r for r in out if r["toxic"]], [r for r in out if not r["toxic"]]
    assert sum(r["rejected"] for r in toxic) >= 0.8 * len(toxic) and sum(r["rejected"] for r in clean) <= 0.01 * len(clean)


def test_toxicity_odd_rows(spark, odd_rows):
    labels = spark.createDataFrame([(5, 1), (5, 0), (6, 1), (3, 0), (4, 0), (None, 1), (7, None), (99, 1)], "doc_id long, toxic int")
    model = toxicity.fit_severity(odd_rows, labels)
    out = toxicity.severity(odd_rows, model)
    assert out.count() == odd_rows.count() and out.where("severity IS NULL OR severity < 0 OR severity > 2").isEmpty()
    kept = toxicity.drop_toxic(odd_rows, labels)
    assert kept.columns == odd_rows.columns and kept.count() <= odd_rows.count()
    assert toxicity.drop_toxic(odd_rows, labels.limit(0)).count() == odd_rows.count()
    assert toxicity.drop_toxic(odd_rows.limit(0), labels).count() == 0


def test_toxicity_of_repeated_ids_does_not_depend_on_order(spark):
    """More rows under one id than the sample holds: the smallest text stands for it, whatever the tasks' order."""
    rows = [(1, f"good words {i}") for i in range(60)] + [(2, f"vile filth {i}") for i in range(60)] + [(i, "vile filth" if i % 2 else "good words") for i in range(3, 40)]
    labels = spark.createDataFrame([(i, 1 if i == 2 or (i > 2 and i % 2) else 0) for i in range(1, 40)], "doc_id long, toxic int")
    models = [toxicity.fit_severity(spark.createDataFrame(r, "doc_id long, text string").repartition(n), labels, sample=10) for r, n in ((rows, 1), (rows[::-1], 7))]
    assert (models[0].features == models[1].features).all() and (models[0].weights == models[1].weights).all()
    assert (models[0].thresholds == models[1].thresholds).all()


def test_severity_matches_a_plain_recomputation(spark, odd_rows):
    """Every output column, word by word from the fitted weights, over a whole table and the odd rows."""
    import math
    import zlib

    docs = documents(spark, SF).select("doc_id", "text").unionByName(odd_rows.select("doc_id", "text"))
    model = toxicity.fit_severity(docs, read_table(spark, SF, "labels"))
    weight = dict(zip(model.features.tolist(), model.weights.tolist()))
    rows = docs.collect()
    got = sorted((tuple(r) for r in toxicity.severity(docs, model).collect()), key=repr)
    want = []
    for doc_id, text in rows:
        score = 0.0
        for word in set((text or "").lower().split()):
            word = word.strip(toxicity.EDGE)
            if any(c.isalpha() for c in word):
                names = [f"w {word}"] + [f"{n} {word[:n]}" for n in (4, 5, 6) if len(word) > n]
                score += sum(weight.get(zlib.crc32(x.encode()) % 2**20, 0.0) for x in names)
        above = [1 / (1 + math.exp(t - score)) for t in model.thresholds]
        share = [1 - above[0], *(a - b for a, b in zip(above, above[1:])), above[-1]]
        severity = sum(k * p for k, p in enumerate(share))
        want.append((doc_id, severity, above[0], above[-1], share.index(max(share)), severity >= 0.5))
    assert len(got) == len(want) and any(r[5] for r in want) and not all(r[5] for r in want)
    by = defaultdict(list)
    for r in want:
        by[r[0]].append(r)
    for r in got:
        assert any(r[1:4] == pytest.approx(w[1:4], abs=1e-9) and r[4:] == w[4:] for w in by[r[0]])
