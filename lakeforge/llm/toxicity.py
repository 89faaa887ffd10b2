"""Severity of toxic language by cumulative-link ordinal regression.

P(grade > k) = sigmoid(w x - theta_k): one weight vector for all grades,
one rising threshold per step between grades. x counts the distinct words
of the text (lower case, edge punctuation stripped) under hashed features:
the word, and its first 4, 5 and 6 letters. As x adds up over distinct
words, a text's score is the sum of its words' scores, which workers
remember per word.

Fitting takes a bounded sample of labelled rows (``SAMPLE`` of each class,
texts of at most ``SAMPLE_CHARS``); scoring takes every row's whole text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import documents, text_slices, with_key
from lakeforge.session import read_table

BITS = 20
#: Bounds of the sample that the model is fitted to.
SAMPLE, SAMPLE_CHARS = 4000, 20_000
PREFIXES = (4, 5, 6)
EDGE = ".,;:!?*%$&#|()[]{}<>\"'`-_=+/\\~^@«»„“”‘’¡¿…"
#: Expected severity from which a document is rejected.
REJECT = 0.5


def word_features(word: str) -> list[int]:
    """Hashed features of a lower-cased word; none if it has no letter."""
    word = word.strip(EDGE)
    if not any(c.isalpha() for c in word):
        return []
    names = [f"w {word}", *(f"{n} {word[:n]}" for n in PREFIXES if len(word) > n)]
    return [zlib.crc32(n.encode()) & ((1 << BITS) - 1) for n in names]


@dataclass
class OrdinalModel:
    """Sparse weights (feature ids and values) and rising thresholds."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) per row and k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -60, 60)))


class WordScores(dict):
    """The score of each word seen so far."""

    def __init__(self, model: OrdinalModel):
        super().__init__()
        self.weight = dict(zip(model.features.tolist(), model.weights.tolist()))

    def __missing__(self, word: str) -> float:
        self[word] = s = sum(self.weight.get(f, 0.0) for f in word_features(word))
        return s


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, grades: np.ndarray, steps: int = 120, l1: float = 0.5, l2: float = 0.01) -> OrdinalModel:
    """Penalised maximum likelihood by accelerated proximal gradient steps.

    ``rows``/``cols`` list the features (a pair may repeat), ``grades`` has
    0 to K. With fewer than two grades present, all weights are zero and
    every row is left in grade 0.
    """
    top = int(grades.max()) if len(grades) else 0
    if top == 0 or not (grades == 0).any():
        return OrdinalModel(np.zeros(0, np.int64), np.zeros(0), np.full(max(top, 1), 30.0))
    used, col, seen = np.unique(cols, return_inverse=True, return_counts=True)
    common = seen >= 3  # rarer features cannot outweigh the penalty
    keep = common[col]
    used, col, row = used[common], (np.cumsum(common) - 1)[col[keep]], rows[keep]
    n, k = len(grades), np.arange(top)
    share = np.array([(grades > i).mean() for i in k])
    theta = np.sort(-np.log(np.maximum(share, 1e-6) / np.maximum(1 - share, 1e-6)))
    w = np.zeros(len(used))
    # Step sizes per feature and one for the thresholds, from the curvature's bound.
    size = np.bincount(row, minlength=n).max(initial=1)
    count = np.bincount(col, minlength=len(used))
    rate = 1 / (0.25 * (l2 + count * min(size, 400.0) / 8 + 1))
    v, phi, t = w, theta, 1.0
    for _ in range(steps):
        f = np.bincount(row, v[col], minlength=n)
        p = 1 / (1 + np.exp(np.clip(phi[None, :] - f[:, None], -40, 40)))  # P(grade > k)
        upper = np.hstack([np.ones((n, 1)), p])[np.arange(n), grades]
        lower = np.hstack([p, np.zeros((n, 1))])[np.arange(n), grades]
        mass = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper) / mass, lower * (1 - lower) / mass
        slope = dl - du  # of the negative log likelihood in the score
        g = np.bincount(col, slope[row], minlength=len(used)) + l2 * v
        g_theta = np.array([du[grades == i + 1].sum() - dl[grades == i].sum() for i in k])
        new = v - rate * g
        new = np.sign(new) * np.maximum(np.abs(new) - rate * l1, 0)
        new_theta = np.maximum.accumulate(phi - g_theta * 2 / n)
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v, phi = new + (last - 1) / t * (new - w), new_theta + (last - 1) / t * (new_theta - theta)
        w, theta = new, new_theta
    live = w != 0
    return OrdinalModel(used[live], w[live], theta)


def grade_sample(rows: np.ndarray, cols: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Grades 0, 1, 2 of labelled rows: not toxic, toxic, and heavily so.

    The labels only tell toxic from not. A toxic row is heavy if it holds
    more marked features than half of the toxic rows do; a feature is marked
    if rows with it are toxic at least 20 times as often as not (over the
    classes' sizes, one row added to either).
    """
    _, col = np.unique(cols, return_inverse=True)
    size = col.max(initial=-1) + 1
    bad = np.bincount(col, toxic[rows] > 0, minlength=size) if size else np.zeros(0)
    good = np.bincount(col, toxic[rows] == 0, minlength=size) if size else np.zeros(0)
    odds = ((bad + 1) / ((toxic > 0).sum() + 1)) / ((good + 1) / ((toxic == 0).sum() + 1))
    marks = np.bincount(rows, (odds >= 20)[col], minlength=len(toxic)) if size else np.zeros(len(toxic))
    middle = np.median(marks[toxic > 0]) if (toxic > 0).any() else 0
    return np.where(toxic > 0, 1 + (marks > middle), 0).astype(np.int64)


def fit_severity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> OrdinalModel:
    """The model fitted to at most ``sample`` toxic and as many other labelled rows.

    The sample takes the smallest hashes of the ids. A row with several
    labels counts as toxic if any says so; null labels and ids don't count.
    Of several texts under one id the smallest is taken.
    """
    marks = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic"))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    short = texts.where(F.char_length("text") <= SAMPLE_CHARS)
    known = short.select("id").join(marks, "id").withColumn("place", F.xxhash64("id"))
    picked = [known.where(F.col("toxic") > 0).orderBy("place", "id").limit(sample), known.where(F.col("toxic") <= 0).orderBy("place", "id").limit(sample)]
    chosen = picked[0].unionByName(picked[1]).distinct()  # at most 2 * sample rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[f for w in set(t.lower().split()) for f in word_features(w)] for t in batch.column("text").to_pylist()]
            found = pa.array([np.array(sorted(f), np.int32) for f in found], pa.list_(pa.int32()))
            yield pa.record_batch([batch.column("place"), batch.column("toxic"), found], ["place", "toxic", "found"])

    sampled = short.join(F.broadcast(chosen), "id").groupBy("id", "place", F.col("toxic").cast("int").alias("toxic")).agg(F.min("text").alias("text"))
    table = sampled.drop("id").mapInArrow(run, "place long, toxic int, found array<int>").toArrow()  # a row per chosen id
    table = table.sort_by("place").combine_chunks()  # the sums below don't depend on the tasks' order
    if not len(table):
        return fit_ordinal(*np.zeros((3, 0), np.int64))
    found = table.column("found").combine_chunks()
    cols = found.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(table)), np.diff(found.offsets.to_numpy()))
    toxic = table.column("toxic").to_numpy()
    return fit_ordinal(rows, cols, grade_sample(rows, cols, toxic))


def severity(df: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """``doc_id, severity, p_toxic, p_severe, grade, rejected`` per row of ``df``.

    ``severity`` is the expected grade, ``grade`` the likeliest one. Null and
    empty texts score as a text without words. Repeated rows get the same
    score; an empty table gives an empty result; other columns are ignored.
    """
    id_type = dict(df.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = WordScores(model)
        for batch in text_slices(batches, "text"):
            if len(scores) > 400_000:
                scores.clear()
            total = np.array([sum(map(scores.__getitem__, sorted(set((t or "").lower().split())))) for t in batch.column("text").to_pylist()], float)
            above = model.above(total)
            expected = above.sum(1)
            share = np.hstack([np.ones((len(total), 1)), above]) - np.hstack([above, np.zeros((len(total), 1))])
            columns = [batch.column("doc_id"), pa.array(expected), pa.array(above[:, 0]), pa.array(above[:, -1]),
                       pa.array(share.argmax(1), pa.int32()), pa.array(expected >= reject)]
            yield pa.record_batch(columns, ["doc_id", "severity", "p_toxic", "p_severe", "grade", "rejected"])

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type}, severity double, p_toxic double, p_severe double, grade int, rejected boolean")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose expected severity is ``REJECT`` or more; all columns stay."""
    model = fit_severity(docs, labels, id_col, text_col)
    rows, key = with_key(docs, id_col)
    scored = severity(rows, model, key, text_col)
    kept = rows.join(scored.where("rejected").select(F.col("doc_id").alias(key)), key, "left_anti")
    return kept if key == id_col else kept.drop(key)


def query(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return severity(docs, fit_severity(docs, read_table(spark, sf_dir, "labels")))
