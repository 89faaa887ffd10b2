"""Hard negatives by the threshold algorithm.

Components become the integers ``floor(256 * x)``; a row's score is its
integer inner product with the anchor. Every shard of rows keeps one list
per dimension, sorted by that component. For an anchor the lists are read
from the end that its sign favours, a block of places at a time; rows that
appear for the first time are fetched and scored whole. What no list has
shown yet scores at most the *threshold*, the inner product of the anchor
with the last component read from each list. A shard is done once the
threshold is strictly below the k-th score of every window it still fills
(strictly, because a tie may have a smaller id), or below the window itself.

Two passes: an anchor's positives come from the lists of its own label, the
negatives of each positive from the whole shard, within the window that the
positive's score sets. Shards return their k best; the best of those follow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeforge.llm.common import materialize
from lakeforge.llm.vector_blocks import common_size, matrix, past_shards, whole_vectors
from lakeforge.session import read_table

#: Integer components per unit; the window: negatives score from LOW to HIGH per cent of the positive.
SCALE, LOW, HIGH = 256, 80, 100
POSITIVES, NEGATIVES = 5, 5
SHARD_ROWS = 8192
#: Places read from each list at first; doubled each time.
DEPTH = 16
EXACT = 2.0**53


class SortedLists:
    """The rows of one shard (or of one label in it), and a list per dimension of them by rising component."""

    def __init__(self, rows: np.ndarray, vectors: np.ndarray):
        self.rows, self.vectors = rows, vectors[rows]
        self.order = np.argsort(self.vectors, axis=0, kind="stable").T.astype(np.int32)
        self.values = np.take_along_axis(self.vectors.T, self.order, axis=1)

    def scores(self, some: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        x = self.vectors[some]
        if float(np.abs(anchor).max(initial=0)) * float(np.abs(x).max(initial=0)) * len(anchor) < EXACT:
            return (x.astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
        return x @ anchor

    def accesses(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
        """``(places of new rows, their scores, threshold)``; the threshold is None when nothing is left."""
        n = len(self.rows)
        unseen = np.ones(n, bool)
        up, down = np.flatnonzero(anchor < 0), np.flatnonzero(anchor > 0)
        at, depth = 0, DEPTH
        while at < n:
            to = min(n, at + depth)
            if len(up) + len(down) == 0:
                to = n  # all scores are zero: no list tells rows apart
            touched = np.zeros(n, bool)
            touched[self.order[up, at:to].ravel()] = True
            touched[self.order[down, n - to : n - at].ravel()] = True
            new = np.flatnonzero(touched & unseen if len(up) + len(down) else unseen)
            unseen[new] = False
            bound = None
            if to < n and unseen.any():
                bound = int(anchor[up] @ self.values[up, to - 1] + anchor[down] @ self.values[down, n - to])
            yield new, self.scores(new, anchor), bound
            if bound is None:
                return
            at, depth = to, 2 * depth


def best(lists: SortedLists, anchor: np.ndarray, barred: np.ndarray, windows: list[tuple[int | None, int | None]], k: int, ids: np.ndarray, keys: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window ``(low, high)`` of scores: the first ``k`` rows in it that are not barred, and their scores."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in windows]
    for new, scores, bound in lists.accesses(anchor):
        rows = lists.rows[new]
        free = ~barred[rows]
        rows, scores = rows[free], scores[free]
        done = bound is not None
        for w, (low, high) in enumerate(windows):
            fits = np.ones(len(rows), bool) if low is None else (scores >= low) & (scores <= high)
            r, s = np.concatenate([found[w][0], rows[fits]]), np.concatenate([found[w][1], scores[fits]])
            if len(r) > k:
                enough = s >= np.partition(s, len(s) - k)[len(s) - k]
                r, s = r[enough], s[enough]
            first = np.lexsort((keys[r], ids[r], -s))[:k]
            found[w] = r[first], s[first]
            if done:
                filled = len(first) == k and bound < s[first[-1]]
                done = filled or (low is not None and bound < low)
        if done:
            break
    return found


def _shard(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
    table = pa.Table.from_batches(batches)
    return (*(table.column(c).to_numpy() for c in ("key", "id", "label")), matrix(table.column("vec"), np.int64))


def _positives(shard: list[pa.RecordBatch], asked: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, ids, labels, vectors = _shard(shard)
    lists: dict[int, SortedLists] = {}
    for batch in asked:
        own, names, theirs = (batch.column(c).to_numpy() for c in ("key", "id", "label"))
        anchors, out = matrix(batch.column("vec"), np.int64), []
        for i, label in enumerate(theirs):
            if label not in lists:
                lists[label] = SortedLists(np.flatnonzero(labels == label), vectors)
            rows, scores = best(lists[label], anchors[i], keys == own[i], [(None, None)], POSITIVES, ids, keys)[0]
            out.append((np.full(len(rows), own[i]), keys[rows], ids[rows], scores))
        if out:
            yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out)], ["anchor_key", "key", "positive_id", "positive_score"])


def _negatives(shard: list[pa.RecordBatch], asked: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, ids, labels, vectors = _shard(shard)
    lists = SortedLists(np.arange(len(keys)), vectors)
    for batch in asked:
        names, theirs = batch.column("id").to_numpy(), batch.column("label").to_numpy()
        anchors, positives, own = matrix(batch.column("vec"), np.int64), batch.column("positives").to_pylist(), batch.column("key").to_numpy()
        out = []
        for i, label in enumerate(theirs):
            # a positive below zero has no window: 80 per cent of it are more than all of it
            places = [(place, p["id"], p["score"]) for place, p in enumerate(positives[i]) if p["score"] >= 0]
            windows = [(-(-LOW * s // 100), HIGH * s // 100) for *_, s in places]
            if not windows:
                continue
            for (place, name, score), (rows, scores) in zip(places, best(lists, anchors[i], labels == label, windows, NEGATIVES, ids, keys)):
                n = len(rows)
                out.append((np.full(n, own[i]), np.full(n, names[i]), np.full(n, place), np.full(n, name), keys[rows], ids[rows], np.full(n, score), scores))
        if out:
            names_ = ["anchor_key", "anchor_id", "place", "positive_id", "key", "negative_id", "positive_score", "negative_score"]
            yield pa.record_batch([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], names_)


def _first(df: DataFrame, by: list[str], score: str, id_col: str, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(score), id_col, "key"))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | None = None, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` is a condition on ``df``; ``label`` is a whole number (by
    default the column of that name). An anchor's positives are its first
    five other rows of the same label, by falling score, ties by the smaller
    id (then the earlier row, where ids repeat). Of each, the first five
    rows of other labels that score from 80 to 100 per cent of it follow,
    ranked from 1. Rows with a null id, label or vector, an empty vector, or
    a null or non-finite component take no part, nor do vectors of another
    length than most have. An anchor without positives, a positive below
    zero and a window without rows give none; an empty table gives an empty
    result; other columns are ignored. Scores must fit a long.
    """
    label = F.col("label") if label is None else label
    marked = df.withColumns({"_label": label.cast("long"), "_anchor": F.coalesce(is_anchor, F.lit(False))})
    rows = whole_vectors(marked, id_col, vec_col, "_label", "_anchor").where("_label IS NOT NULL")
    scaled = F.transform("vec", lambda x: F.floor(F.lit(float(SCALE)) * x).cast("long"))
    rows = materialize(rows.select("key", "id", F.col("_label").alias("label"), scaled.alias("vec"), F.col("_anchor").alias("anchor")), "vectors")
    rows = rows.where(F.size("vec") == common_size(rows))
    columns = ["key", "id", "label", "vec"]
    data, anchors = rows.select(columns), rows.where("anchor").select(columns)

    near = past_shards(data, anchors, shard_rows, _positives, "anchor_key long, key long, positive_id long, positive_score long")
    near = _first(near, ["anchor_key"], "positive_score", "positive_id", POSITIVES)
    # at most five to an anchor, in their order
    entry = F.struct("rank", F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))
    near = near.groupBy(F.col("anchor_key").alias("key")).agg(F.sort_array(F.collect_list(entry)).alias("positives"))
    asked = materialize(anchors.join(near, "key").select(*columns, "positives"), "anchors")

    kind = dict(asked.dtypes)["positives"]
    schema = "anchor_key long, anchor_id long, place long, positive_id long, key long, negative_id long, positive_score long, negative_score long"
    found = past_shards(data.withColumn("positives", F.lit(None).cast(kind)), asked, shard_rows, _negatives, schema)
    found = _first(found, ["anchor_key", "place"], "negative_score", "negative_id", NEGATIVES)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def query(spark, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256.0 * CAST(x AS DOUBLE)) AS DOUBLE)) AS ints
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
         CAST(list_dot_product(a.ints, c.ints) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
