"""Nearest neighbours by collision counting.

Every shard of rows keeps, per random projection, the order of its rows as
bitmaps: one per level, of the rows at or above it. A query opens a window
around its own projection in each order; two bitmaps tell which rows lie in
it, and adding up the windows' bitmaps, 64 rows a word, counts per row in how
many windows it lies. Rows that collide in at least ``threshold`` of the
orders are verified by their exact score. While the k-th verified row is
farther than the current radius, the radius grows and so do the windows
(virtual rehashing): nothing is hashed again. Radius and windows follow the
query, so there are no bucket borders to fall on; a window's ends are moved
outwards to the next level, never inwards.

Largest inner products become nearest neighbours on a sphere: vectors are
divided by the largest norm and get one more coordinate that makes their
norm 1; queries are divided by their own norm.

The windows are wide enough that a row at the current radius lies in one
with probability ``erf(WIDTH / sqrt 2)``; the threshold is the count that
such a row misses with probability ``MISS`` at most (nearer rows miss less),
for independent projections. They are taken in orthogonal sets, which makes
the counts less scattered and the loss smaller. The radii tried are a query's
distances to every k-th row of the shard: the nearest of these, which is
about the k-th nearest row, then those twice as far down, or that of the k-th
verified row if it is less. At a radius of 2, the whole sphere, everything is
verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeforge.llm.common import materialize
from lakeforge.llm.vector_blocks import common_size, matrix, past_shards, whole_vectors
from lakeforge.session import read_table

PROJECTIONS, WIDTH, MISS = 128, 1.0, 0.05
SHARD_ROWS = 8192
#: Levels per projection, at even ranks.
LEVELS = 128
#: Queries that expand their windows together.
TOGETHER = 64


def threshold(projections: int = PROJECTIONS, width: float = WIDTH, miss: float = MISS) -> int:
    """The largest count that a row at the radius falls short of with probability ``miss`` at most."""
    p, short = erf(width / sqrt(2)), 0.0
    for count in range(projections + 1):
        short += comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if short > miss:
            return count
    return projections


def directions(size: int, projections: int) -> np.ndarray:
    """Fixed random unit vectors as columns, orthogonal in sets of ``size``."""
    rng = np.random.default_rng(1)
    sets = [np.linalg.qr(rng.normal(size=(size, size)))[0] for _ in range(-(-projections // size))]
    return np.concatenate(sets, axis=1)[:, :projections]


def bitmaps(rows: np.ndarray) -> np.ndarray:
    """Rows of booleans as 64-bit words, the last word filled up with zeros."""
    packed = np.packbits(rows, axis=-1, bitorder="little")
    out = np.zeros((*rows.shape[:-1], -(-rows.shape[-1] // 64) * 8), np.uint8)
    out[..., : packed.shape[-1]] = packed
    return out.view(np.uint64)


def at_least(maps: Iterator[np.ndarray], least: int) -> np.ndarray:
    """The bits that are set in ``least`` of the bitmaps or more."""
    digits: list[list[np.ndarray]] = []  # bitmaps of equal weight: 1, 2, 4 and so on

    def add(bits: np.ndarray, weight: int) -> None:
        while True:
            if weight == len(digits):
                digits.append([])
            same = digits[weight]
            same.append(bits)
            if len(same) < 3:
                return
            a, b, c = same
            differ = a ^ b
            bits = a & b
            bits |= differ & c
            differ ^= c
            digits[weight], weight = [differ], weight + 1

    for bits in maps:
        add(bits, 0)
    weight = 0
    while weight < len(digits):
        if len(digits[weight]) == 2:
            a, b = digits[weight]
            digits[weight] = [a ^ b]
            add(a & b, weight + 1)
        weight += 1
    if least >> len(digits):
        return np.zeros_like(digits[0][0])
    enough = np.full_like(digits[0][0], ~np.uint64(0))
    for weight, (bits,) in enumerate(digits):
        enough = bits & enough if least >> weight & 1 else bits | enough
    return enough


class RankedProjections:
    """The order of a shard's rows along every projection, as bitmaps of the rows at or above each level."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, vectors: np.ndarray, largest: float, axes: np.ndarray):
        self.keys, self.ids, self.vectors, self.largest, self.axes = keys, ids, vectors, largest, axes
        unit = vectors / largest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (unit * unit).sum(1)))
        values = np.ascontiguousarray((np.concatenate([unit, rest[:, None]], axis=1) @ axes).T)
        self.unit = unit.astype(np.float32)
        n = len(keys)
        levels = min(LEVELS, n)
        # level 0 has all rows; the one after the last has none
        self.levels = np.sort(values, axis=1)[:, np.arange(levels) * n // levels]
        self.levels[:, 0] = -np.inf
        self.above = np.zeros((len(values), levels + 1, -(-n // 64)), np.uint64)
        for above, level, value in zip(self.above, self.levels, values):
            above[:-1] = bitmaps(value >= level[:, None])

    def windows(self, at: np.ndarray, half: np.ndarray) -> Iterator[np.ndarray]:
        """Per projection, the bitmaps of the queries' windows ``at - half`` to ``at + half``."""
        for j, (above, level) in enumerate(zip(self.above, self.levels)):
            low = np.maximum(np.searchsorted(level, at[:, j] - half, side="right") - 1, 0)
            bits = above[low]
            bits ^= above[np.searchsorted(level, at[:, j] + half, side="right")]
            yield bits

    def nearest(self, queries: np.ndarray, own: np.ndarray, k: int, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(query, rows, scores)``: the k best verified rows of each query, ties to the smaller id."""
        n, count = len(self.keys), len(queries)
        norms = np.sqrt((queries * queries).sum(1))
        units = queries / np.where(norms > 0, norms, 1.0)[:, None]
        at = units @ self.axes[:-1]
        units = units.astype(np.float32)
        # rows not verified yet; a query is not its own neighbour
        open_ = bitmaps(self.keys != own[:, None])
        best = [(np.zeros(0, np.int64), np.zeros(0)) for _ in range(count)]
        likeness = np.where(self.keys[::k] == own[:, None], np.float32(-1), units @ self.unit[::k].T)
        radii = np.sqrt(np.maximum(0.0, 2 - 2 * -np.sort(-likeness, axis=1).astype(float)))
        radii = np.concatenate([radii, np.full((count, 1), 2.0)], axis=1)
        radii[norms == 0] = 2.0  # squares too small for a double
        radius, place = radii[:, 0], 0
        active = np.arange(count)
        while len(active):
            half = WIDTH * radius[active] / sqrt(len(self.axes))
            found = at_least(self.windows(at[active], half), least)
            found[radius[active] >= 2] = ~np.uint64(0)
            found &= open_[active]
            open_[active] ^= found
            asker, rows = np.nonzero(np.unpackbits(found.view(np.uint8), axis=1, count=n, bitorder="little"))
            ends = np.searchsorted(asker, np.arange(len(active) + 1))
            place = min(2 * place + 1, radii.shape[1] - 1)
            still = []
            for i, a in enumerate(active):
                best[a] = self._top(*best[a], rows[ends[i] : ends[i + 1]], queries[a], units[a], norms[a], k)
                if radius[a] >= 2:
                    continue
                reach = np.inf
                if len(best[a][0]) >= k:
                    reach = sqrt(max(0.0, 2 - 2 * best[a][1][-1] / (norms[a] * self.largest)))
                if reach > radius[a]:
                    # no farther than the k-th verified row: once its windows are done, so is the query
                    radius[a] = min(max(radius[a], radii[a, place]), reach * (1 + 1e-9), 2.0)
                    still.append(a)
            active = np.array(still, np.int64)
        for a in range(count):
            yield a, *best[a]

    def _top(self, rows: np.ndarray, scores: np.ndarray, found: np.ndarray, query: np.ndarray, unit: np.ndarray, norm: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        if len(found) > k:
            # rows that are out of the k best by more than 32-bit floats can err are not scored in full
            rough = self.unit[found] @ unit
            least = np.partition(rough, len(rough) - k)[len(rough) - k]
            if len(rows) >= k:
                least = max(least, scores[-1] / (norm * self.largest))
            found = found[rough >= least - 1e-6 * (len(query) + 4)]
        # a product and a sum per row, in one order for all rows: equal vectors score equal to the last bit
        more = [(self.vectors[found[i : i + 4096]] * query).sum(1) for i in range(0, len(found), 4096)]
        rows, scores = np.concatenate([rows, found]), np.concatenate([scores, *more])
        if len(rows) > k:
            enough = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            rows, scores = rows[enough], scores[enough]
        first = np.lexsort((self.keys[rows], self.ids[rows], -scores))[:k]
        return rows[first], scores[first]


def nearest(df: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, shard_rows: int = SHARD_ROWS, projections: int = PROJECTIONS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products found for each query.

    ``is_query`` is a condition on ``df``; candidates are all rows but the
    query's own. Nearest first, ties to the smaller ``id_col`` (then to the
    earlier row, where ids repeat). Rows with a null id, and vectors that
    are null, empty, zero or hold null or non-finite components, take no
    part, nor do vectors of another length than most have. Fewer candidates
    than ``k`` are all returned; an empty table gives an empty result; other
    columns are ignored. Squares of components must be finite doubles.
    """
    rows = whole_vectors(df.withColumn("_asked", F.coalesce(is_query, F.lit(False))), id_col, vec_col, "_asked")
    rows = materialize(rows.where(F.exists("vec", lambda x: x != 0)), "vectors")
    size = common_size(rows)
    rows = rows.where(F.size("vec") == size)
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    largest = sqrt(rows.agg(F.max(square)).first()[0] or 1.0)
    least = threshold(projections)

    def search(shard: list[pa.RecordBatch], asked: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(shard)
        keys, ids = table.column("key").to_numpy(), table.column("id").to_numpy()
        index = RankedProjections(keys, ids, matrix(table.column("vec"), np.float64), largest, directions(size + 1, projections))
        for batch in asked:
            for begin in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(begin, TOGETHER)
                own, names = part.column("key").to_numpy(), part.column("id").to_numpy()
                out = [(a, *found) for a, *found in index.nearest(matrix(part.column("vec"), np.float64), own, k, least)]
                places = np.concatenate([np.full(len(r), a) for a, r, _ in out])
                hits = np.concatenate([r for _, r, _ in out])
                columns = [own[places], names[places], keys[hits], ids[hits], np.concatenate([s for *_, s in out])]
                yield pa.record_batch([pa.array(c) for c in columns], ["query_key", "query_id", "key", "vec_id", "score"])

    columns = ["key", "id", "vec"]
    found = past_shards(rows.select(columns), rows.where("_asked").select(columns), shard_rows, search, "query_key long, query_id long, key long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_key").orderBy(F.desc("score"), "vec_id", "key"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
