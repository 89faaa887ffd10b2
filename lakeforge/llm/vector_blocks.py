"""A stated set of query vectors against all rows, in blocks.

Rows are dealt to shards of a fixed size and queries to blocks; a task gets
one shard, then streams the queries of one block past it. Shards and blocks
are dealt by hash of a row key, so equal vectors, or one label that holds
most rows, fill no task. Queries come in at least as many blocks as keep all
cores busy while there are few shards; results do not depend on blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import with_key

#: A block of queries takes at most about so many rows past a shard.
BLOCK_QUERIES = 65_536


def whole_vectors(df: DataFrame, id_col: str, vec_col: str, *more: str) -> DataFrame:
    """``(key, id, vec, more...)`` of the rows whose identifier is present and whose vector is
    present, not empty and finite throughout; ``key`` is unique."""
    rows, key = with_key(df, id_col)
    vec = F.col(vec_col).cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & finite)
    return rows.select(F.col(key).cast("long").alias("key"), F.col(id_col).cast("long").alias("id"), vec.alias("vec"), *more)


def common_size(rows: DataFrame) -> int:
    """The length that most vectors have (the larger one of several), 0 if there are none."""
    sizes = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return sizes[0]["d"] if sizes else 0


def past_shards(rows: DataFrame, queries: DataFrame, shard_rows: int, search: Callable, schema: str) -> DataFrame:
    """Every query past every shard of ``rows``: what ``search(shard, queries)`` yields.

    ``rows`` and ``queries`` have the same columns, ``key`` among them.
    ``search`` is called with a shard's record batches and an iterator of
    query batches; it yields record batches of ``schema``.
    """
    n, m = rows.count(), queries.count()
    shards = max(1, -(-n // shard_rows))
    cores = rows.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-2 * cores // shards), -(-m // BLOCK_QUERIES))

    def dealt(df: DataFrame, own: Column, others: int, cell: Callable[[Column], Column], query: bool) -> DataFrame:
        spread = df.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
        return spread.select(cell(F.col("_other")).cast("int").alias("_cell"), F.lit(query).alias("_query"), *df.columns)

    place = F.xxhash64("key")
    data = dealt(rows, F.pmod(place, F.lit(shards)), blocks, lambda block: F.col("_own") * blocks + block, False)
    asked = dealt(queries, F.pmod(place, F.lit(blocks)), shards, lambda shard: shard * blocks + F.col("_own"), True)
    cells = data.unionByName(asked).repartitionById(shards * blocks, F.col("_cell"))
    cells = cells.sortWithinPartitions("_cell", "_query", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _stream(batches, search)

    return cells.mapInArrow(run, schema)


def _stream(batches: Iterator[pa.RecordBatch], search: Callable) -> Iterator[pa.RecordBatch]:
    """Per cell: its shard's rows are gathered, its queries stay a stream."""

    def runs() -> Iterator[tuple[tuple[int, bool], pa.RecordBatch]]:
        for batch in batches:
            cell, query = batch.column("_cell").to_numpy(), batch.column("_query").to_numpy(zero_copy_only=False)
            ends = np.flatnonzero((cell[1:] != cell[:-1]) | (query[1:] != query[:-1])) + 1
            for a, b in zip([0, *ends], [*ends, len(cell)]):
                if a < b:
                    yield (int(cell[a]), bool(query[a])), batch.slice(a, b - a)

    pieces = runs()
    held = next(pieces, None)
    while held is not None:
        (cell, _), shard = held[0], []
        while held is not None and held[0] == (cell, False):
            shard.append(held[1])
            held = next(pieces, None)

        def asked() -> Iterator[pa.RecordBatch]:
            nonlocal held
            while held is not None and held[0] == (cell, True):
                piece = held[1]
                yield piece
                held = next(pieces, None)

        if shard:
            yield from search(shard, asked())
        for _ in asked():  # queries that a search has left, or that met an empty shard
            pass


def matrix(column: pa.Array | pa.ChunkedArray, dtype) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), -1)
