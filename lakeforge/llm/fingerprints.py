"""Quartile bucket digests of byte strings, and their likeness.

Hashed byte triplets (each byte with two of the four after it) are counted
in 128 buckets. The digest has two hex digits for the length on a
logarithmic scale, then two bits per bucket: which quartile of the counts
its own falls in. Two digests differ by the sum of their buckets' quartile
steps and the steps of their lengths; likeness is 1 less that difference
over the largest one possible.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import documents, fresh_name, text_slices, with_key

BUCKETS = 128
#: A triplet is a byte and the ones at these two distances after it.
SHAPES = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
LENGTH_STEPS = 255
#: What a step of a bucket's quartile, and of the length's logarithm, counts.
LENGTH_WEIGHT, LENGTH_CAP = 4, 48
MAX_DIFFERENCE = 3 * BUCKETS + LENGTH_CAP

_rng = np.random.default_rng(20_24)
#: One permutation of the byte values per place in a triplet and shape.
TABLES = np.stack([[_rng.permutation(256) for _ in range(3)] for _ in SHAPES]).astype(np.uint8)


def bucket_counts(data: np.ndarray) -> np.ndarray:
    """How many triplets of the bytes fall in each bucket."""
    total = np.zeros(BUCKETS, np.int64)
    for begin in range(0, max(0, len(data) - 2), 1 << 20):  # bounded scratch for texts of any length
        part = data[begin : begin + (1 << 20) + 4]
        for (i, j), (a, b, c) in zip(SHAPES, TABLES):
            n = min(len(part) - j, 1 << 20)
            if n > 0:
                total += np.bincount((a[part[:n]] ^ b[part[i : i + n]] ^ c[part[j : j + n]]) & (BUCKETS - 1), minlength=BUCKETS)
    return total


def digest(data: bytes) -> str:
    """The digest of a byte string, as 66 hex digits."""
    counts = bucket_counts(np.frombuffer(data, np.uint8))
    cuts = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    quartile = (counts[:, None] > cuts).sum(1).astype(np.uint8)
    packed = (quartile.reshape(-1, 4) << np.array([6, 4, 2, 0], np.uint8)).sum(1).astype(np.uint8)
    length = min(LENGTH_STEPS, round(8 * np.log2(len(data) + 1)))
    return f"{length:02x}{packed.tobytes().hex()}"


def _unpack(digests: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex("".join(digests)), np.uint8).reshape(len(digests), 1 + BUCKETS // 4)
    quartiles = (raw[:, 1:, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3
    return raw[:, 0].astype(np.int64), quartiles.reshape(len(digests), BUCKETS).astype(np.int64)


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """Of each pair of digests, between 0 and 1; 1 for equal ones."""
    if not left:
        return np.zeros(0)
    (la, qa), (lb, qb) = _unpack(left), _unpack(right)
    length = np.minimum(LENGTH_CAP, LENGTH_WEIGHT * np.abs(la - lb))
    return 1 - (np.abs(qa - qb).sum(1) + length) / MAX_DIFFERENCE


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` per row. Null counts as empty; equal texts have equal
    fingerprints; repeated rows repeat theirs; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            prints = [digest((t or "").encode()) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(df.dtypes)[id_col]}, fingerprint string")


def with_next(rows: DataFrame, key: str, blocks: int) -> tuple[DataFrame, int]:
    """``rows`` dealt to ``block``s of neighbouring keys, with one more row at each block's end.

    Blocks go down in ``key``. A block's ``halo`` row is the first one of the
    next block (of the last block: the first of all), so that every row but
    a halo finds the row after it in its own block: texts move once, and
    only one text per block moves twice. ``key`` is present and unique.
    """
    span = rows.agg(F.min(key), F.max(key)).first()
    if span[0] is None:
        return rows.withColumn("block", F.lit(0)).withColumn("halo", F.lit(False)), 1
    cuts = sorted({int(c) for c in rows.approxQuantile(key, [i / blocks for i in range(1, blocks)], 0.25 / blocks)} if blocks > 1 else ())
    block = F.lit(len(cuts))
    if cuts:
        # the number of cuts below the key, counted from the top: larger keys come first
        block = F.lit(len(cuts)) - F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col(key)))
    dealt = rows.withColumn("block", block)
    first = dealt.groupBy("block").agg(F.max(key).alias(key))  # a row per block at most
    tops = sorted(((r["block"], r[key]) for r in first.collect()))
    before = {top: tops[i - 1][0] for i, (_, top) in enumerate(tops)}  # block that ends before this row
    ends = rows.sparkSession.createDataFrame([(k, b) for k, b in before.items()], f"{key} long, ends int")
    both = dealt.join(F.broadcast(ends), key, "left")
    places = F.array(F.struct("block", F.lit(False).alias("halo")), F.struct(F.col("ends").alias("block"), F.lit(True).alias("halo")))
    places = F.when(F.col("ends").isNull(), F.slice(places, 1, 1)).otherwise(places)
    return both.select(*rows.columns, F.explode(places).alias("place")).select(*rows.columns, "place.block", "place.halo"), len(tops)


def fingerprint_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None) -> DataFrame:
    """Fingerprints of every text and of an edit of it, and how alike they are.

    The edit replaces the last half of the code points (rounded down) by as
    many of the first ones of the next document, or all of it if it is
    shorter; next is by falling ``doc_id``, and after the last comes the
    first. Null counts as empty. Rows that share an id follow each other by
    their place in the input, null ids come last; a single row is its own
    next. An empty table gives an empty result; other columns are ignored.
    """
    spark = df.sparkSession
    rows, key = with_key(df, id_col)
    blocks = blocks or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if key != id_col:
        # (id, row number) as one rising key: ranks of the pairs, found without the texts
        rows, key = _ranked(rows, id_col, key)
    texts = rows.select(F.col(key).cast("long").alias("key"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dealt, n = with_next(texts, "key", blocks)
    # A halo row sorts behind its block's own rows.
    dealt = dealt.repartition(n, "block").sortWithinPartitions("block", "halo", F.desc("key"))
    id_type = dict(df.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row whose next one is still to come
        for batch in text_slices(batches, "text"):
            out: list[list] = [[] for _ in range(7)]
            own, edit, after = [], [], []
            for row in batch.select(["block", "halo", "doc_id", "text"]).to_pylist():
                print_ = digest(row["text"].encode())
                if held and held[0] == row["block"]:
                    _, doc_id, text, mine = held
                    half = len(text) // 2
                    edited = (text[: len(text) - half] + row["text"][:half]).encode()
                    theirs = digest(edited)
                    for to, v in zip(out, (doc_id, len(text), hashlib.sha256(edited).hexdigest(), mine, theirs)):
                        to.append(v)
                    own.append(mine), edit.append(theirs), after.append(print_)
                held = None if row["halo"] else (row["block"], row["doc_id"], row["text"], print_)
            out[5], out[6] = likeness(own, edit), likeness(own, after)
            kinds = (batch.schema.field("doc_id").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            yield pa.record_batch([pa.array(v, t) for v, t in zip(out, kinds)], names)

    schema = f"doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.select("block", "halo", "doc_id", "text").mapInArrow(run, schema)


def _ranked(rows: DataFrame, id_col: str, key: str) -> tuple[DataFrame, str]:
    """``rows`` with a unique key that rises with the id; of one id, the earlier row's is larger."""
    rank = fresh_name(rows, "rank")
    order = rows.select(F.col(id_col).alias("id"), F.col(key).alias("key"))
    order = order.repartitionByRange(F.col("id").asc_nulls_first(), F.desc("key")).sortWithinPartitions(F.col("id").asc_nulls_first(), F.desc("key"))
    order = order.select("key", F.monotonically_increasing_id().alias(rank))
    return rows.join(order.withColumnRenamed("key", key), key), rank


def query(spark, sf_dir: str) -> DataFrame:
    return fingerprint_edits(documents(spark, sf_dir))
