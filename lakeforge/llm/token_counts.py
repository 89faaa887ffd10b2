"""Token counts by overlap resynchronisation.

A text of up to ``chunk`` characters is encoded whole. A longer one is cut
into chunks of that many characters, each overlapping the next, and the
chunks are dealt out like documents. Two neighbours are spliced in their
overlap at a boundary p of both encodings where the same piece follows p.
That splice is exact for byte-pair encoding: a sequence of pieces is the
encoding of its text if and only if every two adjacent pieces encode, by
themselves, to just those two. Adjacent pieces of one chunk's encoding do;
the pair around p occurs in the left chunk, all later ones in the right.
The following piece must not be a byte of an unknown character, so that p
lies between characters.

Where two neighbours share no such boundary, the document is done anew
with chunks and overlaps four times as long, in the end as one chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import documents, keyed_texts, materialize, text_slices
from lakeforge.llm.piece_model import BYTE, load

MODEL = "piece_bpe_32k.model"
LIMIT = 4096

CHUNK_SCHEMA = "rk long, chunk int, last boolean, at long, until long, before long, text string"
CODE_SCHEMA = (
    "rk long, chunk int, last boolean, n long, head_at array<long>, head_id array<int>, "
    "tail_at array<long>, tail_id array<int>, tail_first long"
)


def count_whole(rows: DataFrame, model: str) -> DataFrame:
    """``(rk, n)``: the library's number of tokens of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = load(model).library
        for batch in text_slices(batches, "text"):
            ids = library.encode(batch.column("text").to_pylist(), num_threads=1)
            yield pa.record_batch([batch.column("rk"), pa.array([len(i) for i in ids], pa.int64())], ["rk", "n"])

    return rows.select("rk", "text").mapInArrow(run, "rk long, n long")


def cut_chunks(rows: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Chunks with their first byte, the first byte of the next chunk and the end of the previous one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("rk", pa.int64()), ("chunk", pa.int32()), ("last", pa.bool_()), ("at", pa.int64()),
                            ("until", pa.int64()), ("before", pa.int64()), ("text", pa.string())])
        step = chunk - overlap
        for batch in text_slices(batches, "text", 1):
            for rk, text in zip(batch.column("rk").to_pylist(), batch.column("text").to_pylist()):
                starts = range(0, max(1, len(text) - overlap), step)
                at = before = 0
                for i, start in enumerate(starts):
                    until = at + len(text[start : start + step].encode())
                    row = (rk, i, i == len(starts) - 1, at, until, before, text[start : start + chunk])
                    yield pa.record_batch([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)
                    before = at + len(text[start : start + chunk].encode())
                    at = until

    return rows.select("rk", "text").mapInArrow(run, CHUNK_SCHEMA)


def encode_chunks(chunks: DataFrame, model: str) -> DataFrame:
    """Per chunk the number of pieces, and those in the overlaps with their places in the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(model)
        for batch in text_slices(batches, "text"):
            out: list[list] = [[] for _ in range(6)]
            texts = batch.column("text").to_pylist()
            places = zip(*(batch.column(c).to_pylist() for c in ("at", "until", "before")))
            for text, ids, (at, until, before) in zip(texts, m.library.encode(texts, num_threads=1), places):
                begins, code = m.spans(text, ids)[0] + at, np.array(ids, np.int32)
                head, tail = np.searchsorted(begins, before), np.searchsorted(begins, until)
                for to, value in zip(out, (len(ids), begins[:head], code[:head], begins[tail:], code[tail:], int(tail))):
                    to.append(value)
            places, codes = pa.list_(pa.int64()), pa.list_(pa.int32())
            yield pa.record_batch(
                [*(batch.column(c) for c in ("rk", "chunk", "last")), *map(pa.array, out, (pa.int64(), places, codes, places, codes, pa.int64()))],
                ["rk", "chunk", "last", "n", "head_at", "head_id", "tail_at", "tail_id", "tail_first"],
            )

    return chunks.mapInArrow(run, CODE_SCHEMA)


def splice(codes: DataFrame, model: str) -> DataFrame:
    """``(rk, n)`` per pair of neighbours: what the left counts before their common boundary
    less what the right does; null where they have none."""
    left = codes.where("NOT last").select("rk", (F.col("chunk") + 1).alias("chunk"), "tail_at", "tail_id", "tail_first")
    pairs = left.join(codes.select("rk", "chunk", "head_at", "head_id"), ["rk", "chunk"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = load(model).kind
        for batch in batches:
            n = []
            for row in batch.select(["tail_at", "tail_id", "tail_first", "head_at", "head_id"]).to_pylist():
                _, i, j = np.intersect1d(row["tail_at"], row["head_at"], return_indices=True)
                a, b = np.array(row["tail_id"], np.int64)[i], np.array(row["head_id"], np.int64)[j]
                # The right chunk's first piece holds the space that the library puts before a text.
                good = np.flatnonzero((a == b) & (kind[a] != BYTE) & (j > 0))
                n.append(row["tail_first"] + int(i[good[0]]) - int(j[good[0]]) if len(good) else None)
            yield pa.record_batch([batch.column("rk"), pa.array(n, pa.int64())], ["rk", "n"])

    return pairs.mapInArrow(run, "rk long, n long")


def token_counts(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    model: str = MODEL,
    limit: int = LIMIT,
    chunk: int = 32768,
    overlap: int = 512,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row, of whole texts.

    Null and empty texts have no token. Repeated rows (also with one
    identifier) are counted each for itself; an empty table gives an empty
    result; other columns are ignored. ``model`` must be a byte-pair
    encoding of the sentencepiece library.
    """
    if not load(model).is_bpe or chunk < 2 * overlap:
        raise ValueError("needs a byte-pair model, and chunks of at least two overlaps")
    rows = keyed_texts(df, id_col, text_col)
    long = F.char_length("text") > chunk
    counted = count_whole(rows.where(~long), model)
    pending = rows.where(long)
    while True:
        parts = cut_chunks(pending, chunk, overlap).repartition("rk", "chunk")
        codes = materialize(encode_chunks(parts, model), "chunk_codes")
        joints = materialize(splice(codes, model), "splices")
        failed = joints.where("n IS NULL").select("rk").distinct()
        done = codes.where("last").select("rk", "n").unionByName(joints)
        counted = counted.unionByName(done.join(failed, "rk", "left_anti"))
        if failed.isEmpty():
            break
        pending = pending.join(failed, "rk", "left_semi")
        chunk, overlap = 4 * chunk, 4 * overlap
    totals = counted.groupBy("rk").agg(F.sum("n").alias("n_tokens"))
    sizes = rows.select("rk", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"))
    return sizes.join(totals, "rk").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def query(spark, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))
