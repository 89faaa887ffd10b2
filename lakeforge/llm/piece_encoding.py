"""SentencePiece encoding with offsets, and decoding.

Every text is encoded whole. Each piece comes with the span of original
bytes that it stands for: the normaliser's longest-prefix replacements
record where every normalised byte came from (``piece_model``), and pieces
are laid over the normalised bytes in order.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import documents, text_slices
from lakeforge.llm.piece_model import load

MODEL = "piece_bpe_32k.model"


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def _id_type(df: DataFrame, id_col: str) -> str:
    return dict(df.dtypes)[id_col]


def encode_pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, add_end: bool = True) -> DataFrame:
    """``doc_id, ids, begins, ends`` per row: piece ids and their original byte spans.

    With ``add_end`` an end id follows, its span empty at the text's end.
    Null and empty texts have no other piece. Rows are independent, so
    repeated rows repeat their result; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(model)
        tail = [m.end_id] if add_end else []
        for batch in text_slices(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids, begins, ends = [], [], []
            for text, code in zip(texts, m.library.encode(texts, num_threads=1)):
                b, e = m.spans(text, code)
                last = [int(e[-1]) if len(e) else 0] * len(tail)
                ids.append(code + tail)
                begins.append(np.append(b, last).astype(np.int32))
                ends.append(np.append(e, last).astype(np.int32))
            lists = pa.list_(pa.int32())
            yield pa.record_batch([batch.column("doc_id"), pa.array(ids, lists), pa.array(begins, lists), pa.array(ends, lists)],
                                  ["doc_id", "ids", "begins", "ends"])

    schema = f"doc_id {_id_type(df, id_col)}, ids array<int>, begins array<int>, ends array<int>"
    return _texts(df, id_col, text_col).mapInArrow(run, schema)


def decode_pieces(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """``doc_id, text`` per row: the library's decoding of ``ids_col`` (null: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(model)
        for batch in batches:
            ids = [i or [] for i in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array([m.library.decode(i) for i in ids], pa.string())], ["doc_id", "text"])

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"doc_id {_id_type(df, id_col)}, text string")


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """Encode with an end id and decode again; one row of digests per row of ``df``.

    ``n_tokens`` counts all ids; ``ids_sha256`` is over the decimal ids joined
    by a space, ``decoded_sha256`` over the decoded text, ``spans_crc32`` over
    the little-endian 32-bit begins and ends of the pieces, and
    ``covered_bytes`` is the length of all spans together. The arrays never
    leave the task. Null and empty rows as in ``encode_pieces``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(model)
        digits = [str(i) for i in range(m.library.get_piece_size())]
        for batch in text_slices(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            codes = m.library.encode(texts, num_threads=1)
            spans = [m.spans(t, c) for t, c in zip(texts, codes)]
            for c in codes:
                c.append(m.end_id)
            decoded = m.library.decode(codes, num_threads=1)
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array([len(c) for c in codes], pa.int64()),
                    pa.array([hashlib.sha256(" ".join(map(digits.__getitem__, c)).encode()).hexdigest() for c in codes]),
                    pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded]),
                    pa.array([zlib.crc32(np.concatenate(s).astype("<u4").tobytes()) for s in spans], pa.int64()),
                    pa.array([int((e - b).sum()) for b, e in spans], pa.int64()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32", "covered_bytes"],
            )

    schema = f"doc_id {_id_type(df, id_col)}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long, covered_bytes long"
    return _texts(df, id_col, text_col).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir))
