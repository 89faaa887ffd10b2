"""Best-fit packing of token pieces by large-item matching.

A piece above a third of the capacity shares a sequence with at most one
other such piece: the large ones are matched greedily, each with the
largest that still fits. Smaller pieces then go, largest first, into the
tightest remaining gap, and open new sequences only when no gap takes them.

Pieces of one length are interchangeable, so the plan is made on the
histogram of lengths (at most ``capacity`` entries, however many documents
there are) and on groups of sequences that look alike. A plan row says:
pieces number ``first`` to ``first + n`` of this length go to sequences
``seq, seq + 1, ...``, ``per`` in each, from ``offset`` on. Every step
leaves at most three groups per length, which bounds the plan as well.
Pieces are numbered within their length by task-local counters plus prefix
sums of the tasks' counts, so no length is gathered in one task.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeforge.llm.common import documents, materialize, text_slices, vocabulary, with_key

CAPACITY = 4096
#: Fixed values of the vocabulary file: the rules that ``WordIds`` knows by heart.
KNOWN_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
PIECE_SCHEMA = "rk long, piece int, start long, length long, ids_crc32 long, task int, nth long"


class WordIds(dict):
    """Token ids of the tokenizer's words, asked from its merge model one by one."""

    #: Fixed values of the vocabulary file: how its rules split a chunk (already lower case) into words.
    WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    #: Characters whose lower case and composed form depend on nothing around them.
    SIMPLE = re.compile("[!-~\u00a1-\u012f\u0131-\u024f]+")

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model = tokenizer, tokenizer.model
        # Byte-level vocabularies write the bytes that don't print as characters from 256 on.
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = sorted(set(range(256)) - set(printed))
        self.letters = {b: chr(256 + i) for i, b in enumerate(others)}

    def __missing__(self, word: str) -> list[int]:
        name = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        self[word] = ids = [t.id for t in self.model.tokenize(name)]
        return ids

    def chunk(self, chunk: str) -> list[int]:
        """The ids of a chunk without white space, equal to the tokenizer's own."""
        if "<|" in chunk or not self.SIMPLE.fullmatch(chunk):
            return self.tokenizer.encode(chunk, add_special_tokens=False).ids
        ids: list[int] = []
        for word in self.WORD.findall(chunk.lower()):
            ids += self[word]
        return ids


class PieceEncoder:
    """Token ids of texts, remembering the ids of each white-space-free chunk.

    The tokenizer's rules drop white space and never look across it, so a
    text's ids are its chunks' ids in order. The memory is bounded: once it
    holds ``limit`` chunks, those that came only once are forgotten (or all,
    if that frees too little), and texts with chunks of more than
    ``long_chunk`` characters are encoded whole. A vocabulary file with other
    rules than ``KNOWN_RULES`` encodes every text whole.
    """

    #: Python's split() takes these as white space, the tokenizer does not.
    ODD = "\x1c\x1d\x1e\x1f"

    def __init__(self, path: str, limit: int = 500_000, long_chunk: int = 500):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        rules = json.loads(self.tokenizer.to_str())
        self.known = all(rules[k] == v for k, v in KNOWN_RULES.items())
        self.limit, self.long_chunk = limit, long_chunk
        self._reset()

    def _reset(self) -> None:
        self.index, self.words = _Index(), WordIds(self.tokenizer)
        self.flat, self.begin, self.count = np.zeros(0, np.uint32), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.used = np.zeros(0, np.int64)

    def _trim(self) -> None:
        keep = np.flatnonzero(self.used > 1)
        if 2 * len(keep) > self.limit:
            self._reset()
            return
        chunks = list(self.index)
        self.index = _Index(zip((chunks[i] for i in keep.tolist()), range(len(keep))))
        count = self.count[keep]
        ends = np.cumsum(count, dtype=np.int32)
        self.flat = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begin[keep] - ends + count, count)]
        self.begin, self.count, self.used = ends - count, count, self.used[keep] // 2
        self.words.clear()

    def _learn(self) -> None:
        new = self.index.take_new()
        ids = [self.words.chunk(c) for c in new]
        count = np.fromiter(map(len, ids), np.int32, len(ids))
        begin = len(self.flat) + np.cumsum(count, dtype=np.int32) - count
        self.flat = np.concatenate((self.flat, np.fromiter(chain.from_iterable(ids), np.uint32, int(count.sum()))))
        self.begin, self.count = np.concatenate((self.begin, begin)), np.concatenate((self.count, count))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, without special tokens added."""
        if not self.known:
            return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        if len(self.index) > self.limit:
            self._trim()
        whole: dict[int, np.ndarray] = {}
        codes = []
        for i, text in enumerate(texts):
            chunks = text.split()
            if any(c in text for c in self.ODD) or max(map(len, chunks), default=0) > self.long_chunk:
                whole[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                chunks = []
            codes.append(np.fromiter(map(self.index.__getitem__, chunks), np.int32, len(chunks)))
        self._learn()
        used = np.bincount(np.concatenate(codes), minlength=len(self.index)) if codes else self.used
        used[: len(self.used)] += self.used[: len(used)]
        self.used = used
        out = []
        for i, code in enumerate(codes):
            count = self.count[code]
            ends = np.cumsum(count, dtype=np.int32)
            at = np.arange(ends[-1] if len(ends) else 0, dtype=np.int32) + np.repeat(self.begin[code] - ends + count, count)
            out.append(whole.get(i, self.flat[at]))
        return out


class _Index(dict):
    """Numbers for chunks in order of first sight."""

    def __init__(self, known=()):
        super().__init__(known)
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self.new.append(chunk)
        self[chunk] = n = len(self)
        return n

    def take_new(self) -> list[str]:
        new, self.new = self.new, []
        return new


@cache
def encoder(tokenizer: str) -> PieceEncoder:
    """One per worker process, for all its tasks."""
    return PieceEncoder(vocabulary(tokenizer))


def cut_pieces(rows: DataFrame, key: str, text_col: str, tokenizer: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """The pieces of every text: ``PIECE_SCHEMA``, and ``ids`` if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth, task = Counter(), TaskContext.get().partitionId()
        for batch in text_slices(batches, "text"):
            out: dict[str, list] = {k: [] for k in ("rk", "piece", "start", "length", "ids_crc32", "nth", "ids")}
            keys, texts = batch.column("rk").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            for rk, ids in zip(keys, encoder(tokenizer).encode(texts)):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    row = (rk, piece, start, len(part), zlib.crc32(part.tobytes()), nth[len(part)], part if with_ids else None)
                    nth[len(part)] += 1
                    for k, v in zip(out, row):
                        out[k].append(v)
            arrays = [pa.array(out["rk"], pa.int64()), pa.array(out["piece"], pa.int32()), pa.array(out["start"], pa.int64()),
                      pa.array(out["length"], pa.int64()), pa.array(out["ids_crc32"], pa.int64()),
                      pa.array([task] * len(out["rk"]), pa.int32()), pa.array(out["nth"], pa.int64())]
            names = ["rk", "piece", "start", "length", "ids_crc32", "task", "nth"]
            if with_ids:
                arrays.append(pa.array(out["ids"], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.record_batch(arrays, names)

    schema = PIECE_SCHEMA + (", ids array<long>" if with_ids else "")
    return rows.select(F.col(key).cast("long").alias("rk"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def plan_packing(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Plan rows ``(length, first, n, seq, per, offset)`` and the number of sequences."""
    left = {n: c for n, c in histogram.items() if c}
    used: Counter = Counter()  # pieces of each length that have a place
    plan: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # room left -> groups of sequences (first, count)
    order: list[int] = []  # the rooms in use, ascending
    sequences = 0

    def place(length: int, n: int, seq: int, per: int, offset: int) -> None:
        plan.append((length, used[length], n, seq, per, offset))
        used[length] += n
        left[length] -= n

    def room(size: int, seq: int, count: int) -> None:
        if size and count:
            if size not in gaps:
                gaps[size] = []
                bisect.insort(order, size)
            gaps[size].append((seq, count))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        i = bisect.bisect_right(large, capacity - a) - 1
        if i < 0:
            count = left[a]
            place(a, count, sequences, 1, 0)
            room(capacity - a, sequences, count)
        else:
            b = large[i]
            count = left[a] // 2 if a == b else min(left[a], left[b])
            if a == b and left[a] == 1:
                if i:  # the last of its length: with the next smaller one
                    b, count = large[i - 1], 1
                    place(a, 1, sequences, 1, 0)
                    place(b, 1, sequences, 1, a)
                else:
                    b, count = 0, 1
                    place(a, 1, sequences, 1, 0)
            elif a == b:
                place(a, 2 * count, sequences, 2, 0)
            else:
                place(a, count, sequences, 1, 0)
                place(b, count, sequences, 1, a)
            room(capacity - a - b, sequences, count)
        sequences += count
        large = [n for n in large if left[n]]

    for size in sorted((n for n in left if left[n]), reverse=True):
        while left[size] and (i := bisect.bisect_left(order, size)) < len(order):
            gap = order[i]
            seq, count = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], order[i]
            per = gap // size
            full = min(count, left[size] // per)
            if full:
                place(size, full * per, seq, per, capacity - gap)
                room(gap - per * size, seq, full)
            if full < count and left[size]:
                rest = left[size]
                place(size, rest, seq + full, rest, capacity - gap)
                room(gap - rest * size, seq + full, 1)
                full += 1
            room(gap, seq + full, count - full)
        if left[size]:
            per = capacity // size
            full, rest = divmod(left[size], per)
            if full:
                place(size, full * per, sequences, per, 0)
                room(capacity - per * size, sequences, full)
            if rest:
                place(size, rest, sequences + full, rest, 0)
                room(capacity - rest * size, sequences + full, 1)
            sequences += full + bool(rest)
    return plan, sequences


def pack_documents(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = "word_bpe_49k.json",
    end_id: int = 1,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``) per piece.

    Null and empty texts are one piece that holds only ``end_id``. Repeated
    rows are packed each for itself; equal lengths are placed in the order
    of their numbers; an empty table gives an empty result. Documents longer
    than ``capacity`` are cut into full pieces and a last, shorter one. Other
    columns are ignored.
    """
    rows, key = with_key(df, id_col)
    pieces = materialize(cut_pieces(rows, key, text_col, tokenizer, end_id, capacity, with_ids), "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("length", "task", before.alias("before"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan, _ = plan_packing(histogram, capacity)
    table = np.array(sorted(plan), np.int64).reshape(-1, 6)  # by length, then by number

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            nth = batch.column("nth").to_numpy() + batch.column("before").to_numpy()
            low, high = np.searchsorted(table[:, 0], length), np.searchsorted(table[:, 0], length, "right")
            while (more := high - low > 1).any():  # the last row of this length whose first number is not above
                mid = (low + high) // 2
                up = table[np.minimum(mid, len(table) - 1), 1] <= nth
                low, high = np.where(more & up, mid, low), np.where(more & ~up, mid, high)
            _, first, _, seq, per, offset = table[low].T
            names = [c for c in batch.schema.names if c not in ("task", "nth", "before")]
            yield pa.record_batch(
                [*(batch.column(c) for c in names), pa.array(seq + (nth - first) // per), pa.array(offset + (nth - first) % per * length)],
                [*names, "sequence_id", "offset"],
            )

    numbered = pieces.join(counts, ["length", "task"])
    fields = [f for f in numbered.schema.fields if f.name not in ("task", "nth", "before")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    placed = numbered.mapInArrow(run, f"{schema}, sequence_id long, offset long")
    columns = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * with_ids]
    if key == id_col:
        return placed.select(F.col("rk").alias("doc_id"), *columns)
    ids = rows.select(F.col(key).alias("rk"), F.col(id_col).alias("doc_id"))
    return placed.join(ids, "rk").select("doc_id", *columns)


def query(spark, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
