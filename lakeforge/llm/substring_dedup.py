"""Removal of repeated byte strings by a sparse enhanced suffix array.

Every window of ``length`` bytes picks an anchor: the place in it whose
``gram``-byte string has the smallest hash. Equal windows pick the same
place, so a repeat is found where two anchors have the same gram: they
form a bucket, and each anchor's context is the ``length - gram`` bytes
before it and the ``length`` bytes from it on, which together hold all
windows that can have picked it.

* Anchors whose whole contexts are equal need no texts: their windows all
  repeat. Only hashes are grouped for them, with partial counts.
* Of the different contexts in a bucket one each is put into a suffix
  array: sorted by the bytes from the anchor on, with the common prefix
  lengths of neighbours. A stack scan of those gives the prefix interval
  tree. In each interval the left contexts are sorted from the anchor
  backwards; where they part, the repeat is left-diverse and so maximal,
  and all members on either side of a neighbouring pair are occurrences.
* A bucket of more than ``bucket_limit`` different contexts is not
  gathered: each of its windows is hashed and counted instead, aligned at
  the anchor, which is exact for single windows and needs partial sums only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import documents, fresh_name, keyed_texts, materialize, text_slices, with_key

LENGTH = 200
#: Different contexts that one bucket's suffix array may hold (a third of a kilobyte each).
BUCKET_LIMIT = 100_000
#: Parts that a frequent gram's anchors are dealt to.
SPLIT = 64
_rng = np.random.default_rng(77)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: The base of the rolling hash and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from each place on."""
    n = len(data) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _powers(_BASE, len(data)))))
    h = (sums[gram:] - sums[:-gram]) * _powers(_INVERSE, n)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all windows' anchors, ascending, and the hashes of their grams.

    Of equal smallest hashes in a window all are anchors.
    """
    h = gram_hashes(data, gram)
    width = length - gram + 1  # places in a window
    if len(h) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    low, span = h, 1  # the smallest of span places from each on
    while span < width:
        step = min(span, width - span)
        low = np.minimum(low[: len(low) - step], low[step:])
        span += step
    high, span = low, 1  # the largest of the windows' smallest, of the windows that hold a place
    padded = np.concatenate((np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)))
    high = padded
    while span < width:
        step = min(span, width - span)
        high = np.maximum(high[: len(high) - step], high[step:])
        span += step
    at = np.flatnonzero(h == high)
    return at, h[at]


def context_hashes(data: bytes, places: np.ndarray, length: int, gram: int) -> list[int]:
    """64-bit hashes of the anchors' contexts; a context that the text's ends cut differs from all longer ones."""
    before, digest = length - gram, xxhash.xxh3_64_intdigest
    out = []
    for p in places.tolist():
        low = max(0, p - before)
        out.append(digest(data[low : p + length], seed=p - low))
    return out


def anchor_rows(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """``(anchor, part, again, rk, place, context)`` of every anchor.

    The first anchor with its gram in a slice of texts has part 0 and tells
    whether it comes ``again`` there; those that follow have parts above 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            out: list[list] = [[], [], [], []]
            for rk, text in zip(batch.column("rk").to_pylist(), batch.column("text").to_pylist()):
                data = text.encode()
                at, h = anchors(np.frombuffer(data, np.uint8), length, gram)
                values = (h.view(np.int64), np.full(len(at), rk), at, np.array(context_hashes(data, at, length, gram), np.uint64).view(np.int64))
                for to, v in zip(out, values):
                    to.append(v)
            anchor, rk, place, context = map(np.concatenate, out)
            _, first, which, count = np.unique(anchor, return_index=True, return_inverse=True, return_counts=True)
            part = 1 + (rk ^ context) % SPLIT
            part[first] = 0
            values = (anchor, part, count[which] > 1, rk, place, context)
            kinds = (np.int64, np.int32, np.bool_, np.int64, np.int32, np.int64)
            yield pa.record_batch([pa.array(v.astype(k)) for v, k in zip(values, kinds)], ["anchor", "part", "again", "rk", "place", "context"])

    return rows.select("rk", "text").mapInArrow(run, "anchor long, part int, again boolean, rk long, place int, context long")


def shared_anchors(found: DataFrame) -> DataFrame:
    """``(anchor, rk, place, context)`` of the anchors whose gram another one has too.

    Rows that come after a first one in their slice are known to be shared,
    so a frequent gram is dealt to many tasks; only the first ones meet.
    """
    dealt = found.repartition("anchor", "part").sortWithinPartitions("anchor", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, which waits for the next one
        shared = False  # whether the row before it has its gram and part

        for batch in batches:
            if not len(batch):
                continue
            joined = pa.concat_batches([held, batch]) if held is not None else batch
            anchor, part = joined.column("anchor").to_numpy(), joined.column("part").to_numpy()
            same = (anchor[1:] == anchor[:-1]) & (part[1:] == part[:-1])
            known = (part > 0) | joined.column("again").to_numpy(zero_copy_only=False)
            mask = known[:-1] | same | np.append(shared, same[:-1])[: len(same)]
            shared = bool(same[-1]) if len(same) else shared
            held = joined.slice(len(joined) - 1)
            yield joined.slice(0, len(joined) - 1).filter(pa.array(mask, pa.bool_()))
        if held is not None:
            yield held.filter(pa.array([shared or held.column("part")[0].as_py() > 0 or held.column("again")[0].as_py()]))

    return dealt.mapInArrow(run, "anchor long, part int, again boolean, rk long, place int, context long").drop("part", "again")


def fetch_contexts(rows: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """``(anchor, context, left, right)``: the bytes around the wanted anchors, ``left`` backwards.

    ``wanted`` has ``rk, places`` (structs of place, anchor, context); texts
    without a wanted anchor are not read past the join.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", 1 << 20):
            out: list[list] = [[], [], [], []]
            for text, places in zip(batch.column("text").to_pylist(), batch.column("places").to_pylist()):
                data = text.encode()
                for p in places:
                    at = p["place"]
                    left = data[max(0, at - length + gram) : at][::-1]
                    for to, v in zip(out, (p["anchor"], p["context"], left, data[at : at + length])):
                        to.append(v)
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.record_batch([pa.array(v, t) for v, t in zip(out, kinds)], ["anchor", "context", "left", "right"])

    schema = "anchor long, context long, left binary, right binary"
    return rows.join(wanted, "rk").select("text", "places").mapInArrow(run, schema)


def _matrix(values: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The values as rows of bytes, zero-filled, and their lengths."""
    sizes = np.fromiter(map(len, values), np.int64, len(values))
    flat = np.frombuffer(b"".join(v.ljust(width, b"\0") for v in values), np.uint8)
    return flat.reshape(len(values), width), sizes


def _common(matrix: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Common prefix lengths of each row and the one before it (the first: 0)."""
    differ = matrix[1:] != matrix[:-1]
    first = np.where(differ.any(1), differ.argmax(1), matrix.shape[1])
    return np.concatenate(([0], np.minimum(first, np.minimum(sizes[1:], sizes[:-1]))))


def prefix_intervals(common: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Intervals ``(depth, begin, end)`` of a sorted array whose members share ``depth``
    bytes and not all one more, from neighbours' common prefix lengths, by a stack scan."""
    stack: list[tuple[int, int]] = []  # depth and where it begins
    for i, depth in enumerate([*common.tolist()[1:], -1], start=1):
        begin = i - 1
        while stack and stack[-1][0] > depth:
            top, begin = stack.pop()
            if top >= least:
                yield top, begin, i
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, begin))


def repeats(left: list[bytes], right: list[bytes], length: int, gram: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The repeats of at least ``length`` bytes among one bucket's contexts, by prefix interval.

    Yields ``(depth, members, shared)``: contexts whose bytes from the
    anchor on agree for ``depth``, in the order of their left contexts, and
    for how many bytes backwards each agrees with the one before it.
    Neighbours that part where ``depth`` and ``shared`` reach ``length`` are
    left-diverse, so the string that they share is a maximal repeat.
    """
    order = sorted(range(len(right)), key=right.__getitem__)
    suffix, sizes = _matrix([right[i] for i in order], length)
    before, left_sizes = _matrix([left[i] for i in order], max(1, length - gram))
    # Rank of the left contexts: within an interval, sorting is by rank alone.
    rank = np.empty(len(order), np.int64)
    rank[np.array(sorted(range(len(order)), key=lambda k: left[order[k]]), np.int64)] = np.arange(len(order))
    members = np.array(order)
    for depth, begin, end in prefix_intervals(_common(suffix, sizes), gram):
        here = begin + np.argsort(rank[begin:end])
        yield depth, members[here], _common(before[here], left_sizes[here])


def maximal_groups(left: list[bytes], right: list[bytes], length: int, gram: int) -> Iterator[tuple[bytes, int, np.ndarray]]:
    """Every maximal repeat as ``(string, bytes before the anchor, its members)``; strings end with the contexts.

    Left out are strings for which the anchor is one by a window that reaches
    past them only: other occurrences need not have it. Each string has an
    anchor of its own as well, where it shows with all its occurrences.
    """
    for depth, members, shared in repeats(left, right, length, gram):
        for back, begin, end in prefix_intervals(shared, max(0, length - depth)):
            string = left[members[begin]][:back][::-1] + right[members[begin]][:depth]
            if back in anchors(np.frombuffer(string, np.uint8), length, gram)[0]:
                yield string, back, members[begin:end]


def bucket_spans(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """``(anchor, context, back, ahead)``: what repeats of ``length`` bytes or more cover around
    each context's anchor. All of them hold the anchor's gram, so together they are one span."""
    dealt = contexts.repartition("anchor").sortWithinPartitions("anchor", "context")

    def solve(bucket: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        left, right = bucket.column("left").to_pylist(), bucket.column("right").to_pylist()
        back, ahead = np.full(len(left), -1), np.zeros(len(left), np.int64)
        for depth, members, shared in repeats(left, right, length, gram):
            best = np.maximum(shared, np.append(shared[1:], 0))
            good = best + depth >= length
            who = members[good]
            back[who] = np.maximum(back[who], best[good])
            ahead[who] = np.maximum(ahead[who], depth)
        return back, ahead

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the bucket that the last batch ended in

        def table(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            whole = pa.concat_batches(parts)
            anchor = whole.column("anchor").to_numpy()
            cuts = [0, *(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1).tolist(), len(anchor)]
            back, ahead = np.full(len(anchor), -1), np.zeros(len(anchor), np.int64)
            for b, e in zip(cuts, cuts[1:]):
                if e - b > 1:
                    back[b:e], ahead[b:e] = solve(whole.slice(b, e - b))
            found = back >= 0
            columns = [whole.column(c).filter(pa.array(found)) for c in ("anchor", "context")]
            spans = [pa.array(v[found].astype(np.int32)) for v in (back, ahead)]
            return pa.record_batch([*columns, *spans], ["anchor", "context", "back", "ahead"])

        for batch in batches:
            if not len(batch):
                continue
            anchor = batch.column("anchor").to_numpy()
            cut = int(np.searchsorted(anchor, anchor[-1]))
            if cut or (held and held[-1].column("anchor")[0].as_py() != anchor[0]):
                yield table([*held, batch.slice(0, cut)])
                held = []
            held.append(batch.slice(cut))
        if held:
            yield table(held)

    return dealt.mapInArrow(run, "anchor long, context long, back int, ahead int")


def window_spans(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """As ``bucket_spans``, by counting the hashes of all windows of the contexts that hold the whole gram.

    A gram may be an anchor at several places of one window, which then lies
    in several contexts: only windows as far before the anchor are compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "right", 1 << 18):
            for anchor, context, left, right in zip(*(batch.column(c).to_pylist() for c in ("anchor", "context", "left", "right"))):
                whole = left[::-1] + right
                starts = range(min(len(left), len(whole) - length) + 1)
                yield pa.record_batch(
                    [pa.array([v] * len(starts), pa.int64()) for v in (anchor, context)]
                    + [pa.array([len(left) - s for s in starts], pa.int32())]
                    + [pa.array([xxhash.xxh3_128_digest(whole[s : s + length]) for s in starts], pa.binary())],
                    ["anchor", "context", "back", "window"],
                )

    windows = contexts.mapInArrow(run, "anchor long, context long, back int, window binary")
    windows = materialize(windows, "windows")
    aligned = ["anchor", "back", "window"]
    often = windows.groupBy(*aligned).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    found = windows.join(often, aligned, "left_semi")
    return found.select("anchor", "context", "back", (F.lit(length) - F.col("back")).alias("ahead"))


def repeated_spans(rows: DataFrame, length: int = LENGTH, gram: int | None = None, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """``(rk, begin, end)``: bytes of the keyed texts covered by repeated strings of ``length`` bytes."""
    gram = gram or max(1, length // 4)
    found = materialize(shared_anchors(anchor_rows(rows, length, gram)), "anchors")
    # Groups of equal contexts, with one row each that stands for it.
    groups = found.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rk", "place")).alias("one"))
    groups = materialize(groups, "contexts")
    buckets = groups.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"))
    groups = materialize(groups.join(buckets, "anchor"), "buckets")
    kinds = groups.where("kinds > 1").select("one.rk", F.struct("one.place", "anchor", "context").alias("p"), (F.col("kinds") > bucket_limit).alias("hot"))
    spans = groups.where("n > 1").select("anchor", "context", F.lit(length - gram).alias("back"), F.lit(length).alias("ahead"))
    for hot, solve in ((False, bucket_spans), (True, window_spans)):
        part = kinds.where(F.col("hot") == hot)
        if not part.isEmpty():
            wanted = part.groupBy("rk").agg(F.collect_list("p").alias("places"))
            spans = spans.unionByName(solve(fetch_contexts(rows, wanted, length, gram), length, gram))
    spans = spans.groupBy("anchor", "context").agg(F.max("back").alias("back"), F.max("ahead").alias("ahead"))
    covered = found.join(materialize(spans, "spans"), ["anchor", "context"])
    return covered.select("rk", F.greatest(F.lit(0), F.col("place") - F.col("back")).alias("begin"), (F.col("place") + F.col("ahead")).alias("end"))


def cut_spans(rows: DataFrame, spans: DataFrame, keep_text: bool = False) -> DataFrame:
    """``rk, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``, the remaining bytes) per keyed text."""
    by_row = spans.groupBy("rk").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            out: list[list] = [[] for _ in range(5)]
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                data, kept, at, removed, runs = text.encode(), [], 0, 0, 0
                reach = 0
                for begin, end in sorted((s["begin"], min(s["end"], len(data))) for s in spans or []):
                    if begin > reach or not runs:
                        kept.append(data[at:begin])
                        runs += 1
                        reach = begin
                    if end > reach:
                        removed += end - reach
                        reach = end
                    at = reach
                rest = b"".join([*kept, data[at:]])
                for to, v in zip(out, (len(data), removed, runs, hashlib.sha256(rest).hexdigest(), rest if keep_text else None)):
                    to.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            arrays = [batch.column("rk"), *(pa.array(v, k) for v, k in zip(out, kinds))]
            names = ["rk", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pa.record_batch(arrays[: 5 + keep_text], names[: 5 + keep_text])

    schema = "rk long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if keep_text else "")
    return rows.join(by_row, "rk", "left").select("rk", "text", "spans").mapInArrow(run, schema)


def removal(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row: what is left of its UTF-8 bytes.

    Every byte goes that a string of ``length`` bytes covers which also
    starts elsewhere, in this row or another; rows that repeat lose all such
    strings. Null counts as empty; shorter texts stay whole; an empty table
    gives an empty result; other columns are ignored.
    """
    rows = keyed_texts(df, id_col, text_col)
    out = cut_spans(rows, repeated_spans(rows, length, bucket_limit=bucket_limit))
    return rows.select("rk", "doc_id").join(out, "rk").drop("rk")


def repeat_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``(group_id, n_bytes, doc_id, begin)``: all occurrences of each maximal repeat.

    A repeat longer than an anchor's context shows as one group per anchor,
    each ending with its context. Buckets are gathered here, so this report
    is for corpora whose grams have at most ``BUCKET_LIMIT`` contexts.
    """
    rows, gram = keyed_texts(df, id_col, text_col), max(1, length // 4)
    found = materialize(shared_anchors(anchor_rows(rows, length, gram)), "anchors")
    places = found.select("rk", F.struct("place", "anchor", "context").alias("p")).groupBy("rk").agg(F.collect_list("p").alias("places"))
    contexts = fetch_contexts(rows, places, length, gram).distinct()

    def solve(key, bucket):
        left, right = bucket.column("left").to_pylist(), bucket.column("right").to_pylist()
        names = bucket.column("context").to_pylist()
        out: list[list] = [[], [], [], [], []]
        for string, back, members in maximal_groups(left, right, length, gram):
            for m in members.tolist():
                for to, v in zip(out, (key[0].as_py(), names[m], back, xxhash.xxh3_128_hexdigest(string), len(string))):
                    to.append(v)
        for m in range(len(names)):  # the whole context, where several anchors have it
            whole = left[m][::-1] + right[m]
            for to, v in zip(out, (key[0].as_py(), names[m], len(left[m]), xxhash.xxh3_128_hexdigest(whole), len(whole))):
                to.append(v)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64())
        return pa.table([pa.array(v, t) for v, t in zip(out, kinds)], ["anchor", "context", "back", "group_id", "n_bytes"])

    groups = contexts.groupBy("anchor").applyInArrow(solve, "anchor long, context long, back int, group_id string, n_bytes long")
    seen = found.join(groups, ["anchor", "context"]).select("group_id", "n_bytes", "rk", (F.col("place") - F.col("back")).alias("begin")).distinct()
    often = seen.groupBy("group_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group_id")
    return seen.join(often, "group_id", "left_semi").join(rows.select("rk", "doc_id"), "rk").drop("rk")


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated bytes removed from their texts; all columns and rows stay.

    A character that a span covers only in part stays whole. A null text
    becomes empty.
    """
    rows, key = with_key(docs, id_col)
    texts = rows.select(F.col(key).cast("long").alias("rk"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spans = materialize(repeated_spans(texts, length), "spans")
    by_row = spans.groupBy("rk").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    at, spans_name = fresh_name(rows, "rk_of_spans"), fresh_name(rows, "spans")
    both = rows.join(by_row.select(F.col("rk").alias(at), F.col("spans").alias(spans_name)), F.col(key) == F.col(at), "left").drop(at)
    place, names = both.columns.index(text_col), rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_col):
            kept = []
            for text, spans in zip(batch.column(place).to_pylist(), batch.column(spans_name).to_pylist()):
                data, parts, at = (text or "").encode(), [], 0
                for begin, end in sorted((s["begin"], min(s["end"], len(data))) for s in spans or []):
                    begin = max(begin, at)
                    while begin < end and data[begin] & 0xC0 == 0x80:
                        begin += 1
                    while end > begin and end < len(data) and data[end] & 0xC0 == 0x80:
                        end -= 1
                    if begin < end:
                        parts.append(data[at:begin])
                        at = end
                kept.append(b"".join([*parts, data[at:]]).decode())
            columns = [pa.array(kept, pa.string()) if i == place else batch.column(i) for i in range(len(names))]
            yield pa.record_batch(columns, names)

    out = both.mapInArrow(run, rows.schema)
    return out if key == id_col else out.drop(key)


def query(spark, sf_dir: str) -> DataFrame:
    return removal(documents(spark, sf_dir))
