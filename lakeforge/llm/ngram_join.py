"""N-gram Jaccard join by rare-first prefix filtering.

A document's set holds the 64-bit hashes of its distinct 5-word shingles.
Documents with equal sets are one class, and only one of each class joins.
All sets are ordered alike: shingles on a bounded list of frequent ones
last, by their counts, all others first, by hash (any common order gives
the same result; this one keeps frequent shingles out of the prefixes).
Two sets of enough likeness share a shingle among their first
``n - ceil(3n/4) + 1``.

Documents that share a prefix shingle form a bucket. Of a bucket of up to
``SMALL`` rows all pairs that pass the length and positional filters are
candidates. Larger ones are worked off in rounds: some members of each, of
any component but the bucket's largest, are its pivots and are paired with
all members of *other components* that pass the length, positional, parity
and suffix filters; each new pair is verified once, links merge components,
pivots leave. A bucket whose members are all of one component is closed. Pivots
grow by a rising factor every round, so rounds grow slower than the logarithm
of the largest bucket, while a bucket of near copies closes after one or two: no
link between components is missed and no group is expanded into all its
pairs.

The parity filter is part of that pairing's join condition: every set has a
bitmap in which each shingle flips one bit. Common shingles cancel out, so
two bitmaps differ in no more bits than the sets do in shingles, and of a
link that is a seventh of both sizes at most. Texts that share passages but
are no copies, or fall short of the bound, hardly ever become a row. Nor does
a pair become one in every bucket that it shares: it meets in that of its
first common shingle, the only one whose positional filter is its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import bucketed, documents, keyed_texts, materialize, text_slices, with_key
from lakeforge.llm.components import connected

WIDTH = 5
#: Entries of the list of frequent shingles that every task gets.
FREQUENT = 1 << 20
#: Parts that a frequent shingle's bucket is dealt to.
SPLIT = 64
#: Rows of the largest bucket whose pairs are listed at once.
SMALL = 16
#: How many times more pivots a bucket gets in the second round; each later round's factor is as many times larger.
GROWTH = 8
#: Least and most ranges of hashes whose counts bound an overlap; a set has one for about four of its shingles.
RANGES = (64, 4096)
#: 64-bit words of a parity bitmap.
PARITY = 16
_MULTIPLIERS = np.random.default_rng(5).integers(1, 1 << 63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound (``trim``)."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def trim(self, limit: int = 500_000) -> None:
        if len(self) > limit:
            self.clear()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def shingles(text: str, words: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles.

    ASCII white space splits words and A-Z are lower-cased. A text of fewer
    words is one shingle; without a word the set is empty.
    """
    tokens = text.encode().lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    if len(h) < width:
        return _mix((h * _MULTIPLIERS[: len(h)]).sum(keepdims=True) + np.uint64(len(h)))
    n = len(h) - width + 1
    total = np.full(n, width, np.uint64)
    for j in range(width):
        total += h[j : j + n] * _MULTIPLIERS[j]
    return np.unique(_mix(total))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def range_counts(tokens: np.ndarray) -> np.ndarray:
    """How many of the sorted hashes lie in each of a power of two of equal ranges, up to 255."""
    bits = int(np.clip(len(tokens) // 4, *RANGES)).bit_length() - 1
    where = (tokens >> np.uint64(64 - bits)).astype(np.int64)
    return np.minimum(np.bincount(where, minlength=1 << bits), 255).astype(np.uint8)


def parity(tokens: np.ndarray) -> np.ndarray:
    """A bitmap, as ``PARITY`` 64-bit words, in which every hash flips one bit."""
    bits = np.bincount(((tokens >> np.uint64(16)) % np.uint64(64 * PARITY)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def common_bound(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """The most shingles that each pair of sets can share, by their range counts: those in
    different ranges cannot meet, so the smaller count of each range bounds the overlap.
    Unbounded where a count is full. Of unlike numbers of ranges the larger is folded."""
    sizes = np.array([[len(x), len(y)] for x, y in zip(left, right)]).reshape(-1, 2)
    out = np.zeros(len(sizes), np.int64)
    for m, n in np.unique(sizes, axis=0).tolist():
        here = np.flatnonzero((sizes == (m, n)).all(1))
        sides = []
        for values, size in ((left, m), (right, n)):
            counts = np.frombuffer(b"".join(values[i] for i in here.tolist()), np.uint8).reshape(len(here), size)
            full = (counts == 255).any(1)
            sides.append((counts.reshape(len(here), min(m, n), -1).sum(2, dtype=np.int32), full))
        (x, full_x), (y, full_y) = sides
        out[here] = np.where(full_x | full_y, 1 << 40, np.minimum(x, y).sum(1))
    return out


def shingle_sets(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """``rk, doc_id, n, digest, ranges, parity, run`` per row; and rows without ``digest`` that list, for
    their task, the shingles that several of its documents have, with counts."""
    id_type = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, task, held, size = WordHashes(), TaskContext.get().partitionId(), [], 0
        kinds: list = []

        def table(rk, doc_id, n, digest, ranges, parities, often, counts) -> pa.RecordBatch:
            values = (rk, doc_id, n, digest, ranges, parities, [task] * len(rk), often, counts)
            longs = pa.list_(pa.int64())
            types = (pa.int64(), kinds[0], pa.int64(), pa.binary(), pa.binary(), longs, pa.int32(), longs, longs)
            return pa.record_batch([pa.array(v, t) for v, t in zip(values, types)], ["rk", "doc_id", "n", "digest", "ranges", "parity", "run", "often", "counts"])

        def frequent() -> pa.RecordBatch:
            nonlocal held, size
            value, count = np.unique(np.concatenate(held), return_counts=True)
            often = count > 2
            held, size = [], 0
            return table(*[[None]] * 6, [_signed(value[often])], [count[often]])

        for batch in text_slices(batches, "text"):
            kinds[:] = [batch.schema.field("doc_id").type]
            words.trim()
            sets = [shingles(t, words, width) for t in batch.column("text").to_pylist()]
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            blank = [None] * len(sets)
            yield table(batch.column("rk").to_pylist(), batch.column("doc_id").to_pylist(), [len(s) for s in sets], digests, [range_counts(s).tobytes() for s in sets], [parity(s) for s in sets], blank, blank)
            held += sets
            size += sum(map(len, sets))
            if size > 4 << 20:
                yield frequent()
        if size:
            yield frequent()

    schema = f"rk long, doc_id {id_type}, n long, digest binary, ranges binary, parity array<long>, run int, often array<long>, counts array<long>"
    return rows.mapInArrow(run, schema)


def prefix_rows(rows: DataFrame, often: np.ndarray, rank: np.ndarray, width: int = WIDTH) -> DataFrame:
    """``(token, part, rk, n, place)`` per shingle of each prefix; ``part`` is above 0 for frequent ones only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in text_slices(batches, "text", 1 << 20):
            words.trim()
            out: list[list[np.ndarray]] = [[] for _ in range(5)]
            for rk, text in zip(batch.column("rk").to_pylist(), batch.column("text").to_pylist()):
                s = shingles(text, words, width)
                n = len(s)
                if len(often) and n:
                    at = np.minimum(np.searchsorted(often, s), len(often) - 1)
                    weight = np.where(often[at] == s, rank[at], 0)
                    listed = np.flatnonzero(weight)
                    listed = listed[np.argsort(weight[listed], kind="stable")]
                    order = np.concatenate((np.flatnonzero(weight == 0), listed))
                    s, weight = s[order], weight[order]
                else:
                    weight = np.zeros(n, np.int64)
                k = n - -(-3 * n // 4) + 1 if n else 0
                part = np.where(weight[:k] > 0, 1 + rk % SPLIT, 0)
                for to, v in zip(out, (_signed(s[:k]), part, np.full(k, rk), np.full(k, n), np.arange(k))):
                    to.append(v)
            names = ["token", "part", "rk", "n", "place"]
            kinds = (np.int64, np.int32, np.int64, np.int32, np.int32)
            yield pa.record_batch([pa.array(np.concatenate(v).astype(t)) for v, t in zip(out, kinds)], names)

    return rows.select("rk", "text").mapInArrow(run, "token long, part int, rk long, n int, place int")


def candidates(prefixes: DataFrame, limit: int = SMALL) -> DataFrame:
    """``(token, rk, n, place, other)``: what the buckets of the prefixes hold.

    A bucket of one row is dropped. One of up to ``limit`` gives its pairs
    that pass the filters, as ``rk < other``, each pair once per task. The
    rows of larger ones, and of frequent shingles, come out as members
    (``other`` is null). No more than ``limit`` rows and a bounded number of
    pairs are held at a time.
    """
    dealt = prefixes.repartition("token", "part").sortWithinPartitions("token", "part")
    names, kinds = ["token", "rk", "n", "place", "other"], (np.int64, np.int64, np.int32, np.int32, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, k) for k in (np.int64, np.int32, np.int64, np.int32, np.int32)]  # the last bucket, not yet whole
        large = None  # the token of a bucket that is known to be large and still goes on
        pairs: list[np.ndarray] = []

        def members(token, rk, n, place) -> pa.RecordBatch:
            values = [pa.array(v.astype(k)) for v, k in zip((token, rk, n, place), kinds)]
            return pa.record_batch([*values, pa.nulls(len(token), pa.int64())], names)

        def paired() -> pa.RecordBatch:
            both = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
            pairs.clear()
            blank = pa.nulls(len(both), pa.int64()), pa.nulls(len(both), pa.int32())
            return pa.record_batch([blank[0], pa.array(both[:, 0]), blank[1], blank[1], pa.array(both[:, 1])], names)

        def whole(token, part, rk, n, place) -> Iterator[pa.RecordBatch]:
            """Rows of complete buckets."""
            first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))) if len(token) else np.zeros(0, np.int64)
            size = np.repeat(np.diff(np.append(first, len(token))), np.diff(np.append(first, len(token))))
            small = (part == 0) & (size <= limit)
            for d in range(1, limit):
                i = np.flatnonzero(small[:-d] & (token[:-d] == token[d:])) if len(token) > d else np.zeros(0, np.int64)
                if not len(i):
                    break
                i = i[passes(n[i], place[i], n[i + d], place[i + d], np.minimum, np.maximum)]
                pairs.append(np.unique(np.sort(np.stack([rk[i], rk[i + d]], 1), axis=1), axis=0))
            if sum(map(len, pairs)) > 1 << 20:
                yield paired()
            rest = ~small
            yield members(token[rest], rk[rest], n[rest], place[rest])

        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("token", "part", "rk", "n", "place")]
            if large is not None and len(batch):
                more = int(np.searchsorted(columns[0], large, "right"))
                token, _, rk, n, place = (c[:more] for c in columns)
                yield members(token, rk, n, place)
                columns = [c[more:] for c in columns]
                large = large if not len(columns[0]) else None
            if not len(columns[0]):
                continue
            columns = [np.concatenate(v) for v in zip(held, columns)]
            cut = int(np.searchsorted(columns[0], columns[0][-1]))
            yield from whole(*(c[:cut] for c in columns))
            held = [c[cut:] for c in columns]
            if len(held[0]) > limit or held[1][0] > 0:
                large = held[0][0]
                token, _, rk, n, place = held
                yield members(token, rk, n, place)
                held = [c[:0] for c in held]
        yield from whole(*held)
        yield paired()

    return dealt.mapInArrow(run, "token long, rk long, n int, place int, other long")


def passes(n, place, m, at, least=F.least, greatest=F.greatest):
    """Length filter, and positional filter: were this their first common shingle, as many
    could follow as the shorter rest holds. Of columns, or with numpy's functions of arrays."""
    return (4 * least(n, m) >= 3 * greatest(n, m)) & (7 * least(n - place, m - at) >= 3 * (n + m))


def alike(left: list[str], right: list[str]):
    """Parity filter, of columns: the sets that the bitmaps are of may link."""
    differ = sum((F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(left, right)), F.lit(0))
    return 7 * differ <= F.col("n") + F.col("p_n")


def token_sets(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(rk, tokens)``: sorted 64-bit hashes, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in text_slices(batches, "text"):
            words.trim()
            sets = [shingles(t, words, width).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("rk"), pa.array(sets, pa.binary())], ["rk", "tokens"])

    return rows.select("rk", "text").mapInArrow(run, "rk long, tokens binary")


def screened(pairs: DataFrame, ranges: DataFrame) -> DataFrame:
    """The ``(a, b)`` pairs that the suffix filter lets through; ``ranges`` has ``rk, n, ranges``."""
    for c, n, side in (("a", "n", "left"), ("b", "m", "right")):
        pairs = pairs.join(ranges.select(F.col("rk").alias(c), F.col("n").alias(n), F.col("ranges").alias(side)), c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            need = 3 * (batch.column("n").to_numpy() + batch.column("m").to_numpy())
            good = 7 * common_bound(batch.column("left").to_pylist(), batch.column("right").to_pylist()) >= need
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.select("a", "b", "n", "m", "left", "right").mapInArrow(run, "a long, b long")


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= 75 * union, of sorted hashes without repeats."""
    return 7 * len(np.intersect1d(a, b, assume_unique=True)) >= 3 * (len(a) + len(b))


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``(a, b)`` pairs that are links."""
    both = pairs.join(sets.select(F.col("rk").alias("b"), F.col("tokens").alias("right")), "b")
    both = both.join(sets.select(F.col("rk").alias("a"), F.col("tokens").alias("left")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column("left"), batch.column("right"))
            good = [linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in sides]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def merged(roots: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """``(node, root)`` of the components after more ``(a, b)`` links."""
    if links.isEmpty():
        return roots
    if roots is None:
        return connected(links)
    for c in ("a", "b"):  # links between components
        side = roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
        links = links.join(side, c, "left").withColumn(c, F.coalesce(f"{c}_root", c)).drop(f"{c}_root")
    found = connected(links)
    moved = found.select(F.col("node").alias("root"), F.col("root").alias("to"))
    old = roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    new = found.join(roots.select("node"), "node", "left_anti")
    return materialize(old.unionByName(new), "components")


def link_classes(members: DataFrame, tested: DataFrame, sets: DataFrame, ranges: DataFrame, maps: DataFrame) -> DataFrame | None:
    """``(node, root)`` of the linked classes, from the members of large buckets and the
    screened pairs of small ones; None if no two link. ``maps`` has, by ``rk``, the words
    ``w0``, ``w1``, ... of a member's bitmap and ``listed``, its shingles of large buckets by
    place: they join the narrow rows of the rounds for the pairing alone."""
    words = [f"w{i}" for i in range(PARITY)]
    theirs = [f"p_{w}" for w in words]
    p_maps = maps.toDF("p_rk", *theirs, "p_listed")
    roots = merged(None, materialize(verify(tested, sets), "links"))
    pivots_per_bucket, factor = 1, GROWTH
    while True:
        if roots is None:
            labelled = members.withColumn("root", F.col("rk"))
        else:
            labelled = members.join(roots.select(F.col("node").alias("rk"), "root"), "rk", "left").withColumn("root", F.coalesce("root", "rk"))
        parts = labelled.groupBy("token", "root").agg(F.count(F.lit(1)).alias("size"))
        opened = parts.groupBy("token").agg(F.max(F.struct("size", "root")).alias("top"), F.count(F.lit(1)).alias("parts"))
        opened = opened.where("parts > 1").select("token", F.col("top.root").alias("main"))
        labelled = materialize(labelled.join(opened, "token"), "members")
        if labelled.isEmpty():
            return roots
        slot = F.pmod(F.xxhash64("rk"), F.lit(pivots_per_bucket))
        pivots = labelled.where("root <> main").groupBy("token", slot.alias("slot")).agg(F.min(F.struct("rk", "n", "place", "root")).alias("p"))
        pivots = materialize(pivots.select("token", "p.*").toDF("token", "p_rk", "p_n", "p_place", "p_root"), "pivots")
        good = (F.col("root") != F.col("p_root")) & passes(F.col("n"), F.col("place"), F.col("p_n"), F.col("p_place")) & alike(words, theirs)
        # all sets are ordered alike, so this is the first common shingle of both
        good = good & (F.get(F.array_intersect("listed", "p_listed"), F.lit(0)) == F.col("token"))
        ends = F.least("rk", "p_rk").alias("a"), F.greatest("rk", "p_rk").alias("b")
        pairs = labelled.join(maps, "rk").join(pivots.join(p_maps, "p_rk"), "token").where(good).select(*ends).distinct()
        pairs = materialize(screened(pairs.join(tested, ["a", "b"], "left_anti"), ranges), "pairs")
        tested = tested.unionByName(pairs)
        roots = merged(roots, materialize(verify(pairs, sets), "links"))
        members = labelled.join(pivots.select("token", F.col("p_rk").alias("rk")), ["token", "rk"], "left_anti").drop("root", "main")
        pivots_per_bucket, factor = pivots_per_bucket * factor, factor * GROWTH


def ngram_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``doc_id, n_shingles, component_id, rk`` per row; ``rk`` is a unique row key.

    Rows link when the Jaccard likeness of their shingle sets is 0.75 or
    more; ``component_id`` is the smallest id reachable by links. Null, empty
    and blank texts have an empty set and link with nothing. Repeated rows
    are one class. A null id is nobody's ``component_id`` unless all ids of
    the component are null. An empty table gives an empty result; other
    columns are ignored.
    """
    rows = keyed_texts(df, id_col, text_col)
    found = materialize(shingle_sets(rows, width), "shingle_sets")
    docs = found.where("digest IS NOT NULL").select("rk", "doc_id", "n", "digest", "ranges", "parity", "run")
    # Classes of equal sets, per task first: neither the sums nor the way back meet a large class in one task.
    filled = docs.where("n > 0")
    best = [F.min("rk").alias("rep"), F.min("doc_id").alias("low")]
    by_run = materialize(filled.groupBy("run", "digest").agg(*best), "run_classes")
    classes = materialize(by_run.groupBy("digest").agg(F.min("rep").alias("rep"), F.min("low").alias("low")), "classes")

    listed = found.where("digest IS NULL").select(F.explode(F.arrays_zip("often", "counts")).alias("s"))
    listed = listed.groupBy("s.often").agg(F.sum("s.counts").alias("count")).orderBy(F.desc("count"), "often").limit(FREQUENT).toArrow()
    often = listed.column("often").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(often)
    often, rank = often[order], listed.column("count").to_numpy()[order]

    # Texts are shuffled to their few keys whatever their size: "merge" keeps the plan of a small table that of a large one.
    one = classes.select(F.col("rep").alias("rk"))
    reps = rows.join(one.hint("merge"), "rk", "left_semi")
    ranges = bucketed(docs.join(one.hint("merge"), "rk", "left_semi").select("rk", "n", "ranges"), "range_counts", "rk")
    buckets = materialize(candidates(prefix_rows(reps, often, rank, width)), "buckets")
    listed = buckets.where("other IS NOT NULL").select(F.col("rk").alias("a"), F.col("other").alias("b")).distinct()
    tested = materialize(screened(listed, ranges), "pairs")
    members = buckets.where("other IS NULL").drop("other")
    placed = F.sort_array(F.collect_list(F.struct("place", "token")))  # no longer than a prefix
    own = members.groupBy("rk").agg(F.transform(placed, lambda p: p["token"]).alias("listed"))
    words = [F.col("parity")[i].alias(f"w{i}") for i in range(PARITY)]
    maps = bucketed(docs.join(own.hint("merge"), "rk").select("rk", *words, "listed"), "bitmaps", "rk")
    ends = tested.select(F.explode(F.array("a", "b")).alias("rk")).unionByName(members.select("rk")).distinct()
    sets = bucketed(token_sets(rows.join(ends.hint("merge"), "rk", "left_semi"), width), "token_sets", "rk")
    roots = link_classes(members, tested, sets, ranges, maps)
    if roots is not None:
        placed = classes.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
        lowest = placed.groupBy("root").agg(F.min("low").alias("component_id"))
        classes = materialize(placed.drop("low").join(lowest, "root").select("digest", "component_id"), "classes")
    else:
        classes = classes.select("digest", F.col("low").alias("component_id"))
    by_run = by_run.select("run", "digest").join(classes, "digest")
    out = docs.join(by_run, ["run", "digest"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "rk")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component of linked texts, the one with the smallest id; all columns stay."""
    rows, key = with_key(docs, id_col)
    found = ngram_components(rows, key, text_col)
    kept = found.where("component_id = doc_id").select(F.col("doc_id").alias(key))
    out = rows.join(kept, key, "left_semi")
    return out if key == id_col else out.drop(key)


def query(spark, sf_dir: str) -> DataFrame:
    return ngram_components(documents(spark, sf_dir)).drop("rk")
