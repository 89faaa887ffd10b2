"""A hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class). The class is
predicted by a softmax over hashed features of the history: the previous
word (n-gram), the one before it (skip), and the classes of the previous
three words. Within its class a word is predicted by its bias alone, the
logarithm of its count.

Words get classes by how often they are used (three bands of the most
frequent words, and the rest) and by a cluster, which keeps words of one
language or kind together: the most frequent words are clustered by the
very frequent words that come before them, all others follow the byte
trigrams of those. A class of rest words keeps room for one unseen word,
so that the probabilities of a history add up to one.

All counts are over all training texts. The frequent words (``HEAD`` at
most) are known to every task; the others' counts are joined by shuffle.

Training texts are dealt to ``SLICES`` slices by hash. An update passes over
one slice: tasks sum what every feature saw of each class, and what the
model expected, the sums are added up in a tree, and the driver moves the
weights (``ROWS`` x ``CLASSES``, whatever the corpus) along the gradient by
falling steps. All slices have their turn, and again, until the likelihood
of texts that the model has not just been fitted to settles; a large corpus
settles while it is read for the first time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import documents, keyed_texts, materialize, scratch_path, text_slices

#: Most words that every task gets with their counts.
HEAD = 1 << 18
CLUSTERS, BANDS = 7, (64, 1024)
REST = (len(BANDS) + 1) * CLUSTERS
#: Classes: three bands of head words and the rest, per cluster; the last for the end.
CLASSES = 32
END_CLASS = CLASSES - 1
SEEDS, SIGNED = 64, 4096
#: Hashed rows per kind of feature; ids of all kinds fit in 16 bits.
KINDS = (1 << 15, 1 << 14, 1 << 14)
ROWS = sum(KINDS)
BLOCK = 1 << 10
#: Tokens worked on at a time: their scores fit in a processor's cache.
CHUNK = 1 << 13
#: Slices of the training texts; an update reads one.
SLICES = 8
#: The first updates' steps; those of later ones fall as 2 / (number of the update - 1). The count that damps rare features.
STEPS, DAMPING = (2.0, 1.0, 1.0), 4.0
#: The likelihood has settled once an update adds less to a token's mean log probability (natural logarithm).
SETTLED = 0.02
#: Tasks whose sums meet first.
FAN_IN = 16
#: Every document whose crc32(id) leaves this remainder is held out.
FOLDS, HELD_OUT = 7, 2


def trigram_sums(words: list[bytes], table: np.ndarray) -> np.ndarray:
    """The sum of ``table``'s rows over each word's hashed byte trigrams (its first 24 bytes, with marks at both ends)."""
    cut = [b"\x01" + w[:24] + b"\x02\x00" for w in words]
    data = np.frombuffer(b"".join(cut), np.uint8).astype(np.uint32)
    key = (data[:-2] * 31 + data[1:-1]) * 31 + data[2:]
    begin = np.cumsum([0, *map(len, cut)])[:-1]
    return np.add.reduceat(table[np.append(key, (0, 0)) % len(table)], begin, axis=0)


class Vocabulary:
    """What tasks know of words: numbers, counts and classes. The end is the empty word."""

    def __init__(self, words: list[bytes], counts: np.ndarray, tokens: int, types: int):
        self.words, self.counts, self.tokens, self.types = words, counts, tokens, types
        self.cluster = np.zeros(len(words), np.int8)
        self.trigrams = np.zeros((1, CLUSTERS), np.float32)
        self.rest = np.zeros((CLUSTERS, 2), np.int64)  # tokens and types of the other words
        self.index: dict[bytes, int] | None = None

    def __getstate__(self):
        return {**self.__dict__, "index": None}

    def set_clusters(self, cluster: np.ndarray, trigrams: np.ndarray) -> None:
        self.cluster, self.trigrams = cluster.astype(np.int8), trigrams.astype(np.float32)

    def cluster_of(self, words: list[bytes]) -> np.ndarray:
        return trigram_sums(words, self.trigrams).argmax(1).astype(np.int8) if words else np.zeros(0, np.int8)

    def head_classes(self) -> np.ndarray:
        band = np.searchsorted(BANDS, np.arange(len(self.words)), side="right")
        out = band * CLUSTERS + self.cluster
        out[[i for i, w in enumerate(self.words) if not w]] = END_CLASS
        return out.astype(np.int8)

    def code(self, texts: list[str], head: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """All tokens in a row, each text's end included: word numbers (of a word
        outside the head: the head's size), classes, where each text ends, and the
        words outside the head. With ``head``, numbers from there on are of no interest
        and neither are classes."""
        size = len(self.words) if head is None else min(head, len(self.words))
        if self.index is None or len(self.index) != size:
            self.index = dict(zip(self.words[:size], range(size)))
            # after the head: other words, and an end that no training text has
            self.classes = np.append(self.head_classes()[:size], np.array([0, END_CLASS], np.int8))
            self.end = self.index.get(b"", size + 1)
        look, ids, others = self.index.get, [], []
        end = np.array([self.end], np.int32)
        for text in texts:
            tokens = text.encode().lower().split()
            code = np.fromiter(map(look, tokens, repeat(size)), np.int32, len(tokens))
            if head is None:
                others += [tokens[i] for i in np.flatnonzero(code == size).tolist()]
            ids += [code, end]
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        ends = np.cumsum([len(a) + 1 for a in ids[::2]], dtype=np.int64)
        classes = self.classes[flat]
        if others:
            classes[flat == size] = REST + self.cluster_of(others)
        return flat, classes, ends, others


def histories(ids: np.ndarray, classes: np.ndarray, ends: np.ndarray, head: int) -> np.ndarray:
    """Hashed feature rows (as 16-bit numbers, by kind) of the history of every token."""
    known = np.where(ids < head, ids, head + classes.astype(np.int64)).astype(np.uint64) + np.uint64(1)
    kind = classes.astype(np.uint64) + np.uint64(1)

    def before(values: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(len(values), np.uint64)
        out[n:] = values[: len(values) - n]
        for begin in np.concatenate(([0], ends[:-1])).tolist():
            out[begin : begin + n] = 0  # nothing before a text
        return out

    c1, c2, c3 = (before(kind, n) for n in (1, 2, 3))
    keys = (before(known, 1), before(known, 2), (c1 * np.uint64(64) + c2) * np.uint64(64) + c3)
    out, base = np.empty((3, len(ids)), np.uint16), 0
    for i, (key, size) in enumerate(zip(keys, KINDS)):
        mixed = (key + np.uint64(i)) * np.uint64(0x9E3779B97F4A7C15)
        out[i] = (mixed >> np.uint64(40)) % np.uint64(size) + np.uint64(base)
        base += size
    return out


def class_probabilities(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Of every class, for each column of feature ``rows``. The last row of ``weights`` is the bias."""
    z = weights[rows[0]]
    for r in rows[1:]:
        z += weights[r]
    z += weights[-1]
    z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    return z


def count_words(train: DataFrame) -> DataFrame:
    """``(word, c)`` of all training texts; the end is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def table() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(list(counts.keys()), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in text_slices(batches, "text"):
            for text in batch.column("text").to_pylist():
                counts.update(text.encode().lower().split())
            counts[b""] += len(batch)
            if len(counts) > 400_000:
                yield table()
        yield table()

    return train.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def add_up(sums: DataFrame, size: int, tasks: int | None = None) -> np.ndarray:
    """The total of ``(block, values)`` rows of 32-bit floats; ``size`` blocks of one length.

    The sums of ``FAN_IN`` tasks are added up first, and these then; of so
    many tasks at most, all at once.

    The driver's JVM is asked to collect what refers to the shuffles, as in
    ``materialize``: updates do not pile up on disks.
    """

    def adder():
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for block, values in zip(batch.column("block").to_pylist(), batch.column("values")):
                    part = np.frombuffer(values.as_buffer(), np.float32).astype(np.float64)
                    total[block] = total[block] + part if block in total else part
            for block, values in sorted(total.items()):
                yield pa.record_batch([pa.array([block], pa.int32()), pa.array([values.astype(np.float32).tobytes()], pa.binary())], ["block", "values"])

        return run

    schema = "block int, values binary"
    few = tasks is not None and tasks <= FAN_IN
    once = sums.repartition("block", *[] if few else ["salt"]).drop("salt").mapInArrow(adder(), schema)
    rows = (once if few else once.repartition("block").mapInArrow(adder(), schema)).collect()  # a fixed number of blocks
    sums.sparkSession.sparkContext._jvm.System.gc()
    total = np.zeros((size, BLOCK * CLASSES), np.float32)
    for r in rows:
        total[r["block"]] = np.frombuffer(r["values"], np.float32)
    return total.ravel()


def blocks_of(values: np.ndarray, salt: int) -> Iterator[pa.RecordBatch]:
    """A task's sums as rows for ``add_up``; blocks of zeros are left out."""
    for b, part in enumerate(values.astype(np.float32, copy=False).reshape(-1, BLOCK * CLASSES)):
        if part.any():
            yield pa.record_batch([pa.array([b], pa.int32()), pa.array([salt], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["block", "salt", "values"])


SUMS = "block int, salt int, values binary"


def task_salt() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId() // FAN_IN


def signatures(train: DataFrame, shared: Broadcast) -> np.ndarray:
    """How often each of the first ``SIGNED`` words follows each of the first ``SEEDS`` (the nearest before it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, total = shared.value, np.zeros(SIGNED * SEEDS)
        signed, seeds = (min(n, len(vocabulary.words)) for n in (SIGNED, SEEDS))
        for batch in text_slices(batches, "text"):
            ids, _, ends, _ = vocabulary.code(batch.column("text").to_pylist(), SIGNED)
            place = np.arange(len(ids))
            seed = np.where((ids < seeds) & (ids != vocabulary.end), place, -1)
            last = np.concatenate(([-1], np.maximum.accumulate(seed)[:-1])) if len(ids) else seed
            begin = np.repeat(np.concatenate(([0], ends[:-1])), np.diff(ends, prepend=0))
            use = (last >= begin) & (ids < signed)
            total += np.bincount(ids[use].astype(np.int64) * SEEDS + ids[last[use]], minlength=SIGNED * SEEDS)
        yield from blocks_of(total, task_salt())

    return add_up(train.select("text").mapInArrow(run, SUMS), SIGNED * SEEDS // (BLOCK * CLASSES)).reshape(-1, SEEDS)


def cluster_words(words: list[bytes], counts: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Clusters of all words, and the trigram table that tells them for any word.

    Lloyd's rounds over the directions of the signed words' signatures;
    then trigrams vote by their smoothed log odds.
    """
    n = min(len(words), SIGNED)
    after = after[:n] if len(after) else np.zeros((n, SEEDS))
    share = (after + 0.1) / (after.sum(1, keepdims=True) + 0.1 * SEEDS)
    x = np.log(share / ((after.sum(0) + 1) / (after.sum() + SEEDS)))
    x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-9
    centre = [x[0]] if n else []
    while n and len(centre) < CLUSTERS:  # far from those there are
        centre.append(x[np.argmin((x @ np.array(centre).T).max(1))])
    label = np.zeros(n, np.int64)
    for _ in range(25 if n else 0):
        label = (x @ np.array(centre).T).argmax(1)
        for k in range(CLUSTERS):
            if (label == k).any():
                m = (x * np.sqrt(counts[:n, None]))[label == k].sum(0)
                centre[k] = m / (np.linalg.norm(m) + 1e-9)
    votes = np.zeros((4096, CLUSTERS))
    for word, k in zip(words[:n], label):
        cut = b"\x01" + word[:24] + b"\x02"
        for a, b, c in zip(cut, cut[1:], cut[2:]):
            votes[((a * 31 + b) * 31 + c) % 4096, k] += 1
    size = votes.sum(0) + 1
    odds = np.log((votes + 0.1) / size) - np.log((votes.sum(1, keepdims=True) + 0.5) / size.sum())
    cluster = trigram_sums(words, odds).argmax(1) if words else np.zeros(0, np.int64)
    cluster[:n] = label
    return cluster, odds


def observed(train: DataFrame, shared: Broadcast) -> np.ndarray:
    """Counts of every feature row with every class."""
    return sums_of(train, shared, None)[0]


def expected(train: DataFrame, shared: Broadcast, weights: Broadcast) -> np.ndarray:
    """What the model expects of ``observed``."""
    return sums_of(train, shared, weights)[1]


def sums_of(train: DataFrame, shared: Broadcast, weights: Broadcast | None) -> tuple[np.ndarray, np.ndarray, float, float, float]:
    """``observed``; what the model expects of it (zeros without ``weights``); the log probability that
    the model, and its bias alone, give to all classes; and the number of tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, w = shared.value, weights.value if weights else None
        seen, model, told = np.zeros(ROWS * CLASSES, np.float32), np.zeros((ROWS, CLASSES), np.float32), np.zeros(3)
        for batch in text_slices(batches, "text"):
            ids, classes, ends, _ = vocabulary.code(batch.column("text").to_pylist())
            every = histories(ids, classes, ends, len(vocabulary.words))
            for rows in every:
                at, count = np.unique(rows.astype(np.int32) * CLASSES + classes, return_counts=True)
                seen[at] += count
            told[2] += len(ids)
            for begin in range(0, len(ids) if weights else 0, CHUNK):
                part, own = every[:, begin : begin + CHUNK], classes[begin : begin + CHUNK]
                p = class_probabilities(w, part)
                told[0] += np.log(np.maximum(p[np.arange(len(p)), own], 1e-30)).sum(dtype=np.float64)
                told[1] += w[-1][own].sum(dtype=np.float64)
                for rows in part:
                    order = np.argsort(rows, kind="stable")
                    in_order = rows[order]
                    first = np.flatnonzero(np.concatenate(([True], in_order[1:] != in_order[:-1])))
                    model[in_order[first]] += np.add.reduceat(p[order], first, axis=0)
        salt = task_salt()
        yield from blocks_of(seen, salt)
        for batch in blocks_of(model.ravel(), salt):
            yield batch.set_column(0, "block", pa.array([batch.column("block")[0].as_py() + ROWS // BLOCK], pa.int32()))
        last = np.zeros(BLOCK * CLASSES, np.float32)
        last[:9] = _parts(told)
        yield pa.record_batch([pa.array([2 * ROWS // BLOCK], pa.int32()), pa.array([salt], pa.int32()), pa.array([last.tobytes()], pa.binary())], ["block", "salt", "values"])

    # A task's sums are as large as the weights: as many tasks as there are cores, and not as splits of the texts.
    tasks = train.sparkSession.sparkContext.defaultParallelism
    sums = add_up(train.select("text").coalesce(tasks).mapInArrow(run, SUMS), 2 * ROWS // BLOCK + 1, tasks)
    seen, model = sums[: 2 * ROWS * CLASSES].reshape(2, ROWS, CLASSES)
    told = sums[2 * ROWS * CLASSES :][:9].reshape(3, 3).sum(0)
    return seen, model, *map(float, told)


def _parts(values: np.ndarray) -> np.ndarray:
    """64-bit floats as sums of three 32-bit ones, one row each."""
    out = np.zeros((3, len(values)), np.float32)
    for row in out:
        row[:] = values
        values = values - row
    return out.ravel()


def train_weights(train: DataFrame, shared: Broadcast) -> np.ndarray:
    """Class weights per feature row, and the bias in the last row, from texts with a row key ``rk``.

    Every slice is read at least once. After a round over all slices the
    training ends if its second half rose by less than ``SETTLED`` a token
    and update (the slope of a line through it), or the round as a whole
    gained less on the one before; gains are over the bias alone on the same
    texts, so that slices compare. Steps fall, so the gains do and the
    rounds end.
    """
    spark = train.sparkSession
    path = scratch_path(spark, "slices")
    train.withColumn("slice", F.pmod(F.xxhash64("rk"), F.lit(SLICES))).select("text", "slice").write.partitionBy("slice").parquet(path)
    texts = spark.read.schema("text string, slice int").parquet(path)
    mass = class_mass(shared.value)
    weights = np.zeros((ROWS + 1, CLASSES))
    weights[-1] = np.log((mass + 0.5) / (mass.sum() + 0.5 * CLASSES))
    gains: list[float] = []
    updates = 0
    while True:
        round_ = []
        for i in range(SLICES):
            told = spark.sparkContext.broadcast(weights.astype(np.float32))
            seen, model, there, bias, tokens = sums_of(texts.where(F.col("slice") == i), shared, told)
            told.unpersist()
            if not tokens:
                continue
            round_.append((there - bias) / tokens)
            updates += 1
            step = STEPS[updates - 1] if updates <= len(STEPS) else 2 / (updates - 1)
            weights[:-1] += step * (seen - model) / (np.maximum(seen, model) + DAMPING)
        gains.append(float(np.mean(round_)) if round_ else 0.0)
        late = round_[len(round_) // 2 :]
        if len(late) < 2 or np.polyfit(range(len(late)), late, 1)[0] < SETTLED or (len(gains) > 1 and gains[-1] - gains[-2] < SETTLED):
            return weights.astype(np.float32)


def class_mass(vocabulary: Vocabulary) -> np.ndarray:
    """Training tokens of each class."""
    mass = np.bincount(vocabulary.head_classes(), vocabulary.counts, CLASSES).astype(np.float64)
    mass[REST : REST + CLUSTERS] += vocabulary.rest[:, 0]
    return mass


def score_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", train=None, head: int = HEAD) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row.

    Learns from the rows that ``train`` (a condition on ``doc_id``; by default
    the folds of crc32 but one) selects. Words are the runs between ASCII
    white space, A-Z in lower case; an end follows, also in a null or empty
    text. Repeated rows count as often as they occur. Null ids are held out.
    Without a training row every token has probability one; an empty table
    gives an empty result; other columns are ignored.
    """
    spark = df.sparkSession
    rows = keyed_texts(df, id_col, text_col)
    if train is None:
        train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS != HELD_OUT
    rows = rows.withColumn("train", F.coalesce(train, F.lit(False)))
    texts = rows.where("train")
    counts = materialize(count_words(texts), "word_counts")
    size = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"), F.count_if(F.col("c") > 0).alias("types")).first()
    tokens, types = size["tokens"], size["types"]
    # The smallest count of which, with all larger ones, there are no more than the head's words. Words
    # seen once are never in the head: as the rest they tell how often a word that is not yet known comes.
    least, total = 2, 0
    tallies = counts.groupBy(F.least("c", F.lit(1 << 20)).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    for r in sorted(tallies.collect(), key=lambda r: -r["c"]):  # at most 2**20 entries
        total += r["n"]
        if total > head:
            least = max(least, r["c"] + 1)
            break
    listed = counts.where((F.col("c") >= least) | (F.col("word") == b"")).toArrow()
    pairs = sorted(zip(listed.column("word").to_pylist(), listed.column("c").to_pylist()), key=lambda p: (-p[1], p[0]))
    vocabulary = Vocabulary([w for w, _ in pairs], np.array([c for _, c in pairs], np.int64), tokens, types)
    context = spark.sparkContext
    if tokens:
        after = signatures(texts, context.broadcast(vocabulary))
        vocabulary.set_clusters(*cluster_words(vocabulary.words, vocabulary.counts, after))
        vocabulary.rest = rest_sizes(counts.where(F.col("c") < least), context.broadcast(vocabulary))
    shared = context.broadcast(vocabulary)
    weights = context.broadcast(train_weights(texts, shared) if tokens else np.zeros((ROWS + 1, CLASSES), np.float32))
    partial = materialize(score_known(rows, shared, weights), "scores")
    others = partial.select("rk", F.explode(F.arrays_zip("others", "times")).alias("o")).select("rk", "o.others", "o.times")
    rare = counts.where((F.col("c") < least) & (F.col("word") != b"")).select(F.col("word").alias("others"), "c")
    found = others.join(rare, "others", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    found = found.groupBy("rk").agg(F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("gain"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known"))
    out = partial.drop("others", "times").join(found, "rk", "left")
    gain = F.coalesce("gain", F.lit(0.0))
    return rows.select("rk", "doc_id", "train").join(out, "rk").select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + gain).alias("base_score"),
        (F.col("score") + gain).alias("score"),
    )


def rest_sizes(counts: DataFrame, shared: Broadcast) -> np.ndarray:
    """Tokens and types of the words outside the head, per cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, total = shared.value, np.zeros((CLUSTERS, 2), np.int64)
        for batch in batches:
            cluster = vocabulary.cluster_of(batch.column("word").to_pylist())
            total[:, 0] += np.bincount(cluster, batch.column("c").to_numpy(), CLUSTERS).astype(np.int64)
            total[:, 1] += np.bincount(cluster, minlength=CLUSTERS)
        yield pa.record_batch([pa.array(range(CLUSTERS), pa.int32()), pa.array(total[:, 0]), pa.array(total[:, 1])], ["cluster", "tokens", "types"])

    sums = counts.where("word <> X''").mapInArrow(run, "cluster int, tokens long, types long").groupBy("cluster").agg(F.sum("tokens"), F.sum("types"))
    out = np.zeros((CLUSTERS, 2), np.int64)
    for cluster, tokens, types in sums.collect():
        out[cluster] = tokens, types
    return out


def score_known(rows: DataFrame, shared: Broadcast, weights: Broadcast) -> DataFrame:
    """Scores without the counts of words outside the head: those are listed as ``others``, with ``times``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, w = shared.value, weights.value
        head, trained = len(vocabulary.words), vocabulary.tokens > 0
        classes = vocabulary.head_classes()
        mass = np.bincount(classes, vocabulary.counts, CLASSES)
        inside = np.log10(vocabulary.counts / np.maximum(mass[classes], 1)) if head else np.zeros(0)
        base = np.log10(vocabulary.counts + 1.0)
        # Of a rest word only the denominator is known here; in the class of the end there is no other word.
        room = np.zeros(CLASSES)
        room[REST : REST + CLUSTERS] = -np.log10(vocabulary.rest.sum(1) + 1.0)
        whole = np.log10(vocabulary.tokens + 1.0 * (vocabulary.types + 1))
        for batch in text_slices(batches, "text"):
            ids, kinds, ends, rare = vocabulary.code(batch.column("text").to_pylist())
            every = histories(ids, kinds, ends, head)
            p = np.ones(len(ids), np.float32)
            for at in range(0, len(ids) if trained else 0, CHUNK):
                part = class_probabilities(w, every[:, at : at + CHUNK])
                p[at : at + CHUNK] = part[np.arange(len(part)), kinds[at : at + CHUNK]]
            known = ids < head
            safe = np.where(known, ids, 0)
            own = np.where(known, inside[safe], room[kinds]) if head else room[kinds] * trained
            score = np.log10(p.astype(np.float64)) + own
            plain = (np.where(known, base[safe], 0.0) if head else np.zeros(len(ids))) - whole
            begin = np.concatenate(([0], ends[:-1]))
            others, times, at = [], [], 0
            for n in np.add.reduceat(ids == head, begin, dtype=np.int64).tolist():
                found = Counter(rare[at : at + n])
                others.append(list(found.keys())), times.append(list(found.values()))
                at += n
            sums = [np.add.reduceat(v, begin) for v in (known.astype(np.int64), plain, score if trained else plain)]
            columns = [batch.column("rk"), pa.array(ends - begin), *map(pa.array, sums), pa.array(others, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64()))]
            yield pa.record_batch(columns, ["rk", "n_tokens", "n_known", "base", "score", "others", "times"])

    schema = "rk long, n_tokens long, n_known long, base double, score double, others array<binary>, times array<long>"
    return rows.select("rk", "text").mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return score_texts(documents(spark, sf_dir))
