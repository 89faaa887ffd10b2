"""Table sinks, as plain Parquet writes.

- ``VersionedTable``: every write is a new folder ``v=000001``,
  ``v=000002``, … which counts once Spark's job commit has written its
  ``_SUCCESS`` marker: all or nothing, and two versions can be compared. A
  version written by a stream carries the stream's id and batch number in
  its folder name, so the mark is committed with the data.
- ``KeyedTable``: one folder partitioned by a stored bucket of the key. A
  merge reads the partitions of the batch's keys, writes what becomes of
  them (and, if wanted, the change images) whole under a pending commit and
  then moves them in; an append moves files in without reading rows.
- ``HistoryTable``: SCD2 versions; open ones partitioned by bucket and
  replaced where they change, closed ones appended under their run.

Folder listing uses the Hadoop FileSystem of the session, so the same code
works on local disk, HDFS or object stores.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeforge.operators.changes import CHANGE, change_feed, scd2_open, upsert, upsert_with_images
from lakeforge.operators.quality import CheckFailed
from lakeforge.session import checkpoint_root

Step = Callable[[DataFrame | None, DataFrame], DataFrame]
#: Of stored tables: ids are hex texts, which a codec without entropy coding leaves at their length.
CODEC = "zstd"
#: A stream's lasting id and the number of its micro-batch.
Mark = tuple[str, int]


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, jvm


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, sorted; none if it does not exist."""
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


class VersionedTable:
    NAME = re.compile(r"v=(\d+)(?:\.([0-9a-f-]+)\.(\d+))?$")

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ------------------------------------------------------------ versions
    def _all(self) -> list[tuple[int, str]]:
        """(version, folder name) of every version folder, committed or not, oldest first."""
        return sorted((int(m[1]), n) for n in _folders(self.spark, self.root) if (m := self.NAME.match(n)))

    def _committed(self) -> dict[int, str]:
        fs, _, jvm = _fs(self.spark, self.root)
        return {v: n for v, n in self._all() if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.root}/{n}/_SUCCESS"))}

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return sorted(self._committed())

    def exists(self) -> bool:
        return bool(self.versions())

    def applied(self, stream: str) -> int:
        """The last batch of a stream that a committed version holds, or -1."""
        marks = (self.NAME.match(n) for n in self._committed().values())
        return max((int(m[3]) for m in marks if m[2] == stream), default=-1)

    def read(self, version: int | None = None) -> DataFrame:
        names = self._committed()
        if not names:
            raise FileNotFoundError(f"no committed version under {self.root}")
        return self.spark.read.parquet(f"{self.root}/{names[max(names) if version is None else version]}")

    # -------------------------------------------------------------- writes
    def publish(self, df: DataFrame, mark: Mark | None = None, checks: dict[str, Column] | None = None) -> int:
        """Write the next version; visible only after job commit.

        ``checks`` names conditions that no row may meet (Q2, Q3, Q4's row
        rules; see ``operators.quality``). They are counted by the writing
        job itself, while the rows pass; if any row fails, the version stays
        unpublished and ``CheckFailed`` tells the counts. The version that
        readers see does not change.
        """
        # Number past every folder, committed or not: an attempt that
        # failed mid-write is never reused and never becomes visible.
        version = max((v for v, _ in self._all()), default=0) + 1
        name = f"v={version:06d}" + (f".{mark[0]}.{mark[1]}" if mark else "")
        if not checks:
            df.write.mode("error").parquet(f"{self.root}/{name}")
            return version
        pending = f"{self.root}/_pending/{name}"
        fs, folder, jvm = _fs(self.spark, pending)
        fs.delete(folder, True)  # of an attempt that has failed
        counted = Observation()
        # Directly below the write, so a task that runs twice counts once.
        rows = df.observe(counted, *[F.count_if(c).alias(n) for n, c in checks.items()])
        rows.write.mode("error").parquet(pending)
        failing = {n: counted.get[n] for n in checks if counted.get[n]}
        if failing:
            fs.delete(folder, True)
            raise CheckFailed(failing)
        if not fs.rename(folder, jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")):
            raise OSError(f"{pending} could not be moved")
        return version

    def merge(self, batch: DataFrame, step: Step, mark: Mark | None = None) -> int | None:
        """Publish ``step(current rows or None, batch)``; None if this batch of its stream is already in."""
        if mark and self.applied(mark[0]) >= mark[1]:
            return None
        return self.publish(step(self.read() if self.exists() else None, batch), mark)

    def upsert(self, source: DataFrame, keys: Sequence[str], **options) -> int:
        """Upsert into the current version, or create the table."""
        return self.merge(source, lambda current, b: b if current is None else upsert(current, b, keys, **options))

    def change_feed(self, keys: Sequence[str], start: int, end: int | None = None) -> DataFrame:
        """Row changes between two committed versions."""
        return change_feed(self.read(start), self.read(end), keys)


def bucket_of(keys: Sequence[str], buckets: int, folded: Sequence[str] = (), joined: bool = False) -> Column:
    """Bucket of a key; parts that are ``folded`` count whatever their case.

    ``joined`` buckets are the partitions to which the change operators deal
    complete keys, so what a join leaves in one partition is one bucket.
    """
    parts = [F.lower(F.upper(F.col(k))) if k in folded else F.col(k) for k in keys]
    if joined:
        return F.pmod(F.hash(*parts, F.lit(0).cast("bigint")), F.lit(buckets)).cast("int")
    return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")


class KeyedTable:
    """Plain Parquet partitioned by a stored bucket of the key: ``<root>/_n=<buckets>/_b=<bucket>``.

    ``buckets`` is the caller's choice (the table's size over what one task
    should rewrite) and part of the layout; ``rebucket`` copies the table to
    another count when it has outgrown it.

    A commit has two steps. One Spark job writes whole partitions, new files
    for partitions, or change images to ``<root>/_pending/<commit>``; its
    ``_SUCCESS`` decides that the commit takes place. Then the folders are
    moved in, and the pending folder, with the images, moves to
    ``<root>/_commits``, which marks the commit as done. Whatever stops the
    driver in between, the next use of the table first finishes what is
    decided and drops what is not: a partition is removed only while its
    successor lies complete beside it. A micro-batch whose mark a finished
    commit bears is not applied again.

    One writer at a time, on a file system that renames folders in one step.
    With ``feed``, upserts keep their change images, to be read by commit.
    """

    COMMIT = re.compile(r"c=(\d+)(?:\.([0-9a-f-]+)\.(\d+))?$")

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int, folded: Sequence[str] = (), feed: bool = False, joined: bool = False):
        self.spark, self.root, self.keys, self.buckets, self.joined = spark, root.rstrip("/"), list(keys), buckets, joined
        self.bucket = bucket_of(self.keys, buckets, folded, joined)
        self.folded, self.feed = list(folded), feed
        stored = [n for n in _folders(spark, self.root) if n.startswith("_n=")]
        if stored and stored != [f"_n={buckets}"]:
            raise ValueError(f"the table has {stored[0][3:]} buckets; use them, or rebucket it")
        self.recover()

    @property
    def path(self) -> str:
        return f"{self.root}/_n={self.buckets}"

    # ------------------------------------------------------------- commits
    def _commits(self, where: str = "_commits") -> list[tuple[int, str | None, int, str]]:
        """(number, stream, batch, folder name) of the finished or pending commits, oldest first."""
        found = ((self.COMMIT.match(n), n) for n in _folders(self.spark, f"{self.root}/{where}"))
        return sorted((int(m[1]), m[2], int(m[3] or -1), n) for m, n in found if m)

    def applied(self, stream: str) -> int:
        """The last batch of a stream that a finished commit holds, or -1."""
        return max((batch for _, s, batch, _ in self._commits() if s == stream), default=-1)

    def recover(self) -> None:
        """Finish the pending commit that is complete; drop one that is not."""
        for *_, name in self._commits("_pending"):
            fs, folder, jvm = _fs(self.spark, f"{self.root}/_pending/{name}")
            if fs.exists(jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")):
                self._finish(name)
            else:
                fs.delete(folder, True)

    def _finish(self, name: str) -> None:
        """Move a pending commit's folders in; every step may be repeated."""
        pending = f"{self.root}/_pending/{name}"
        fs, folder, jvm = _fs(self.spark, pending)
        path = jvm.org.apache.hadoop.fs.Path

        def move(source, target) -> None:
            if not fs.rename(source, target):
                raise OSError(f"{source} could not be moved to {target}")

        fs.mkdirs(path(self.path))
        for bucket in _folders(self.spark, f"{pending}/_kind=rows"):
            old = path(f"{self.path}/{bucket}")
            if fs.exists(old):
                fs.delete(old, True)
            move(path(f"{pending}/_kind=rows/{bucket}"), old)
        for bucket in _folders(self.spark, f"{pending}/_kind=more"):
            fs.mkdirs(path(f"{self.path}/{bucket}"))
            for status in fs.listStatus(path(f"{pending}/_kind=more/{bucket}")):
                move(status.getPath(), path(f"{self.path}/{bucket}/{status.getPath().getName()}"))
        fs.mkdirs(path(f"{self.root}/_commits"))
        move(folder, path(f"{self.root}/_commits/{name}"))

    def _stage(self, rows: DataFrame, kind: Column, mark: Mark | None, placed: bool = False) -> str:
        """Write a pending commit; its name. ``placed`` rows lie by bucket already, one bucket in one partition."""
        done = self._commits()
        name = f"c={max((c[0] for c in done), default=0) + 1:09d}" + (f".{mark[0]}.{mark[1]}" if mark else "")
        dealt = rows.withColumns({"_kind": kind, "_b": self.bucket})
        dealt = dealt if placed else dealt.repartition("_kind", "_b")
        dealt.write.partitionBy("_kind", "_b").parquet(f"{self.root}/_pending/{name}", compression=CODEC)
        if not self.feed:  # of each stream, the last mark is enough
            last = {stream: n for _, stream, _, n in done}
            for *_, old in done:
                if old not in last.values():
                    fs, folder, _ = _fs(self.spark, f"{self.root}/_commits/{old}")
                    fs.delete(folder, True)
        return name

    def _replace(self, rows: DataFrame, mark: Mark | None = None, placed: bool = False) -> None:
        """Replace the partitions that rows fall in; rows with a ``_change_type`` are images and go beside them."""
        image = F.col(CHANGE).isNotNull() if CHANGE in rows.columns else F.lit(False)
        self._finish(self._stage(rows, F.when(image, "changes").otherwise("rows"), mark, placed))

    # -------------------------------------------------------------- reading
    def exists(self) -> bool:
        # A partition folder is moved here by a commit; a failed first write leaves none.
        return any(n.startswith("_b=") for n in _folders(self.spark, self.path))

    def _stored(self) -> DataFrame:
        # columns that later batches brought are in some files only
        return self.spark.read.option("mergeSchema", "true").parquet(self.path).drop(CHANGE)

    def read(self) -> DataFrame:
        self.recover()
        return self._stored().drop("_b")

    def changes(self, after: int = 0, upto: int | None = None) -> DataFrame:
        """The change images of the commits numbered ``after`` + 1 to ``upto``, with ``_commit``."""
        self.recover()
        wanted = [n for c, *_, n in self._commits() if c > after and (upto is None or c <= upto)]
        folders = [f"{self.root}/_commits/{n}/_kind=changes" for n in wanted if "_kind=changes" in _folders(self.spark, f"{self.root}/_commits/{n}")]
        if not folders:
            return self._stored().drop("_b").limit(0).withColumns({CHANGE: F.lit(""), "_commit": F.lit(0).cast("bigint")})
        rows = self.spark.read.option("mergeSchema", "true").option("basePath", f"{self.root}/_commits").parquet(*folders)
        number = F.regexp_extract("_metadata.file_path", r"/c=(\d+)", 1).cast("bigint")
        return rows.withColumn("_commit", number).drop("c", "_kind", "_b")

    def last_commit(self) -> int:
        return max((c for c, *_ in self._commits()), default=0)

    # -------------------------------------------------------------- writing
    def _touched(self, batch: DataFrame) -> DataFrame | None:
        """The stored rows of the partitions that the batch's keys fall in."""
        if not self.exists():
            return None
        touched = [r[0] for r in batch.select(self.bucket.alias("b")).distinct().collect()]  # at most ``buckets``
        return self._stored().filter(F.col("_b").isin(touched)).drop("_b")

    def _is_applied(self, mark: Mark | None) -> bool:
        self.recover()
        return mark is not None and self.applied(mark[0]) >= mark[1]

    def merge(self, batch: DataFrame, step: Step, mark: Mark | None = None) -> None:
        """Replace the touched partitions by ``step(their rows or None, batch)``."""
        if not self._is_applied(mark):
            self._replace(step(self._touched(batch), batch), mark)

    def append(self, batch: DataFrame, step: Step, mark: Mark | None = None) -> None:
        """Add ``step(rows of the touched partitions or None, batch)`` as new files; stored ones stay."""
        if not self._is_applied(mark):
            self._finish(self._stage(step(self._touched(batch), batch), F.lit("more"), mark))

    def upsert(self, source: DataFrame, mark: Mark | None = None, **options) -> None:
        """S15 on the touched partitions; with ``feed``, the change images come out of the same join."""
        if self.feed:
            return self.merge(source, lambda current, b: upsert_with_images(current, b, self.keys, **options), mark)
        return self.merge(source, lambda current, b: b if current is None else upsert(current, b, self.keys, **options), mark)

    def compact(self) -> None:
        """One file per partition again, after many appends."""
        if self.exists():
            self._replace(self.read())

    def rebucket(self, root: str, buckets: int) -> KeyedTable:
        """A copy of the table with another number of buckets."""
        out = KeyedTable(self.spark, root, self.keys, buckets, self.folded, self.feed, self.joined)
        out._replace(self.read())
        return out


class HistoryTable:
    """SCD2 history: ``open`` versions in a ``KeyedTable``, ``closed`` ones appended under a run column.

    A run joins the source with the open versions only and writes the buckets
    in which a version was opened or closed. Closed history is never read or
    rewritten. Runs are numbered by their time, so repeating a run that
    failed half-way replaces what it had written.

    With ``joined`` buckets (part of the layout, see ``bucket_of``) a run
    writes its rows where the join has left them.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int, case_insensitive_keys: Sequence[str] = (), joined: bool = False):
        self.spark, self.root = spark, root.rstrip("/")
        self.open = KeyedTable(spark, f"{self.root}/open", keys, buckets, case_insensitive_keys, joined=joined)

    def _closed(self) -> DataFrame | None:
        folder = f"{self.root}/closed"
        return self.spark.read.parquet(folder).drop("_run") if _folders(self.spark, folder) else None

    def read(self) -> DataFrame:
        closed, opened = self._closed(), self.open.read()
        return opened if closed is None else opened.unionByName(closed)

    def snapshot(self, source: DataFrame, check_cols: Sequence[str], now, **options) -> None:
        keys, bucket = self.open.keys, self.open.bucket
        placed = self.open.joined
        options |= {"case_insensitive_keys": self.open.folded, "partitions": self.open.buckets if placed else None}
        if not self.open.exists():
            self.open._replace(scd2_open(None, source, keys, check_cols, now, **options), placed=placed)
            return
        now_c = F.lit(now).cast("timestamp_ntz")
        versions = scd2_open(self.open.read(), source, keys, check_cols, now, **options).persist()
        try:
            ended = versions.filter(F.col("dbt_valid_to") == now_c)
            run = F.date_format(now_c, "yyyyMMddHHmmssSSS")
            # Closed first: if the run fails after this, its repetition closes the same versions again.
            written = ended.withColumn("_run", run).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            written.partitionBy("_run").parquet(f"{self.root}/closed", compression=CODEC)
            changed = versions.filter((F.col("dbt_valid_to") == now_c) | (F.col("dbt_valid_from") == now_c))
            touched = [r[0] for r in changed.select(bucket.alias("b")).distinct().collect()]  # at most ``buckets``
            still = versions.filter(F.col("dbt_valid_to").isNull() & bucket.isin(touched))
            if touched:
                self.open._replace(still, placed=placed)
        finally:
            versions.unpersist()


def _seen(spark: SparkSession, inputs: Sequence[str]) -> str:
    """A name for this application and the files of ``inputs`` (paths, sizes, times)."""
    seen = [spark.sparkContext.applicationId]
    for path in inputs:
        fs, p, _ = _fs(spark, path)
        files = fs.listFiles(p, True)
        while files.hasNext():
            st = files.next()
            seen.append(f"{st.getPath()} {st.getLen()} {st.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()[:16]


def stored_model(spark: SparkSession, name: str, inputs: Sequence[str], build: Callable[[str], None]) -> str:
    """The folder of a model that is built once and then read by every query that needs it.

    ``build(folder)`` writes the model's tables. The folder, in the shared
    one, is named after the files of ``inputs``, so a changed input builds
    anew, and after the application, so that no other program's model is
    taken. It appears, complete, by a rename; of two builders at the same
    time one is kept.
    """
    root = f"{checkpoint_root(spark).rstrip('/')}/lakeforge/models/{name}-{_seen(spark, inputs)}"
    fs, folder, jvm = _fs(spark, root)
    if not fs.exists(folder):
        attempt = f"{root}.{uuid.uuid4().hex[:12]}"
        build(attempt)
        if not fs.exists(folder):
            fs.rename(jvm.org.apache.hadoop.fs.Path(attempt), folder)
    return root


def stored_buckets(spark: SparkSession, name: str, inputs: Sequence[str], key: str, buckets: int, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()`` as a table stored in buckets of ``key``, sorted within them; built once, as ``stored_model``.

    Tables with the same key and number of buckets join, and sum up per key,
    without an exchange. The catalog of the application knows the table; its
    files are in the shared folder. The number of buckets is the table's
    size over what one task should read, and the caller's to choose.
    """
    table = f"{name}_{_seen(spark, inputs)}"
    if not spark.catalog.tableExists(table):
        path = f"{checkpoint_root(spark).rstrip('/')}/lakeforge/models/{table}"
        dealt = build().repartition(buckets, key)  # one file per bucket
        dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return spark.table(table)


def write_or_upsert(spark: SparkSession, df: DataFrame, root: str, keys: Sequence[str]) -> int:
    """The table-exists test, then upsert, or the first full write."""
    return VersionedTable(spark, root).upsert(df, keys)


def replace_table(spark: SparkSession, df: DataFrame, root: str) -> int:
    """``CREATE OR REPLACE TABLE AS SELECT`` as a new version."""
    return VersionedTable(spark, root).publish(df)


def reload_variant(spark: SparkSession, path: str, root: str, column: str = "data") -> int:
    """Delete-then-load of JSON files into a one-column VARIANT table.

    Each JSON record (an array stays one value) becomes one row; the load
    replaces the table's content as a new version.
    """
    df = spark.read.format("json").option("singleVariantColumn", column).load(path)
    return replace_table(spark, df, root)


def publish(spark: SparkSession, df: DataFrame, name: str, kind: str, root: str | None = None,
            unique_key: Sequence[str] | None = None):
    """Materialise a model as a table, a view or an incremental table."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return name
    if root is None:
        raise ValueError("table kinds need a root folder")
    if kind == "table":
        return replace_table(spark, df, root)
    if kind == "incremental":
        return write_or_upsert(spark, df, root, unique_key or [])
    raise ValueError(kind)


def table_inventory(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Base tables with their row counts, ordered by name.

    One job: every table contributes a one-row count (a global aggregate
    with partial counts per task) to a union.
    """
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in sorted(tables.items())
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table_name")


def parquet_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Tables of a folder of ``<name>.parquet`` datasets (a database folder)."""
    fs, root, _ = _fs(spark, folder)
    out = {}
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if name.endswith(".parquet"):
            out[name[: -len(".parquet")]] = spark.read.parquet(st.getPath().toString())
    return out


