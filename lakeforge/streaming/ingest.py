"""Structured Streaming ingest and change application (SURVEY S2–S5, S13,
S14, D2, M3, M9, M10, T-1…T-7, E2, E5, E8).

- File streams take an explicit schema; the checkpoint records which files
  were taken, so each new file is processed once (the auto-ingest and
  append-only change-stream behaviour). Deleting the checkpoint
  reprocesses every file (T-2).
- ``drain`` runs a query with ``availableNow``: everything present is
  processed in bounded micro-batches, then the query stops (T-3).
- Change application runs in ``foreachBatch`` against a ``VersionedTable``
  (each micro-batch becomes one committed version, marked with the stream's
  id and the batch's number) or a ``KeyedTable`` (only the partitions of
  the batch's keys are rewritten, or added to). A batch that is replayed
  after a failure between the table's commit and the checkpoint's is skipped
  by its mark. The stream's id lives in its checkpoint, so a fresh
  checkpoint, or another stream, never looks like a replay.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

from lakeforge.operators.changes import cdc_scd1, insert_absent, scd1_merge
from lakeforge.sources.files import CsvDialect
from lakeforge.sources.tables import KeyedTable, Mark, Step, VersionedTable, _fs


# ------------------------------------------------------------------ sources
def _intake(reader: DataStreamReader, max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None,
            archive: str | None = None) -> DataStreamReader:
    """How a file stream takes its files: oldest first, and so many files or bytes to a micro-batch.

    A bound in bytes keeps micro-batches alike when files are not; a file
    larger than it is a batch of its own. ``archive`` is a folder, outside
    the source, to which files move once their batch is committed, so that
    listing the source stays cheap.
    """
    if max_files_per_trigger and max_bytes_per_trigger:
        raise ValueError("bound micro-batches by files or by bytes")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader


#: A backlog of less than so many bytes is one micro-batch.
BATCH_BYTES = 1 << 30


def backlog(spark: SparkSession, path: str, batches: int = 4, least: int = BATCH_BYTES) -> dict[str, int]:
    """How to take what lies in a folder in at most about ``batches`` micro-batches (``intake`` of a stream).

    A merge of a micro-batch whose keys fall everywhere costs as much as the
    table, so with micro-batches of a fixed size the cost of a backlog grows
    as its square. What one micro-batch holds is Spark's to shuffle and spill.
    """
    fs, folder, _ = _fs(spark, path)
    return {"max_bytes_per_trigger": max(least, -(-fs.getContentSummary(folder).getLength() // batches))}


def json_stream(spark: SparkSession, path: str, schema: StructType, multiline: bool = True, **intake) -> DataFrame:
    """Stream of JSON files with a fixed schema (``intake``: see ``_intake``)."""
    r = spark.readStream.schema(schema).option("multiLine", str(multiline).lower())
    return _intake(r, **intake).json(path)


def variant_stream(spark: SparkSession, path: str, column: str = "data", **intake) -> DataFrame:
    """Continuous load of JSON records into one VARIANT column."""
    r = spark.readStream.format("json").option("singleVariantColumn", column)
    return _intake(r, **intake).load(path)


def csv_stream(spark: SparkSession, path: str, schema: StructType, dialect: CsvDialect = CsvDialect(), **intake) -> DataFrame:
    """Positional CSV file stream; NULL tokens applied per batch."""
    r = spark.readStream.schema(schema).options(**dialect.options())
    return dialect.apply_null_tokens(_intake(r, **intake).csv(path))


def table_stream(spark: SparkSession, path: str, schema: StructType | None = None, max_files_per_trigger: int | None = None, **intake) -> DataFrame:
    """Stream the files appended to a Parquet table folder."""
    r = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    return _intake(r, max_files_per_trigger, **intake).option("recursiveFileLookup", "true").parquet(path)


# -------------------------------------------------------------------- sinks
def drain(stream_df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", output_mode: str = "append") -> None:
    """Write a stream to a table folder with ``availableNow``, then stop."""
    q = (
        stream_df.writeStream.format(fmt)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    q.awaitTermination()
    if q.exception():
        raise q.exception()


# --------------------------------------------------------------- operators
def stream_dedup(df: DataFrame, subset: Sequence[str] | None = None, watermark: tuple[str, str] | None = None) -> DataFrame:
    """D2 by the stream's state.

    Without ``watermark`` the state keeps every key seen (as the source
    pipeline does); with ``(event_time_col, delay)`` state is bounded by
    ``dropDuplicatesWithinWatermark``, and rows later than the delay are
    lost, seen before or not. ``run_dedup_stream`` has neither fault.
    """
    cols = list(subset) if subset else None
    if watermark is None:
        return df.dropDuplicates(cols) if cols else df.dropDuplicates()
    ts, delay = watermark
    # A watermark wants an instant; zone-free times are read in the session's zone.
    w = df.withColumn("_event_time", F.col(ts).cast("timestamp")).withWatermark("_event_time", delay)
    return w.dropDuplicatesWithinWatermark(cols or df.columns).drop("_event_time")


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps for the life of its checkpoint."""
    return spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()[0]


def apply_batch(table: VersionedTable | KeyedTable, batch: DataFrame, step: Step, mark: Mark, append: bool = False) -> None:
    """Merge one micro-batch, if it holds data."""
    # The batch is read several times (empty check, bucket ids, merge);
    # persisting it avoids re-running the micro-batch plan (and its stateful
    # operators) each time. Lost blocks are recomputed from the batch's
    # fixed source offsets.
    batch = batch.persist()
    try:
        if not batch.isEmpty():
            (table.append if append else table.merge)(batch, step, mark)
    finally:
        batch.unpersist()


def _apply_batches(
    stream_df: DataFrame,
    table: VersionedTable | KeyedTable,
    checkpoint: str,
    step: Step,
    trigger: dict | None = None,
    append: bool = False,
):
    """Start a stream that merges every micro-batch into a table (or appends what the step leaves of it)."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        apply_batch(table, batch, step, (stream_id(batch.sparkSession, checkpoint), batch_id), append)

    w = stream_df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def run_dedup_stream(stream_df: DataFrame, table: KeyedTable, checkpoint: str, trigger: dict | None = None):
    """D2/T-6: of all rows ever delivered, one per key of the table, however late a copy comes.

    Each micro-batch is deduplicated, compared with the keys stored in the
    partitions that its own keys fall in, and what is new is appended as
    files. What has been seen is the table itself: there is no state beside
    it, no watermark and nothing to be too late for. Later streams can read
    the table's folder as a file stream (as long as it is not compacted).
    """
    def step(current, batch):
        return insert_absent(current, batch, table.keys)

    return _apply_batches(stream_df, table, checkpoint, step, trigger, append=True)


def run_cdc_stream(stream_df: DataFrame, table: VersionedTable | KeyedTable, checkpoint: str, keys: Sequence[str],
                   sequence_by: str, tiebreak: Sequence[str] | None = None, trigger: dict | None = None):
    """M3/T-7: sequenced SCD1 from a stream; late older rows are ignored."""
    def step(current, batch):
        return cdc_scd1(current, batch, keys, sequence_by, tiebreak)

    return _apply_batches(stream_df, table, checkpoint, step, trigger)


def run_scd1_stream(stream_df: DataFrame, table: VersionedTable | KeyedTable, checkpoint: str, keys: Sequence[str],
                    now: Callable[[], object], initial: DataFrame | None = None, on_duplicate: str = "error",
                    order_by: Sequence[str] | None = None, trigger: dict | None = None):
    """E5 (M9, M10, M2, M11): change stream → SCD1 merge → versioned publish.

    ``trigger`` defaults to ``availableNow``; ``{"processingTime": "1 minute"}``
    gives the source system's minute schedule.
    """
    if initial is not None and not table.exists():
        table.merge(initial, lambda current, b: b)

    def step(current, batch):
        return scd1_merge(current, batch, keys, now(), on_duplicate=on_duplicate, order_by=order_by)

    return _apply_batches(stream_df, table, checkpoint, step, trigger)
