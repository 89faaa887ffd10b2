"""Session set-up and shared-storage helpers.

Everything here is plain SparkSession configuration. The scratch and
checkpoint folders always come from ``spark.checkpoint.dir``, the shared
folder a cluster names for lineage cuts; a default is set only when the
session has none (local tests).
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

# Used only in local mode, where every task sees the same disk, and only when
# the session names no checkpoint folder.
LOCAL_CHECKPOINT_DEFAULT = "/tmp/lakeforge-checkpoints"


def build_session(
    master: str | None = None,
    app_name: str = "lakeforge",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with AQE, skew-join handling and a UTC clock.

    ``shuffle_partitions`` is the *initial* partition count; AQE coalesces
    small partitions and splits skewed ones at run time, so on a cluster
    this is sized for the largest stage (e.g. input bytes / 128 MB).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "128m",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Streaming state on disk, not on the heap.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Without one, a local session gets a default; a cluster, where a local
    folder would be another one on each machine, is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all of {master} shares")
        root = LOCAL_CHECKPOINT_DEFAULT
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` write into the shared folder."""
    root = checkpoint_root(spark)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/lakeforge/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    """Read one driver table (Parquet): filters and projections push down."""
    return spark.read.parquet(table_path(sf_dir, name))


def materialize(df, name: str):
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts lineage like ``checkpoint()``, but computes the input once (a
    reliable RDD checkpoint of an unpersisted plan runs it twice) and the
    re-read is columnar, so later steps prune columns and push filters.
    The folder is below ``spark.checkpoint.dir``, visible to every
    executor and safe against executor loss.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
