"""Declarative pipeline definition of the streaming earthquake flow (SURVEY
S18, S19, E2), for Spark Declarative Pipelines (``pyspark.pipelines``).

``define_quake_pipeline`` registers the dataflow graph when called from a
pipeline source file run by the pipelines runner:

- streaming table ``quake_bronze``: JSON file stream, flattened (T-5);
- streaming table ``quake_silver_stream``: selected columns, stream dedup
  (D2), hash id;
- materialized view ``quake_silver_current``: the sequenced SCD1 table
  (newest ``updated`` per ``hash_id``; the automatic CDC flow re-aimed as a
  view over the deduplicated stream, M3);
- materialized views ``quake_gold_hotspot`` (A1) and
  ``quake_gold_activity`` (A2).

The runner executes the graph through Spark Connect; this repository does
not start one. ``tests/test_declarative.py`` registers the graph into an
in-memory registry and evaluates the materialized views in batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def define_quake_pipeline(spark: SparkSession, raw_path: str, prefix: str = "quake") -> dict[str, str]:
    """Register the graph; returns the dataset names by role."""
    from pyspark import pipelines as dp

    from lakeforge.functions import hash_id
    from lakeforge.operators import latest_per_key
    from lakeforge.plans import quakes
    from lakeforge.sources import schemas
    from lakeforge.streaming.ingest import json_stream, stream_dedup

    names = {
        "bronze": f"{prefix}_bronze",
        "silver_stream": f"{prefix}_silver_stream",
        "silver_current": f"{prefix}_silver_current",
        "hotspot": f"{prefix}_gold_hotspot",
        "activity": f"{prefix}_gold_activity",
    }

    @dp.table(name=names["bronze"], comment="feed files, flattened (streaming)")
    def bronze() -> DataFrame:
        return quakes.silver_transform(json_stream(spark, raw_path, schemas.QUAKE_FEED, multiline=False))

    @dp.table(name=names["silver_stream"], comment="deduplicated events with hash id (streaming)")
    def silver_stream() -> DataFrame:
        rows = spark.readStream.table(names["bronze"]).select(*quakes.SILVER_COLUMNS)
        return stream_dedup(rows).withColumn("hash_id", hash_id("id", "time"))

    @dp.materialized_view(name=names["silver_current"], comment="SCD1: newest update per hash_id")
    def silver_current() -> DataFrame:
        return latest_per_key(spark.read.table(names["silver_stream"]), ["hash_id"], ["updated"])

    @dp.materialized_view(name=names["hotspot"], comment="event density per 0.1 degree cell")
    def hotspot() -> DataFrame:
        return quakes.geo_hotspot(spark.read.table(names["silver_current"]))

    @dp.materialized_view(name=names["activity"], comment="hourly activity per network")
    def activity() -> DataFrame:
        return quakes.seismic_activity(spark.read.table(names["silver_current"]))

    return names
