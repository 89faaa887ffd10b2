"""Earthquake lakehouse jobs.

Driver-table mapping: every ``events`` row is one feed document with one to
three features. ``event_id`` gives the id (``'ev' || event_id``), ``ts`` the
event and update times (epoch milliseconds, as in the feed), ``value`` the
magnitude and the depth, ``event_type`` the network; the coordinates are
derived from ``user_id`` (longitude) and ``value`` (latitude). Every fifth
user's events are reported again an hour later with a magnitude one higher,
and every seventh user's first report occurs twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.functions import epoch_ms_to_ts, hash_id, ts_to_epoch_ms
from lakeforge.operators import dedup_rows, flatten_features, latest_per_key

# The columns of the silver table.
SILVER_COLUMNS = [
    "id", "time", "longitude", "latitude", "depth", "mag", "magType", "place",
    "gap", "dmin", "rms", "net", "code", "ids", "sources", "types", "nst",
    "title", "status", "tsunami", "sig", "felt", "updated",
]


# What the flattened feed holds as epoch milliseconds, and the counts that become doubles.
EPOCH_COLUMNS = ["time", "updated"]
COUNT_COLUMNS = ["nst", "sig", "tsunami", "felt"]


def use_utc(spark) -> None:
    """Epoch ↔ timestamp conversions below are defined in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _feature(mag: F.Column, updated: F.Column) -> F.Column:
    ms = ts_to_epoch_ms("ts")
    lon, lat = _position()
    props = F.struct(
        F.lit(None).cast("string").alias("alert"),
        F.lit(None).cast("double").alias("cdi"),
        F.col("event_id").cast("string").alias("code"),
        F.lit(None).cast("string").alias("detail"),
        (F.col("value") / 100).alias("dmin"),
        F.col("user_id").cast("bigint").alias("felt"),
        F.col("user_id").cast("bigint").alias("gap"),
        F.concat(F.lit(",ev"), F.col("event_id").cast("string"), F.lit(",")).alias("ids"),
        mag.alias("mag"),
        F.lit("ml").alias("magType"),
        F.lit(None).cast("double").alias("mmi"),
        F.col("event_type").alias("net"),
        F.col("user_id").cast("bigint").alias("nst"),
        F.concat(F.lit("zone "), F.col("user_id").cast("string")).alias("place"),
        (F.col("value") / 1000).alias("rms"),
        F.col("user_id").cast("bigint").alias("sig"),
        F.lit(",lf,").alias("sources"),
        F.lit("reviewed").alias("status"),
        ms.alias("time"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("title"),
        F.lit(0).cast("bigint").alias("tsunami"),
        F.lit("earthquake").alias("type"),
        F.lit(",origin,").alias("types"),
        F.lit(None).cast("string").alias("tz"),
        updated.alias("updated"),
        F.lit(None).cast("string").alias("url"),
    )
    return F.struct(
        F.struct(F.array(lon, lat, F.col("value")).alias("coordinates"), F.lit("Point").alias("type")).alias("geometry"),
        F.concat(F.lit("ev"), F.col("event_id").cast("string")).alias("id"),
        props.alias("properties"),
        F.lit("Feature").alias("type"),
    )


def _position() -> tuple[F.Column, F.Column]:
    lon = (F.col("user_id") % 360).cast("double") - F.lit(180.0)
    return lon, (F.floor("value") % 180).cast("double") - F.lit(90.0)


def feed_from_events(events: DataFrame) -> DataFrame:
    """Driver ``events`` → bronze feed documents (``schemas.QUAKE_FEED``)."""
    ms = ts_to_epoch_ms("ts")
    lon, lat = _position()
    first = _feature(F.col("value"), ms)
    revised = _feature(F.col("value") + 1, ms + 3_600_000)
    features = F.concat(
        F.array(first),
        F.when(F.col("user_id") % 5 == 0, F.array(revised)).otherwise(F.array()),
        F.when(F.col("user_id") % 7 == 0, F.array(first)).otherwise(F.array()),
    )
    meta = F.struct(
        F.lit("1.10.3").alias("api"), F.size(features).cast("bigint").alias("count"),
        ms.alias("generated"), F.lit(200).cast("bigint").alias("status"),
        F.lit("feed").alias("title"), F.lit(None).cast("string").alias("url"),
    )
    return events.select(
        F.array(lon, lat, lon, lat).alias("bbox"),
        features.alias("features"),
        meta.alias("metadata"),
        F.lit("FeatureCollection").alias("type"),
    )


def silver_transform(bronze: DataFrame) -> DataFrame:
    """Flatten + casts (time columns from epoch ms; counts to double)."""
    flat = flatten_features(bronze)
    typed = {c: epoch_ms_to_ts(c) for c in EPOCH_COLUMNS} | {c: F.col(c).cast("double") for c in COUNT_COLUMNS}
    return flat.withColumns(typed)


def silver(bronze: DataFrame, exact_dedup_first: bool = False) -> DataFrame:
    """E1 silver: selected columns, exact dedup, latest per id, hash id.

    Exact duplicates are identical rows, and ``latest_per_key`` breaks ties
    on every column, so it already keeps exactly one of them: the separate
    all-column dedup (one more full shuffle) changes nothing and is skipped
    unless ``exact_dedup_first``.
    """
    picked = silver_transform(bronze).select(*SILVER_COLUMNS)
    if exact_dedup_first:
        picked = dedup_rows(picked)
    latest = latest_per_key(picked, ["id"], ["updated"])
    return latest.withColumn("hash_id", hash_id("id", "time"))


def _magnitudes(silver_df: DataFrame, by: dict[str, F.Column], count: str) -> DataFrame:
    """Rows, mean and greatest magnitude per group, and a 15-character id hashed from the group."""
    summary = [F.count(F.lit(1)).alias(count), F.avg("mag").alias("avg_mag"), F.max("mag").alias("max_mag")]
    grouped = silver_df.groupBy(*[c.alias(name) for name, c in by.items()]).agg(*summary)
    return grouped.withColumn("hash_id", hash_id(*by, length=15))


def seismic_activity(silver_df: DataFrame) -> DataFrame:
    """A2: events per hour and network."""
    hour = F.date_trunc("hour", "time").cast("timestamp_ntz")
    return _magnitudes(silver_df, {"activity_hour": hour, "net": F.col("net")}, "total_event")


def geo_hotspot(silver_df: DataFrame) -> DataFrame:
    """A1: events per 0.1° cell."""
    cell = {f"avg_{c}": F.round(c, 1) for c in ("latitude", "longitude")}
    return _magnitudes(silver_df, cell, "event_density")


def feed_files(feed: DataFrame, rows_per_file: int = 500) -> DataFrame:
    """``(file, value)``: feed rows put together as the real feed comes, one pretty-printed JSON object to a file.

    A file holds the features of neighbouring events, a bounded number of them.
    """
    number = F.substring(F.col("features")[0]["id"], 3, 20).cast("bigint")
    files = feed.groupBy(F.floor(number / rows_per_file).alias("file")).agg(
        F.first("bbox").alias("bbox"), F.flatten(F.collect_list("features")).alias("features"),
        F.first("metadata").alias("metadata"), F.first("type").alias("type"))
    return files.select("file", F.to_json(F.struct("bbox", "features", "metadata", "type"), {"pretty": "true"}).alias("value"))


def daily_events(silver_df: DataFrame) -> DataFrame:
    """Events per day (``COUNT(id)``, as the dashboard counts)."""
    return silver_df.groupBy(
        F.date_trunc("day", F.col("time")).cast("timestamp_ntz").alias("event_day")
    ).agg(F.count("id").alias("event_count"))


def events_by_net(silver_df: DataFrame) -> DataFrame:
    """Events per network."""
    return silver_df.groupBy("net").agg(F.count(F.lit(1)).alias("event_count"))


def point_map(silver_df: DataFrame) -> DataFrame:
    """F16: un-aggregated point-map extract."""
    return silver_df.select("mag", "latitude", "longitude", "place", "time")


def hotspot_map(gold_density: DataFrame) -> DataFrame:
    """F16: hotspot-map extract of the density table."""
    return gold_density.select("event_density", "avg_latitude", "avg_longitude", "avg_mag")
