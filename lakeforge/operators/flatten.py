"""Explode and flatten nested and variant data.

All are ``Generate`` / projection nodes: no shuffle, and Catalyst prunes
nested fields that are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _generate(c: Column, outer: bool) -> Column:
    return F.explode_outer(c) if outer else F.explode(c)


def explode_features(df: DataFrame, col: str = "features", outer: bool = False) -> DataFrame:
    """G1: one row per element of an array of structs."""
    return df.select(_generate(F.col(col), outer).alias(col))


def flatten_features(bronze: DataFrame, outer: bool = False) -> DataFrame:
    """G1 + F1 + F2: features[] → properties.*, id, longitude, latitude, depth.

    Coordinates are read with ``get`` so a short array gives NULL instead of
    failing the job under ANSI mode (trap T24).
    """
    exploded = explode_features(bronze, "features", outer)
    coords = F.col("features.geometry.coordinates")
    return exploded.select(
        "features.properties.*",
        "features.id",
        F.get(coords, 0).alias("longitude"),
        F.get(coords, 1).alias("latitude"),
        F.get(coords, 2).alias("depth"),
    )


def explode_variant(df: DataFrame, col: str, alias: str = "value", path: str = "$", outer: bool = False) -> DataFrame:
    """Flatten a variant array (at ``path``) to one row per element.

    Other columns of ``df`` are kept (a lateral flatten). Elements stay
    variants. A missing or non-array value gives no row unless ``outer``.
    """
    arr = F.variant_get(F.col(col), path, "array<variant>")
    return df.select("*", _generate(arr, outer).alias(alias))


def explode_variant_object(
    df: DataFrame,
    col: str,
    path: str = "$",
    key: str = "key",
    value: str = "value",
    outer: bool = False,
) -> DataFrame:
    """Flatten a variant object to (key, value) rows, value a variant."""
    obj = F.variant_get(F.col(col), path, "map<string,variant>")
    return df.select("*", _generate(obj, outer).alias(key, value))


def vpath(col: str, path: str, dtype: str = "string") -> Column:
    """``SOURCE:a:b::T`` → ``variant_get(col, '$.a.b', T)``.

    Arrays and objects read as ``string`` come back as JSON text.
    """
    return F.variant_get(F.col(col), path, dtype)


def vpath_int_rounded(col: str, path: str) -> Column:
    """``::INT`` that rounds (half away from zero) instead of truncating."""
    return F.round(F.variant_get(F.col(col), path, "double"), 0).cast("int")
