"""Declarative data-quality checks.

Each check returns the *failing* rows as a DataFrame; an empty result is a
pass. All are grouped aggregates with map-side combine, so a hot value is
counted per task before the shuffle. Rules on single rows also come as
conditions, which a publishing job counts while it writes
(``VersionedTable.publish(checks=...)``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType


def _expr(df: DataFrame, e) -> Column:
    if isinstance(e, Column):
        return e
    c = F.col(e)
    # Variant values cannot be grouped or compared: use their JSON text.
    if e in df.columns and isinstance(df.schema[e].dataType, VariantType):
        return F.to_json(c)
    return c


def check_unique(df: DataFrame, expr, name: str = "unique_field") -> DataFrame:
    """Q1: values of ``expr`` seen more than once (NULLs ignored)."""
    e = _expr(df, expr)
    return (
        df.select(e.alias(name))
        .filter(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def check_not_null(df: DataFrame, expr) -> DataFrame:
    """Q2: rows where ``expr`` is NULL."""
    return df.filter(_expr(df, expr).isNull())


def check_accepted(df: DataFrame, col, values: Sequence, name: str = "value_field") -> DataFrame:
    """Q3: values outside the accepted list, with their row counts."""
    e = _expr(df, col)
    return (
        df.groupBy(e.alias(name))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(~F.col(name).isin(list(values)))
    )


def duplicate_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q4: duplicate-key profile: key groups with more than one row."""
    return (
        df.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("count"))
        .filter(F.col("count") > 1)
    )


class CheckFailed(Exception):
    """A load that its checks have stopped; ``counts`` has the failing rows by check."""

    def __init__(self, counts: dict[str, int]):
        super().__init__(", ".join(f"{n}: {k} rows" for n, k in sorted(counts.items())))
        self.counts = counts


def is_null(expr) -> Column:
    """Q2 as a row condition, for checks that a load counts while it writes."""
    return (expr if isinstance(expr, Column) else F.col(expr)).isNull()


def not_accepted(expr, values: Sequence) -> Column:
    """Q3 as a row condition; NULL is not a value outside the list."""
    e = expr if isinstance(expr, Column) else F.col(expr)
    return e.isNotNull() & ~e.isin(list(values))
