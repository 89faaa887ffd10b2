"""Join helpers.

``sum_over_join`` computes ``SUM(measure)`` grouped over an equi-join
that is many-to-many on its key (trap T2: a date dimension with one row
per fact row joined on the date) without emitting the row pairs. Both
sides are pre-aggregated per (key, group columns); the join then meets
one row per group on each side and the left side's row count becomes a
weight. The result equals the SUM over the pairwise join.

Which side of a join is broadcast is left to Spark, which knows sizes in
bytes, before and (adaptively) during the run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sum_over_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_groups: Sequence[str],
    right_groups: Sequence[str],
    measures: dict[str, str],
    how: str = "inner",
) -> DataFrame:
    """``SELECT groups, SUM(m) FROM left JOIN right ON key GROUP BY groups``.

    ``measures`` maps output name → measure column of the right side.
    ``how`` is ``inner`` or ``left`` (left side preserved, as a dimension
    LEFT JOIN fact). Group columns are given by their output names; a
    group column may be an expression alias prepared by the caller.
    """
    w = "_w"
    lagg = left.groupBy(F.col(left_key).alias("_k"), *left_groups).agg(
        F.count(F.lit(1)).alias(w)
    )
    ragg = right.groupBy(F.col(right_key).alias("_k"), *right_groups).agg(
        *[F.sum(c).alias(f"_s_{name}") for name, c in measures.items()]
    )
    joined = lagg.join(ragg, "_k", how)
    out = joined.groupBy(*left_groups, *right_groups).agg(
        *[F.sum(F.col(f"_s_{name}") * F.col(w)).alias(name) for name in measures]
    )
    return out
